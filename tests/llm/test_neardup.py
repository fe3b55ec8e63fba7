"""Near-duplicate groups against all pairs, components against a plain union-find."""

import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from clipsift.llm import components as star_rounds
from clipsift.llm import neardup
from clipsift.llm.components import components
from clipsift.session import setting


def sets_of(text, size=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def union(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute(rows, pct=80):
    sets = [sets_of(t) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= pct * len(sets[i] | sets[j])
    ]
    groups = union(len(rows), links)
    low = {}
    for (d, _), g in zip(rows, groups):
        low[g] = min(low.get(g, d), d)
    return sorted((d, len(s), low[g], d == low[g]) for (d, _), s, g in zip(rows, sets, groups))


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "日本", "x,"]
    rows = []
    passage = [rng.choice(vocabulary) for _ in range(40)]
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.55:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randrange(0, max(2, len(words) // 9))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.75:
            words = passage + [rng.choice(vocabulary) for _ in range(rng.randrange(2, 30))]
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))]
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    return rows


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(make_docs, with_clashes, seed):
    rows = corpus(seed) + [(900, None), (901, ""), (902, " \n"), (903, "Solo"), (904, "solo"), (905, "one two")]
    assert got(neardup.near_duplicates(with_clashes(make_docs(rows, 3)), shingle=2)) == brute(rows)


def test_small_blocks_and_large_bucket(make_docs, monkeypatch):
    """Many texts around one passage: linked, unlinked and chained ones in the same buckets."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(60), rng.choice([1, 3, 4, 8, 9])):
            words[at] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert got(neardup.near_duplicates(make_docs(rows, 3), shingle=2)) == brute(rows)


def test_odd_rows(make_docs):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(5, text), (5, text), (None, text), (None, "lonely words"), (None, "lonely words"), (None, None), (8, text + " end")]
    out = sorted(str((r.doc_id, r.component_id, r.kept)) for r in neardup.near_duplicates(make_docs(rows), shingle=2).collect())
    assert out == sorted(map(str, [
        (5, 5, True), (5, 5, True), (None, 5, False), (None, None, True), (None, None, True), (None, None, True), (8, 5, False),
    ]))
    assert neardup.near_duplicates(make_docs([])).collect() == []


def test_words_by_bytes():
    texts = ["a b", "", "é\tb\x0bc", " lead", "trail\n", "x"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    bounds = np.cumsum([0] + [len(t.encode()) for t in texts])
    starts, ends = neardup._word_ranges(data, bounds)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["a", "b", "é", "b", "c", "lead", "trail", "x"]


def test_pruning_keeps_what_is_similar():
    """Simulated signatures at the threshold pass; unrelated ones stop after the first batch."""
    rng = np.random.default_rng(3)
    a = rng.integers(0, 256, (20_000, 200)).astype(np.uint8)
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 256, a.shape)).astype(np.uint8)
    assert len(neardup.likely(a, b, 0.8)) == len(a)
    assert len(neardup.likely(a, rng.integers(0, 256, a.shape).astype(np.uint8), 0.8)) == 0
    assert neardup.least_matches(200, 0.8, 1e-8)[0][1] > 8


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    links = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(40, i) for i in range(80) if i != 40],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(110)],
        "none": [],
    }[shape]
    df = spark.createDataFrame(links, "a long, b long")
    roots = union(200, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.root for r in components(df).collect()} == {x: roots[x] for x in touched}


def test_rounds_write_little(spark, tmp_path, monkeypatch):
    """Settled links are written once, in few files however many partitions there are, and seen to be settled."""
    written = []

    def counted(df, name):
        written.append(made(df, name))
        return written[-1]

    made = star_rounds.durable
    monkeypatch.setattr(star_rounds, "durable", counted)
    with setting(spark, "spark.sql.shuffle.partitions", "23"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        spark.range(1, 3000).selectExpr("0L AS a", "id AS b").write.parquet(f"{tmp_path}/links")
        found = star_rounds.roots(spark.read.parquet(f"{tmp_path}/links"))
        assert found.agg(F.count("*"), F.min("node"), F.max("root")).first() == (2999, 1, 0)
    assert len(written) == 1 and len(written[0].inputFiles()) == 1
    # Two that share a smaller one, but of whom one is the root of others, are not settled yet.
    for links, done in (([(3, 1), (4, 1), (9, 5)], True), ([(3, 1), (4, 3)], False), ([(4, 1), (4, 2)], False)):
        assert star_rounds._settled(spark.createDataFrame(links, "a long, b long")) is done


def test_one_of_each_stays(make_docs, with_clashes):
    rng = random.Random(6)
    long = [f"t{i}" for i in range(80)]
    near = " ".join(["changed", *long[1:]])
    rows = [(3, " ".join(long)), (4, near), (5, " ".join(long)), (3, " ".join(long)), (6, None), (6, None), (7, "alone here"),
            (None, near), (None, "no id at all"), (None, "no id at all"), (8, " ".join(rng.sample(long, 80))), (9, "")]
    docs = with_clashes(make_docs(rows, 3))
    out = neardup.without_near_duplicates(docs)
    assert out.columns == docs.columns
    kept = sorted(str((r.doc_id, r.text)) for r in out.collect())
    expected = [rows[0], (6, None), (6, None), rows[6], (None, "no id at all"), rows[10], rows[11]]
    assert kept == sorted(map(str, expected))
    assert neardup.without_near_duplicates(make_docs([])).collect() == []


def test_cluster_away_from_its_hub(make_docs, monkeypatch):
    """Near copies of a passage that the bucket's smallest member only quotes: few pairs, one group."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = " ".join(word() for _ in range(120))
    docs = [(1, f"{passage} " + " ".join(word() for _ in range(400)))]
    docs += [(10 + i, f"{passage} " + " ".join(word() for _ in range(4))) for i in range(700)]
    asked, real = [], neardup._verified

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(neardup, "_verified", counted)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(make_docs(docs), shingle=2).collect()}
    assert got == {1: 1} | {10 + i: 10 for i in range(700)}
    assert max(asked) < 10 * len(docs)


def test_bit_maps_never_rule_out_a_link():
    rng = np.random.default_rng(13)
    for size in (5, 300, 5000):
        a = rng.integers(0, 2**64, size, dtype=np.uint64)
        for share in (0.0, 0.5, 0.78, 0.8, 0.9, 1.0):
            b = np.concatenate([a[: int(share * size)], rng.integers(0, 2**64, size - int(share * size), dtype=np.uint64)])
            sets = [np.unique(a), np.unique(b)]
            maps = neardup._maps(np.concatenate(sets), np.array([0, len(sets[0])]))
            n = np.array([len(s) for s in sets])
            both = len(np.intersect1d(*sets))
            reaches = 100 * both >= 80 * (n[0] + n[1] - both)
            assert neardup.may_reach(maps[:1], maps[1:], n[:1], n[1:], 80)[0] or not reaches
