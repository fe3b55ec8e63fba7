"""The stages against their brute-force versions, and the whole run."""

import random
import re

import corpus_pipeline
import pytest

from tests.llm.test_neardup import sets_of, union
from tests.llm.test_suffixes import brute as repeat_brute
from tests.llm.test_tokens import check_packing

INSULTS = ["idiot", "moron", "stupid", "loser"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents, toxic ones, copies, near copies, repeated passages, secrets, nulls."""
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("ter", "on", "li", "ma", "dre", "fu") for b in ("na", "gel", "so", "vi", "pet", "ku", "rim")]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 160))]
        if i % 5 == 0:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(INSULTS)
        if i % 17 == 1:
            words.append("password=" + "".join(rng.choice("0123456789abcdef") for _ in range(18)))
        text = " ".join(words)
        if i % 23 == 2:
            text += "\n" + passage
        rows.append((i, text))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(400 + i, rows[i][1]) for i in (1, 2, 3, 4, 1)]
    rows += [(410 + i, rows[i][1].replace(rows[i][1].split()[30], "altered", 1)) for i in (6, 7, 8)]
    rows += [(500, None), (501, ""), (502, "short one")]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def as_rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, folder, tmp_path, word_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before, text = docs.columns, as_rows(docs), None
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        path = f"{tmp_path}/{n}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "packing":
            check_packing(docs.collect(), before, word_path, 4096)
            continue
        assert docs.columns == columns
        after = as_rows(docs)
        if name == "toxicity":
            bad = {d for d, t in before if t and any(w in t.split() for w in INSULTS)}
            assert {d for d, _ in before} - {d for d, _ in after} == bad
        elif name == "near_duplicates":
            sets = [sets_of(t, 5) for _, t in before]
            links = [(i, j) for i in range(len(before)) for j in range(i) if sets[i] and sets[j]
                     and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
            groups, low = union(len(before), links), {}
            for (d, _), g in zip(before, groups):
                low[g] = min(low.get(g, d), d)
            assert sorted(d for d, _ in after) == sorted(low.values())
            assert dict(after).items() <= dict(before).items()
        elif name == "suffix_dedup":
            import hashlib
            expected = {d: h for d, _, _, _, h in repeat_brute(before, 200)}
            assert {d: hashlib.sha256((t or "").encode()).hexdigest() for d, t in after} == expected
            assert expected != {d: hashlib.sha256((t or "").encode()).hexdigest() for d, t in before}
        else:
            expected = {d: re.sub("(?<=password=)[0-9a-f]{18}", "[SECRET]", t) if t else t for d, t in before}
            assert dict(after) == expected and any("[SECRET]" in (t or "") for t in expected.values())
        assert all(r.n_chars == len(r.text or "") for r in docs.collect())
        before = after


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 200


def test_small_batches(spark, folder):
    """Rows with whole texts are handed to Python few at a time, also when a stage's result is written later."""
    def sizes(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    keys = list(corpus_pipeline.WIDE_ROWS)
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "10000")
        corpus_pipeline.STAGES[2][1](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        rows = spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long").collect()
        assert max(r.n for r in rows) <= 1000 and sum(r.n for r in rows) == 5000
        spark.conf.set(keys[0], "70")  # a session's smaller figure stands
        corpus_pipeline.STAGES[3][1](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        assert spark.conf.get(keys[0]) == "70"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_workers_give_memory_back(spark, word_path):
    """What a task leaves in a Python worker does not add to the memory of the tasks after it."""
    import os

    from clipsift.llm import common

    def used():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith("Anonymous:")) / 1024

    def work(batches):
        common.word_encoder(word_path).encode(["words of an earlier stage"])
        held = [os.urandom(50_000) for _ in range(4000)]  # below the size that is given back by itself
        kept.extend(held[::25])  # what is freed between these is not at the heap's end
        kept.append(held[-1])
        del held
        yield from batches

    kept = []
    common.word_encoder(word_path).encode(["before"])
    before = used()
    assert list(common.lean(work, encodes=True)(iter([1]))) == [1]
    assert used() - before < 60 and common.word_encoder.cache_info().currsize == 1
    assert list(common.lean(lambda b: b)(iter([2]))) == [2]
    assert common.word_encoder.cache_info().currsize == 0
