"""The kernel against its plain definition, and the scores on labelled and made-up texts."""

import random
from itertools import combinations

import numpy as np
import pytest

from clipsift.llm import toxicity as tox
from clipsift.llm.queries import llm_queries

INSULTS = ["idiot", "moron", "stupid", "loser"]
PLAIN = [f"{a}{b}{c}" for a in ("the", "on", "er", "an", "ca", "li", "re") for b in ("ti", "ne", "ra", "do", "mi") for c in ("n", "st", "ble", "s")]


def plain_features(codes):
    """Runs of four in order over all gaps, each occurrence weighted by the span it takes."""
    out = {}
    for places in combinations(range(len(codes)), tox.ORDER):
        if places[-1] - places[0] < tox.SPAN:
            key = tuple(int(codes[i]) for i in places)
            out[key] = out.get(key, 0) + tox.DECAY ** (places[-1] - places[0])
    return out


def plain_kernel(a, b):
    x, y = plain_features(a), plain_features(b)
    square = sum(tox.DECAY ** (2 * (p[-1] - p[0])) for p in combinations(range(tox.WINDOW), tox.ORDER) if p[-1] - p[0] < tox.SPAN)
    return sum(v * y.get(key, 0) for key, v in x.items()) / square


def windows_of(text):
    codes = tox.encoded(text)
    return [codes[i : i + tox.WINDOW] for i in range(len(codes) - tox.WINDOW + 1)]


def test_kernel_definition():
    windows = np.array([windows_of(t)[0] for t in ("you idiot go", "an id iot is", "a", "été banana ß", "stupidity 12")])
    marks = np.array([windows_of(t)[0] for t in (" idiot", "banana stand", "stupid")])
    expected = [[plain_kernel(w, m) for m in marks] for w in windows]
    assert np.allclose(tox.kernel(windows, marks, step=2), expected)
    assert expected[1][0] > 5 * expected[3][0]


def test_scores_are_sums_over_windows(monkeypatch):
    """A text's features against every window's plain features, also when texts are read in parts."""
    rng = np.random.default_rng(3)
    weights = rng.standard_normal(tox.FEATURES).astype(np.float32)
    own = tox.Model(weights, 0.1, np.array([0.2, 0.5, -0.3, 0.1]))
    texts = ["", "idiot", "An id-iot, i d i o t and a b c!", "ÉTÉ  \n\t ça", "thing " * 12]
    power = tox.CODES ** np.arange(tox.ORDER)[::-1]
    square = sum(tox.DECAY ** (2 * (p[-1] - p[0])) for p in combinations(range(tox.WINDOW), tox.ORDER) if p[-1] - p[0] < tox.SPAN)
    expected = []
    for text in texts:
        values = [0.1 + sum(v * weights[int(np.dot(k, power))] for k, v in plain_features(w).items()) / square**0.5 for w in windows_of(text)]
        places = sum(v > 0 and not (i and values[i - 1] > 0) for i, v in enumerate(values))
        expected.append([max(max(values), tox.FLOOR), np.log1p(places), np.log(len(tox.encoded(text)))])
    assert np.allclose(own.text_features(texts), expected, atol=1e-5)
    monkeypatch.setattr(tox, "CHUNK", 20)
    found = own.text_features(texts)
    assert np.allclose(found, expected, atol=1e-5)
    assert np.allclose(own.text_scores(found), [1 / (1 + np.exp(-(0.2 + 0.5 * a - 0.3 * b + 0.1 * c))) for a, b, c in expected])


def test_marks_are_squeezed_out():
    assert tox.squeezed("an i d i o t, a s s, id-iot. a b") == "an i d i o t, a s s, id-iot. a b idiotass idiot"
    assert tox.squeezed("plain words here. Next") == "plain words here. Next"


def texts(seed, n):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(PLAIN) for _ in range(rng.randrange(20, 60))]
        bad = i % 4 == 0
        for _ in range(3 * bad):
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark, make_docs):
    docs, labels = texts(1, 800)
    return tox.train(make_docs(docs), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_altered_insults(make_docs, with_clashes, model):
    base = " ".join(PLAIN[:30])
    cases = ["", "idiot moron", "i.d.i.o.t and m-o-r-o-n", "i d i o t, s t u p i d", "IDIOT!! such a LOSER", "idiiot sstupid", None, base]
    rows = [(i, f"{base} {c}" if c else c) for i, c in enumerate(cases)] + [(4, base), (None, base), (9, "x" * 200_000 + " " + base * 50)]
    out = tox.score_documents(with_clashes(make_docs(rows)), model).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out if r.doc_id not in (4, None)}
    assert [by_id[i].predicted for i in (0, 1, 2, 3, 5, 6, 7, 9)] == [0, 1, 1, 1, 1, 0, 0, 0]
    assert sorted(r.predicted for r in out if r.doc_id == 4) == [0, 1]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    kept = tox.without_toxic(make_docs(rows), model)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 4, 6, 7, 9]


def test_broken_insults(make_docs, with_clashes, model):
    """Insults broken by a space, spelled out, or with inserted characters; harmless words alike stay."""
    base = " ".join(PLAIN[:30])
    bad = ["st upid", "id iot", "i d i o t", "mo ron", "l-o-s-e-r", "IDIIOT", "idíot", "stu\npid"]
    good = ["cation", "t h e", "on er an", "ca li re", "x" * 300_000]
    docs = with_clashes(make_docs([(i, f"{base} {c} {base}") for i, c in enumerate(bad + good)]))
    out = {r.doc_id: r.predicted for r in tox.score_documents(docs, model).collect()}
    assert [out[i] for i in range(len(bad))] == [1] * len(bad)
    assert [out[len(bad) + i] for i in range(len(good))] == [0] * len(good)
    kept = tox.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(good)


def test_held_out_texts(make_docs, model):
    docs, labels = texts(2, 300)
    out = {r.doc_id: r.predicted for r in tox.score_documents(make_docs(docs), model).collect()}
    assert sum(out[i] == y for i, y in labels) >= 0.98 * len(labels)


def test_held_out_rows(spark, make_docs, model):
    from zlib import crc32

    out = tox.score_documents(make_docs([(i, "a") for i in range(50)]), model).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)


def test_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = make_docs([(1, "stupid"), (2, None)])
    assert {r.predicted for r in tox.score_documents(docs, tox.train(docs, none)).collect()} == {0}
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    assert {r.predicted for r in tox.score_documents(docs, tox.train(docs, odd)).collect()} == {0}
    assert tox.score_documents(make_docs([]), tox.train(make_docs([]), none)).collect() == []


def test_labels_held_out(spark, sf_dir):
    """Ranking on rows that nothing was learned from."""
    path = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    rows = llm_queries()["op3_toxicity"].plan(spark, path).filter("held_out").join(labels, "doc_id").toPandas()
    rank, y = rows["score"].rank().to_numpy(), rows["toxic"].to_numpy() == 1
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.93
