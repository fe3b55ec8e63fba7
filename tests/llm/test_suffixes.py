"""Repeated byte strings against a brute-force count of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from clipsift.llm import suffixes


def brute(rows, threshold):
    texts = [(d, (t or "").encode()) for d, t in rows]
    often = Counter(t[i : i + threshold] for _, t in texts for i in range(len(t) - threshold + 1))
    out = []
    for d, t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - threshold + 1):
            if often[t[i : i + threshold]] > 1:
                gone[i : i + threshold] = [True] * threshold
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n):
    return " ".join(rng.choice(["er", "thé", "on", "ing", "ñ", "at", "re", "日", "st"]) + str(rng.randrange(40)) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [words(rng, n) for n in (30, 45, 60, 90, 200)]
    rows = []
    for i in range(60):
        parts = [words(rng, rng.randrange(1, 60))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, len(p) // 3)
            parts += [p[a : len(p) - rng.randrange(0, len(p) // 3)], words(rng, rng.randrange(0, 30))]
        rows.append((i, rng.choice([" ", "\n", ""]).join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, "a" * 500), (103, "ab" * 150), (104, None), (105, ""),
             (106, "x" * 199), (107, "y" * 200), (108, "z" * 201), (7, "another text of doc 7"), (None, passages[4]),
             (None, None), (109, (words(rng, 40) + "\n") * 3), (100, rows[3][1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(make_docs, with_clashes, seed):
    rows = corpus(seed)
    out = suffixes.remove_repeats(with_clashes(make_docs(rows, 3))).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, 200)))


def test_segments_are_no_bounds(make_docs, monkeypatch):
    """Long texts are handled in parts; a shorter threshold tries more bounds."""
    rows = corpus(3)
    monkeypatch.setattr(suffixes, "SEGMENT", 1000)
    suffixes._hashes.cache_clear()
    found = []
    data = b"".join((t or "").encode() for _, t in rows)
    import numpy as np
    bounds = np.cumsum([0] + [len((t or "").encode()) for _, t in rows])
    for row, lo, n, *_ in suffixes.anchors(np.frombuffer(data, dtype=np.uint8), bounds, 50, 20, False):
        found += [(r, x) for r, a, m in zip(row.tolist(), lo.tolist(), n.tolist()) for x in range(a, a + m)]
    expected = [(r, i) for r, (_, t) in enumerate(rows) for i in range(len((t or "").encode()) - 49)]
    assert sorted(found) == expected
    suffixes._hashes.cache_clear()


def test_text_and_columns(make_docs):
    passage = "é" * 10 + words(random.Random(5), 60)
    docs = make_docs([(1, "first " + passage), (2, passage + " last"), (3, None), (4, "alone")])
    out = {r.doc_id: r for r in suffixes.without_repeats(docs).collect()}
    assert (out[1].text, out[1].n_chars) == ("first ", 6)
    assert (out[2].text, out[2].n_chars) == (" last", 5)
    assert (out[3].text, out[4].text) == (None, "alone")
    assert suffixes.remove_repeats(make_docs([])).collect() == []
