"""Hard negatives against plain loops over all pairs."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsift.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, scale=256, every=5, positives=5, keep=3, low=50, high=95):
    """Every anchor and positive with its negatives, one pair at a time."""
    sound, d = [], 64
    for i, v, label in dict.fromkeys((i, tuple(v) if v is not None else None, lab) for i, v, lab in rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v) or not v:
            continue
        sound.append((i, [math.floor(scale * float(np.float32(x))) for x in v], label))
    sizes = defaultdict(int)
    for _, v, _ in sound:
        sizes[len(v)] += 1
    if sound:
        d = max(sizes, key=lambda s: (sizes[s], s))
    sound = [r for r in sound if len(r[1]) == d]
    out = []
    for i, v, label in sound:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in sound]
        near = sorted((s, j) for s, j, other in scored if other == label and j != i)[:positives]
        for s, j in near:
            p = -s
            hits = sorted((t, k) for t, k, other in scored if other != label and low * p <= -100 * t <= high * p)
            out += [(i, j, r + 1, k, p, -t) for r, (t, k) in enumerate(hits[:keep])]
    return sorted(out)


def mined(df, every=5, **options):
    found = negatives.hard_negatives(df, F.col("id") % every == 0, F.col("label"), **options)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("kind", ["random", "clusters", "ties"])
def test_equals_all_pairs(spark, monkeypatch, kind):
    rng = np.random.default_rng({"random": 1, "clusters": 2, "ties": 3}[kind])
    if kind == "random":
        x = rng.normal(size=(700, 19)) * rng.uniform(0.1, 3, size=(700, 1))
    elif kind == "clusters":
        x = rng.normal(size=(6, 19))[rng.integers(0, 6, 700)] + 0.05 * rng.normal(size=(700, 19))
    else:
        x = rng.integers(-1, 2, size=(700, 3)) / 4
    rows = [(i, [float(np.float32(c)) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]
    monkeypatch.setattr(negatives, "LEAST_BLOCK", 64)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows)
    assert len(want) > 50
    assert mined(df, most_block=64) == want
    assert mined(df, most_block=1000) == want


def test_one_vector_holds_a_third(spark, monkeypatch):
    rng = np.random.default_rng(4)
    same = [0.5, -0.25, 0.125, 0.75]
    rows = [(i, same if i % 3 == 0 else rng.normal(size=4).tolist(), i % 2) for i in range(600)]
    monkeypatch.setattr(negatives, "LEAST_BLOCK", 32)
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df, every=6, most_block=32) == brute(rows, every=6)


def test_rare_label_is_found_beyond_the_first_block(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist(), 9 if i % 40 == 0 else 1) for i in range(400)]
    monkeypatch.setattr(negatives, "LEAST_BLOCK", 16)
    assert mined(spark.createDataFrame(rows, SCHEMA), every=40, most_block=16) == brute(rows, every=40)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.75, 0.25], 2), (3, [0.5, 0.5], 2),
        (4, None, 1), (5, [None, 1.0], 1), (6, [nan, 1.0], 2), (7, [inf, 1.0], 1), (8, [1.0, 1.0], None),
        (None, [0.75, 0.25], 2), (9, [], 1), (10, [0.5, 0.5, 0.5], 2), (15, [0.0, 0.0], 1), (16, [-1.0, -1.0], 1),
        (17, [0.0, 0.0], 2), (20, [1.0, 0.5], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(df) == brute([r for r in rows])
    clashing = df.withColumns({c: F.lit("x") for c in ("id", "v", "q", "block", "key", "score", "rank")})
    assert mined(clashing) == brute(rows)


def test_empty_table(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []


def test_index_bounds_lose_nothing():
    random.seed(6)
    rng = np.random.default_rng(6)
    x = rng.integers(-300, 300, size=(500, 21))
    index = negatives.BlockIndex(np.arange(500), np.zeros(500, dtype=np.int64), x)
    a = rng.integers(-300, 300, size=(40, 21))
    full = a @ x.T
    for level in (-10**7, 0, 150_000, 10**6):
        least = np.full(40, level) + rng.integers(-1000, 1000, 40)
        i, j, s = index.above(np.arange(500), a, least)
        want = {(p, r, full[p, r]) for p, r in zip(*np.nonzero(full >= least[:, None]))}
        assert set(zip(i, j, s)) == want and len(i) == len(want)
