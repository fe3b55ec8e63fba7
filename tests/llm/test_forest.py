"""Neighbours against exact search: recall, exact scores and order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsift.llm import forest
from clipsift.llm.queries import llm_queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def product(a, b):
    total = 0.0  # sum() would add with compensation
    for x, y in zip(a, b):
        total += x * y
    return total


def exact(rows, k, every):
    fine = {}
    for i, v in rows:
        if v is not None and i is not None and any(v) and all(x is not None and np.isfinite(x) for x in v):
            fine[i] = [float(np.float32(x)) for x in v]
    out = {}
    for q in fine:
        if q % every == 0:
            scored = [(product(fine[q], v), i) for i, v in fine.items() if i != q]
            out[q] = sorted(scored, key=lambda x: (-x[0], x[1]))[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_whole_breadth_is_exact(spark, with_clashes):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).round(1).tolist()) for i in range(300)]
    same = rng.standard_normal(8).tolist()
    rows += [(i, same) for i in range(300, 400)] + [(400, None), (401, [0.0] * 8), (402, [None] * 8), (403, [float("nan")] * 8),
             (404, [1.0] * 3), (405, [float("inf")] * 8), (300, same), (None, same)]
    df = with_clashes(table(spark, rows))
    found = by_query(forest.neighbours(df, F.col("vec_id") % 5 == 0, k=6, trees=3, leaves=12, breadth=1.0, block=16))
    expected = exact([r for r in rows if r[0] not in (None, 404)], 6, 5)
    assert found.keys() == expected.keys()
    for q, own in expected.items():
        assert [(r, i) for r, i, _ in found[q]] == [(n + 1, i) for n, (_, i) in enumerate(own)]
        assert [s for _, _, s in found[q]] == [s for s, _ in own]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf_dir, sf):
    path = sf_dir.replace("sf0.001", sf)
    found = by_query(llm_queries()["op7_nearest_neighbours"].plan(spark, path))
    x = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    v = np.array(x["embedding"].tolist(), dtype=np.float64)
    ids = x["vec_id"].to_numpy()
    hits = 0
    assert len(found) == (ids % 20 == 0).sum()
    for q, own in found.items():
        scores = v @ v[ids == q][0]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:20]
        hits += len({ids[i] for i in order} & {i for _, i, _ in own})
        assert len(own) == 20 and np.allclose([s for *_, s in own], [scores[ids == i][0] for _, i, _ in own], atol=1e-12)
    assert hits >= 0.9 * 20 * len(found)


def test_few_rows(spark):
    one = forest.neighbours(table(spark, [(0, [1.0, 0.0])]), F.col("vec_id") % 20 == 0)
    assert one.collect() == []
    none = forest.neighbours(table(spark, []), F.col("vec_id") % 20 == 0)
    assert none.collect() == [] and none.columns == ["query_id", "rank", "vec_id", "score"]
    two = forest.neighbours(table(spark, [(0, [1.0, 0.0]), (7, [0.5, 2.0])]), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in two.collect()] == [(0, 1, 7, 0.5)]


@pytest.mark.parametrize("n", [15, 21, 24, 40, 60, 100])
def test_tight_clusters(spark, n):
    """Every query ends with k neighbours, or all candidates if there are fewer."""
    rng = np.random.default_rng(n)
    centre = rng.standard_normal((2, 16)) * 5
    rows = [(i, (centre[i % 2] + 0.01 * rng.standard_normal(16)).tolist()) for i in range(n)]
    found = by_query(forest.neighbours(table(spark, rows), F.col("vec_id") % 5 == 0))
    expected = exact(rows, 20, 5)
    assert {q: len(own) for q, own in found.items()} == {q: min(20, n - 1) for q in expected}
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i in own}) for q, own in expected.items())
    assert hits >= 0.9 * sum(map(len, expected.values()))
