"""Metrics and aggregates against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipsift.operators import aggregates, metrics, scaling

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def auc_by_pairs(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return 0.0
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@FEW
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.5, 0.9])), min_size=1, max_size=60))
def test_roc_auc(spark, rows):
    df = spark.createDataFrame(rows, "label int, prob double").repartition(3)
    assert metrics.roc_auc(df).first()["auc"] == pytest.approx(auc_by_pairs(rows))


def test_roc_auc_per_model_with_a_hot_score(spark):
    rng = random.Random(1)
    rows = [(m, rng.randrange(2), 0.5 if rng.random() < 0.4 else rng.random()) for m in "ab" for _ in range(200)]
    df = spark.createDataFrame(rows, "model string, label int, prob double")
    got = {r["model"]: r["auc"] for r in metrics.roc_auc(df, keys=["model"]).collect()}
    for m in "ab":
        assert got[m] == pytest.approx(auc_by_pairs([(y, s) for k, y, s in rows if k == m]))


def test_roc_curve(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)]
    got = metrics.roc_curve(spark.createDataFrame(rows, "label int, prob double")).collect()
    points = sorted((r["threshold"], r["fpr"], r["tpr"]) for r in got)
    assert points == [(0.1, 1.0, 1.0), (0.8, 0.5, 1.0), (0.9, 0.0, 0.5), (math.inf, 0.0, 0.0)]


def test_kappa(spark):
    def kappa(pairs):
        return metrics.cohen_kappa(spark.createDataFrame(pairs, "y1 string, y2 string")).first()

    assert kappa([("a", "a"), ("b", "b")])["kappa"] == 1.0
    assert kappa([("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")])["kappa"] == 0.0
    same = kappa([("a", "a"), ("a", "a")])
    assert same["kappa"] is None and same["po"] == 1.0 and same["n"] == 2


def test_confusion_keeps_empty_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (0, 1)], "label int, pred int")
    got = {(r["label"], r["pred"]): r["n"] for r in metrics.confusion(df, [0, 1]).collect()}
    assert got == {(0, 0): 1, (0, 1): 2, (1, 0): 0, (1, 1): 0}


def test_binary_metrics_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, pred int")
    assert tuple(metrics.binary_metrics(df).first()) == (0.5, 0.0, 0.0, 0.0)


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=1, max_size=40))
def test_macro_f1(spark, rows):
    df = spark.createDataFrame(rows, "label int, pred int")
    scores = []
    for c in {x for r in rows for x in r}:
        tp = sum(y == p == c for y, p in rows)
        denominator = sum(y == c for y, _ in rows) + sum(p == c for _, p in rows)
        scores.append(2 * tp / denominator)
    got = metrics.macro_f1(df).first()
    assert got["macro_f1"] == pytest.approx(sum(scores) / len(scores))


def test_compare_models(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 1), ("b", 1, 1), ("b", 0, 0)], "model string, label int, pred int")
    long = metrics.metrics_long(metrics.binary_metrics(df, keys=["model"]))
    got = {r["metric"]: (r["base"], r["other"], r["diff"]) for r in metrics.compare_models(long, "a", "b").collect()}
    assert got["acc"] == (0.5, 1.0, 0.5)


@FEW
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100).map(lambda x: round(x, 1))), min_size=1, max_size=50))
def test_describe(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = aggregates.describe(df, {"v": F.col("v")}).first()
    shown = [v for v in values if v is not None]
    assert got["count"] == len(shown)
    if shown:
        assert got["mean"] == pytest.approx(np.mean(shown), abs=1e-9)
        for p in aggregates.PERCENTILES:
            assert got[aggregates.pct_name(p)] == pytest.approx(np.percentile(shown, p * 100), abs=1e-9)
    if len(shown) > 1:
        assert got["std"] == pytest.approx(np.std(shown, ddof=1), abs=1e-9)


def test_describe_approx(spark):
    got = aggregates.describe(spark.range(101).select("id"), {"id": F.col("id")}, approx=True).first()
    assert got["p50"] == 50.0 and got["max"] == 100.0


def test_latency_rules(spark):
    stamp = dt.datetime(2024, 1, 1)
    epoch = stamp.replace(tzinfo=dt.timezone.utc).timestamp()
    rows = [(stamp, epoch - 2.0, 5.0, None), (stamp, epoch + 60, None, 7.0)]
    df = spark.createDataFrame(rows, "ingested_at timestamp_ntz, timestamp double, processing_time double, processing_time_ms double")
    got = [tuple(r) for r in aggregates.with_latency(df).select("e2e_latency_sec", "inference_latency_ms").collect()]
    assert got == [(2.0, 5.0), (0.001, 7.0)]
    bare = aggregates.with_latency(df.select("timestamp")).first()
    assert bare["e2e_latency_sec"] == 0.001 and bare["inference_latency_ms"] is None


def test_trend_fills_empty_bins(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, m), lab) for m, lab in ((1, "a"), (2, "b"), (16, "a"), (22, None))]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, label string")
    got = {r["bin"].minute: r["n"] for r in aggregates.trend(df).collect()}
    assert got == {0: 2, 5: 0, 10: 0, 15: 1, 20: 0}


def test_risk_ratio_of_nothing(spark):
    got = aggregates.risk_ratio(spark.createDataFrame([], "label string"), "x").first()
    assert tuple(got) == (0, 0, 0.0, "0.0%")


def test_label_counts_join_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",)], "label string")
    assert {r["label"]: r["n"] for r in aggregates.label_counts(df).collect()} == {"Unknown": 2, "a": 1}


def test_raw_label_rules(spark):
    cases = {
        '{"label":"SAFE"}': "safe", '{"label":null,"harmful":"1"}': "unknown", '{"labels":0}': "safe",
        '{"harmful":true}': "unknown", '{"violation":"Hate speech"}': "harmful", "{}": "unknown",
        '{"label":" safe"}': "unknown", '{"ground_truth":3}': "harmful",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "j string, want string")
    got = df.withColumn("got", aggregates.raw_label_class(F.col("j"))).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    scaler = scaling.fit_scaler(df, ["a", "b"])
    got = {r["feature"]: (r["mean"], r["std"]) for r in scaler.long().collect()}
    assert got["a"] == (pytest.approx(7 / 3), pytest.approx(1.247219, abs=1e-6)) and got["b"] == (5.0, 1.0)
    scaled = [r["a"] for r in scaler.transform(df).collect()]
    assert sum(scaled) == pytest.approx(0.0, abs=1e-9)


def test_scaler_on_a_sample(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("x"))
    few = scaling.fit_scaler(df, ["x"], sample_n=10, key="id").long().first()
    again = scaling.fit_scaler(df.repartition(7), ["x"], sample_n=10, key="id").long().first()
    assert few == again


def test_mean_pool(spark):
    rows = [("a", [1.0, 2.0], 1), ("a", [3.0, 4.0], 1), ("a", [9.0, 9.0], 0), ("b", [5.0, 5.0], 0)]
    df = spark.createDataFrame(rows, "k string, e array<float>, m int")
    got = {r["k"]: r["e"] for r in aggregates.mean_pool(df, "k", "e", "m").collect()}
    assert got["a"] == pytest.approx([2.0, 3.0]) and got["b"] == [0.0, 0.0]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (9.9,), (10.0,), (-1.0,)], "x double")
    got = {r["bucket"]: r["n"] for r in aggregates.histogram(df, "x", 0, 10, 2).collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 1}


def test_listing(spark):
    rows = [("bronze/a/video.mp4", 1), ("bronze/a/m.json", 1), ("silver/a/x.npy", 2), ("gold/d.npz", 3 * 2**20), ("top", 9)]
    df = spark.createDataFrame(rows, "path string, size long")
    assert tuple(aggregates.object_listing_stats(df).first()) == (5, 1, 1, 1, 1, 3.0)
    assert [r["name"] for r in aggregates.list_subdirs(df, "bronze/").collect()] == ["a"]
