"""Feature store, index of seen ids, hourly log, maintained views, keyed runs and the model store."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clipsift.operators import models, ordering
from clipsift.operators.scaling import fit_scaler
from clipsift.sources import predictionlog, writers
from clipsift.sources.featurestore import FeatureStore, SeenIds
from clipsift.sources.modelstore import ModelStore, plain_model
from clipsift.streaming import views


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "video_id string")


def plan(df):
    return df._jdf.queryExecution().toString()


def test_store_reads_only_the_buckets_of_a_batch(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "f"), buckets=64)
    assert store.lookup(ids(spark, "1")) is None
    rows = spark.range(2000).select(F.col("id").cast("string").alias("video_id"), (F.col("id") * 2).alias("x"))
    store.put(rows)
    found = store.lookup(ids(spark, *map(str, range(10)), "none", None, "3"))
    assert {r["video_id"]: r["x"] for r in found.collect()} == {str(i): 2 * i for i in range(10)}
    scans = {line.strip() for line in plan(found).splitlines() if "FileScan parquet" in line and "/f]" in line}
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (IN|INSET) ", s) for s in scans)
    touched = {r["bucket"] for r in store._dealt(ids(spark, *map(str, range(10)), "none", "3")).collect()}
    paths = store.read(sorted(touched)).select("_metadata.file_path").distinct().collect()
    opened = {int(r[0].split("bucket=")[1].split("/")[0]) for r in paths}
    assert opened == touched and len(store.folder.partitions("bucket")) == 64


def test_store_replaces_rows_and_may_run_again(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path / "f"), buckets=4)
    store.put(spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 5, 1), (None, 9, 9)], "video_id string, x int, t int"), order="t")
    fresh = spark.createDataFrame([("b", 7, 2), ("c", 8, 2)], "video_id string, x int, t int")
    for _ in range(2):
        store.put(fresh)
    assert {r["video_id"]: r["x"] for r in store.read().collect()} == {"a": 2, "b": 7, "c": 8}
    untouched = FeatureStore(spark, str(tmp_path / "f"), buckets=4)
    assert untouched.read([]).count() == 0


def test_seen_ids_over_batches(spark, tmp_path):
    seen = SeenIds(spark, str(tmp_path / "s"), buckets=8, segments=2)
    got = []
    for batch, names in enumerate((["a", "a", None], ["a", "b"], [], ["c", "b", "d"])):
        fresh = sorted(r[0] for r in seen.unseen(ids(spark, *names), batch).collect())
        seen.add(ids(spark, *fresh), batch)
        got.append(fresh)
        again = sorted(r[0] for r in seen.unseen(ids(spark, *names), batch).collect())
        assert again == fresh  # a batch that runs again finds the same
    assert got == [["a"], ["b"], [], ["c", "d"]]
    seen.add_outside(ids(spark, "x", "a"))
    assert sorted(r[0] for r in seen.unseen(ids(spark, "x", "y", "a")).collect()) == ["y"]


def test_filters_never_lose_an_id_and_spare_reads(spark, tmp_path):
    seen = SeenIds(spark, str(tmp_path / "s"), buckets=4, segments=2)
    old = spark.range(5000).select(F.concat(F.lit("v"), "id").alias("video_id"))
    seen.add(old, 0)
    assert seen.unseen(old).count() == 0
    fresh = seen.unseen(ids(spark, "w1", "w2", "w3"))
    assert fresh.count() == 3
    assert "/ids/" not in plan(fresh)  # no filter has them, so no bucket of ids is read
    full = SeenIds(spark, str(tmp_path / "t"), buckets=1, segments=1)
    full.add(spark.range(60_000).select(F.col("id").cast("string").alias("video_id")), 0)
    assert full.unseen(spark.range(59_000, 61_000).select(F.col("id").cast("string").alias("video_id"))).count() == 1000


def log_rows(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("video_id"), F.when(F.col("id") % 5 == 0, "error").otherwise("ok").alias("label"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / 7) * 600).alias("ingested_at"),
    )


def test_latest_opens_few_hours(spark, tmp_path):
    rows, path = log_rows(spark, 7 * 6 * 720), str(tmp_path / "log")
    predictionlog.write_log(rows, path)
    for n, label in ((50, "All"), (50, "error"), (1, "ok"), (400, "error")):
        got = predictionlog.latest(spark, path, n, label=label)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in ordering.recent(rows, n, "ingested_at", "video_id", label).collect()]
    assert len({f.split("/hour=")[1][:11] for f in predictionlog.latest(spark, path, 50).inputFiles()}) <= 4  # of 720
    everything = predictionlog.latest(spark, path, 10**6)
    assert everything.count() == rows.count()


def test_latest_with_rows_without_time(spark, tmp_path):
    rows = log_rows(spark, 30).unionByName(spark.createDataFrame([("n", "ok", None), ("m", "error", None)], "video_id string, label string, ingested_at timestamp"))
    path = str(tmp_path / "log")
    predictionlog.write_log(rows, path)
    for n in (3, 31, 40):
        got = [tuple(r) for r in predictionlog.latest(spark, path, n).collect()]
        assert got == [tuple(r) for r in ordering.recent(rows, n, "ingested_at", "video_id").collect()]
    with pytest.raises(LookupError):
        predictionlog.latest(spark, str(tmp_path / "none"), 3)


def test_view_applies_each_batch_once(spark, tmp_path):
    path = str(tmp_path / "view")
    day = lambda d: dt.datetime(2024, 1, d, 12)
    batches = [[(day(1), "a", 2), (day(2), "a", 1)], [(day(2), "b", 4), (day(1), "a", 5)], [(day(3), "a", 1)]]
    for number, rows in enumerate(batches):
        counts = spark.createDataFrame(rows, "bin timestamp, label string, n long")
        for _ in range(2):
            views.fold(path, counts, number, ["bin", "label"], views.by_day())
    got = {(r["bin"].day, r["label"]): r["n"] for r in views.read_view(spark, path).collect()}
    assert got == {(1, "a"): 7, (2, "a"): 1, (2, "b"): 4, (3, "a"): 1}
    views.fold(path, spark.createDataFrame([], "bin timestamp, label string, n long"), 9, ["bin", "label"], views.by_day())


def test_view_rerun_after_half_a_batch(spark, tmp_path):
    path = str(tmp_path / "view")
    rows = [(dt.datetime(2024, 1, 1), 1), (dt.datetime(2024, 1, 2), 1)]
    counts = spark.createDataFrame(rows, "bin timestamp, n long")
    views.fold(path, counts, 0, ["bin"], views.by_day())
    views.fold(path, counts.limit(1), 1, ["bin"], views.by_day())  # as if the batch had died between two parts
    views.fold(path, counts, 1, ["bin"], views.by_day())
    assert sorted(r["n"] for r in views.read_view(spark, path).collect()) == [2, 2]


def test_view_touches_only_its_parts(spark, tmp_path):
    path = tmp_path / "view"
    counts = spark.createDataFrame([(dt.datetime(2024, 1, d), 1) for d in (1, 2)], "bin timestamp, n long")
    views.fold(str(path), counts, 0, ["bin"], views.by_day())
    before = {p: sorted(f.name for f in p.iterdir()) for p in path.iterdir() if p.is_dir()}
    views.fold(str(path), counts.filter(F.dayofmonth("bin") == 1), 1, ["bin"], views.by_day())
    after = {p: sorted(f.name for f in p.iterdir()) for p in path.iterdir() if p.is_dir()}
    assert [p.name for p in before if before[p] != after[p]] == ["part=d20240101"]


def test_runs_count_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "x int, source string")
    with pytest.raises(LookupError):
        writers.read_runs(spark, path)
    writers.append_run(rows, path, "r1", ["source"])
    writers.append_run(rows, path, "r1", ["source"])
    writers.append_run(rows.filter("x = 1"), path, "r/2 é", ["source"])
    assert sorted(r["x"] for r in writers.read_runs(spark, path).collect()) == [1, 1, 2]
    with pytest.raises(Exception):
        writers.append_run(rows.withColumn("x", F.raise_error(F.lit("no")).cast("int")), path, "r1")
    assert sorted(r["x"] for r in writers.read_runs(spark, path).collect()) == [1, 1, 2]


def test_models_come_back(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "m"))
    assert store.current() is None
    with pytest.raises(LookupError):
        store.load()
    rows = spark.createDataFrame([(Vectors.dense([float(i), 1.0]), float(i % 2)) for i in range(20)], ["features", "label"])
    fitted = LogisticRegression(regParam=0.1).fit(rows)
    first = store.publish(fitted, {"f1": 0.5})
    loaded = store.load()
    assert not loaded.hasSummary and store.info(first)["info"] == {"f1": 0.5}
    assert [r["prediction"] for r in loaded.transform(rows).collect()] == [fitted.predict(r["features"]) for r in rows.collect()]
    numbers = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    scaler = fit_scaler(numbers, ["a", "b"])
    second = store.publish(scaler)
    again = ModelStore(spark.newSession(), str(tmp_path / "m"))
    assert again.current() == second and again.load().cols == ("a", "b")
    assert [tuple(r) for r in store.load().transform(numbers).collect()] == [tuple(r) for r in scaler.transform(numbers).collect()]
    weights = models.random_weights((3, 2, 4, 2), 8, 3)
    third = store.publish(weights, version="net", promote=False)
    assert store.current() == second and third == "net"
    inputs = [np.ones((2, d)) for d in (3, 2, 4, 2)]
    assert np.array_equal(models.fusion_logits(store.load("net"), inputs), models.fusion_logits(weights, inputs))
    store.promote(first)
    assert store.current() == first and store.versions() == sorted([first, second, "net"])
    with pytest.raises(KeyError):
        store.promote("missing")
    (tmp_path / "m" / "versions" / "half").mkdir()
    assert "half" not in store.versions()


def test_models_serve_after_a_rewrite(spark, tmp_path):
    """A session that observes frames cannot send a model with its training summary."""
    writers.write_layer(spark.range(3).toDF("x"), str(tmp_path / "t"))
    rows = spark.createDataFrame([([float(i), 1.0], i % 2, i < 15) for i in range(20)], "f array<double>, y int, t boolean")
    model, _ = models.train_classifier(rows, "f", "y", F.col("t"), grid=(0.0,))
    assert models.predict(model, rows, "f", ["y"]).count() == 20
    assert plain_model(model, spark).transform(spark.createDataFrame([(Vectors.dense([1.0, 1.0]),)], ["features"])).count() == 1
