"""Streams against the batch result, restarts and reruns."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clipsift.operators.aggregates import trend
from clipsift.streaming import events, views


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def line(ident, t, source="s"):
    return json.dumps({"video_id": ident, "source": source, "raw_path": f"p/{ident}", "timestamp": t, "metadata": {}})


def test_malformed_events_become_null_rows(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", ["nope", line("v", 1.5), '{"video_id":"w","bucket":"b"}'])
    stream = events.parse_events(events.event_source(spark, path=str(tmp_path / "in")))
    events.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    rows = sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=lambda r: r["video_id"] or "")
    assert [r["video_id"] for r in rows] == [None, "v", "w"]
    assert rows[2]["raw_path"] is None and rows[1]["timestamp"] == 1.5


def test_unknown_source_kind(spark):
    with pytest.raises(ValueError):
        events.event_source(spark, "queue")


def test_sink_scores_once_and_survives_reruns(spark, tmp_path):
    calls = []
    features = spark.createDataFrame([("a", [2.0, 0.0]), ("b", [0.0, 2.0])], "video_id string, embedding array<float>")

    def scorer(df):
        calls.append(df.count())
        return events.linear_scorer()(df)

    batch = spark.createDataFrame([("a", "s", f"p{i}", 1.0) for i in range(20)] + [("b", "s", "q", 1.0), ("zz", "s", "r", 1.0)],
                                  "video_id string, source string, raw_path string, timestamp double")
    out = str(tmp_path / "pred")
    sink = events.prediction_sink(out, features, scorer)
    sink(batch, 0)
    sink(batch, 0)
    sink(batch.limit(0), 1)
    ok = events.read_predictions(spark, out)
    assert ok.count() == 21 and calls == [2, 2]
    assert {(r["video_id"], r["label"]) for r in ok.collect()} == {("a", "Safe"), ("b", "Harmful")}
    assert [r["video_id"] for r in events.read_predictions(spark, out, "failed").collect()] == ["zz"]


def test_sink_restart_adds_only_new_files(spark, tmp_path):
    features = spark.createDataFrame([("a", [2.0, 0.0])], "video_id string, embedding array<float>")
    out = str(tmp_path / "pred")
    sink = events.prediction_sink(out, features, events.linear_scorer())
    for i in range(2):
        write_lines(tmp_path / "in", f"{i}.txt", [line("a", float(i))] * 3)
        stream = events.parse_events(events.event_source(spark, path=str(tmp_path / "in")))
        events.run_available(stream, sink, str(tmp_path / "ck"))
    got = events.read_predictions(spark, out).groupBy("timestamp").count().collect()
    assert {r["timestamp"]: r["count"] for r in got} == {0.0: 3, 1.0: 3}


def test_new_items_once_across_batches(spark, tmp_path):
    done = spark.createDataFrame([("old",)], "video_id string")
    for i, names in enumerate((["old", "a", "a"], ["a", "b"], ["b", "c", "old"])):
        write_lines(tmp_path / "in", f"{i}.txt", [line(n, float(i)) for n in names])
    stream = events.parse_events(events.event_source(spark, path=str(tmp_path / "in"), max_files=1)).select("video_id")
    events.run_to_table(events.new_items(stream, done), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted(r["video_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == ["a", "b", "c"]


@pytest.mark.parametrize("hours", [(0, 1, 2), (0, 5, 1, 2)])
def test_trend_stream_equals_batch(spark, tmp_path, hours):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    stamps = []
    for i, hour in enumerate(hours):  # a batch each, also out of time order
        own = [start + 3600 * hour + 37 * n for n in range(40)]
        write_lines(tmp_path / "in", f"{i}.txt", [line(str(t), t) for t in own])
        stamps += own
    stream = events.parse_events(events.event_source(spark, path=str(tmp_path / "in"), max_files=1)).select(
        F.timestamp_seconds("timestamp").alias("ts"), F.col("source").alias("label"))
    out = str(tmp_path / "out")
    events.run_available(views.trend_stream(stream), events.table_sink(out), str(tmp_path / "ck"), "update")
    live = {r["bin"]: r["n"] for r in views.latest(spark.read.parquet(out), "bin").collect()}
    batch = spark.createDataFrame([(t, "s") for t in stamps], "t double, label string").select(
        F.timestamp_seconds("t").alias("ts"), "label")
    assert live == {r["bin"]: r["n"] for r in trend(batch, fill=False).collect()}
    totals = str(tmp_path / "totals")
    events.run_available(views.label_counts_stream(stream), events.table_sink(totals), str(tmp_path / "ck2"), "update")
    assert sum(r["n"] for r in views.latest(spark.read.parquet(totals), "label").collect()) == len(stamps)
