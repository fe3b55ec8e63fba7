"""Streaming operators, run over everything that is there and read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipsift.plans import standins as V
from clipsift.plans.queries.analytics import trend_sql
from clipsift.plans.queries.relational import SCORED_SQL, item_features
from clipsift.plans.registry import query
from clipsift.session import scratch_path
from clipsift.sources.featurestore import FeatureStore, SeenIds
from clipsift.streaming import events, views
from clipsift.tables import load


def event_lines(spark, sf, *extra, files=None):
    """Folder of event JSON lines, with ``extra`` lines after each event.

    With ``files`` they are dealt into so many, the latest events first.
    """
    root = scratch_path(spark, "events")
    rows = V.EVENTS.df(spark, sf)
    line = events.event_json(
        F.col("video_id"), F.col("source"), F.col("raw_path"), F.col("timestamp"),
        F.from_json("props", "map<string,string>"),
    )
    if extra:
        line = F.explode(F.array(line, *[F.lit(e) for e in extra]))
    if files:
        rows = rows.repartitionByRange(files, F.desc("timestamp"))
    events.emit_events(rows.select(line.alias("value")), root)
    return root


E = V.EVENTS.sql


@query(
    f"SELECT video_id, source, raw_path, timestamp, json_extract_string(props, '$.k') AS k FROM {E} "
    f"UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM {E} "
    f"UNION ALL SELECT 'x', NULL, NULL, NULL, NULL FROM {E}"
)
def q_stream_parse(spark, sf):
    root = event_lines(spark, sf, "not json", '{"video_id": "x", "status": "ready", "bucket": "b"}')
    out, ckpt = scratch_path(spark, "parsed"), scratch_path(spark, "ckpt")
    events.run_to_table(events.parse_events(events.event_source(spark, path=root)), out, ckpt)
    rows = spark.read.parquet(out)
    return rows.select("video_id", "source", "raw_path", "timestamp", F.col("metadata")["k"].alias("k"))


def _sunk(spark, sf):
    root = event_lines(spark, sf)
    out = scratch_path(spark, "predictions")
    store = FeatureStore(spark, scratch_path(spark, "features"), buckets=16)
    store.put(item_features(spark, sf))
    sink = events.prediction_sink(out, store, events.linear_scorer())
    stream = events.parse_events(events.event_source(spark, path=root))
    events.run_available(stream, sink, scratch_path(spark, "ckpt"))
    return out


@query(
    "SELECT CASE WHEN label IS NULL THEN 'dead' ELSE 'ok' END AS outcome, e.source, count(*) AS n, "
    f"count(DISTINCT e.raw_path) AS n_paths FROM {SCORED_SQL} s JOIN {E} e USING (event_id) GROUP BY 1, 2"
)
def q_stream_sink(spark, sf):
    out = _sunk(spark, sf)
    ok, dead = (events.read_predictions(spark, out, o) for o in ("ok", "failed"))
    both = ok.select(F.lit("ok").alias("outcome"), "source", "raw_path").unionByName(
        dead.select(F.lit("dead").alias("outcome"), "source", "raw_path")
    )
    return both.groupBy("outcome", "source").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("raw_path").alias("n_paths")
    )


@query(
    "SELECT e.raw_path, s.video_id, label, label_id, confidence, p_harmful "
    f"FROM {SCORED_SQL} s JOIN {E} e USING (event_id) WHERE label IS NOT NULL"
)
def q_stream_score(spark, sf):
    return events.read_predictions(spark, _sunk(spark, sf)).select(
        "raw_path", "video_id", "label", "label_id", F.round("confidence", 6).alias("confidence"),
        F.round(F.col("probabilities")["Harmful"], 6).alias("p_harmful"),
    )


@query(
    "SELECT video_id, source, raw_path, timestamp, json_extract_string(props, '$.k') AS k, "
    f"CAST(1 AS INTEGER) AS n_meta FROM {E}"
)
def q_emit_events(spark, sf):
    lines = spark.read.text(event_lines(spark, sf)).select("value")
    return events.parse_events(lines).select(
        "video_id", "source", "raw_path", "timestamp", F.col("metadata")["k"].alias("k"),
        F.size("metadata").alias("n_meta"),
    )


@query(
    f"SELECT DISTINCT video_id FROM {E} WHERE video_id NOT IN (SELECT CAST(doc_id AS STRING) FROM labels)"
)
def q_stream_new_ids(spark, sf):
    """Four batches against an index of ids, without stream state."""
    root = event_lines(spark, sf, files=4)
    seen = SeenIds(spark, scratch_path(spark, "seen"), buckets=16)
    seen.add_outside(load(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("video_id")))
    stream = events.parse_events(events.event_source(spark, path=root, max_files=1)).select("video_id")
    out = scratch_path(spark, "new")
    events.run_available(stream, events.new_ids_sink(out, seen), scratch_path(spark, "ckpt"))
    return spark.read.parquet(out).select("video_id")


def _view(spark, sf, view, part, *keys):
    """Four batches, each folded into the maintained view."""
    root = event_lines(spark, sf, files=4)
    stream = events.parse_events(events.event_source(spark, path=root, max_files=1)).select(
        F.timestamp_seconds("timestamp").alias("ts"), F.col("source").alias("label")
    )
    out = scratch_path(spark, "view")
    events.run_available(stream, views.view_sink(out, view, keys, part), scratch_path(spark, "ckpt"))
    rows = views.read_view(spark, out)
    return rows.withColumn("bin", F.col("bin").cast("timestamp_ntz")) if "bin" in keys else rows


_binned = "(SELECT ts AS ingested_at, event_type AS label FROM events)"


@query(f"SELECT time_bucket(INTERVAL 5 MINUTE, ingested_at) AS bin, count(label) AS n FROM {_binned} GROUP BY 1")
def q_stream_trend(spark, sf):
    return _view(spark, sf, views.trend_stream, views.by_day(), "bin")


@query(
    "SELECT time_bucket(INTERVAL 60 MINUTE, ingested_at) AS bin, label, count(*) AS n "
    f"FROM {_binned} GROUP BY 1, 2"
)
def q_stream_label_counts(spark, sf):
    return _view(
        spark, sf, lambda s: views.label_counts_stream(s, every="1 hour"), views.by_day(), "bin", "label"
    )


@query(f"SELECT label, count(*) AS n FROM {_binned} GROUP BY 1")
def q_stream_label_totals(spark, sf):
    return _view(spark, sf, views.label_counts_stream, views.whole(), "label")
