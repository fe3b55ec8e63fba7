"""Ordering, limits, sampling and comment trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipsift.operators import comments, ordering, sampling
from clipsift.plans import standins as V
from clipsift.plans.queries.scalars import tree_sql
from clipsift.plans.registry import query
from clipsift.session import scratch_path
from clipsift.sources import predictionlog
from clipsift.tables import load

P = V.PREDICTIONS.sql


@query(
    f"SELECT video_id, label, processing_time, ingested_at FROM {P} WHERE label = 'error' "
    "ORDER BY ingested_at DESC, video_id LIMIT 50"
)
def q_recent_topn(spark, sf):
    return ordering.recent(
        V.PREDICTIONS.df(spark, sf), 50, "ingested_at", "video_id", "error",
        columns=["video_id", "label", "processing_time", "ingested_at"],
    )


@query(
    f"SELECT video_id, label, processing_time, ingested_at FROM {P} WHERE label = 'error' "
    "ORDER BY ingested_at DESC, video_id LIMIT 50"
)
def q_latest_from_log(spark, sf):
    """The same from a log in hourly folders, of which only the newest are opened."""
    path = scratch_path(spark, "log")
    predictionlog.write_log(V.PREDICTIONS.df(spark, sf), path)
    return predictionlog.latest(
        spark, path, 50, label="error", columns=["video_id", "label", "processing_time", "ingested_at"]
    )


@query(f"SELECT ingested_at, label FROM {P} ORDER BY ingested_at DESC, video_id LIMIT 2000")
def q_recent_2000(spark, sf):
    return ordering.recent(
        V.PREDICTIONS.df(spark, sf), 2000, "ingested_at", "video_id", columns=["ingested_at", "label"]
    )


@query(f"SELECT * FROM {tree_sql(1, 4)}")
def q_build_comment_tree(spark, sf):
    return comments.build_comment_tree(V.COMMENTS.df(spark, sf), max_total=4, max_replies=1)


@query(
    "SELECT video_id, row_number() OVER (PARTITION BY video_id ORDER BY pos) - 1 AS idx, text "
    f"FROM {tree_sql()}"
)
def q_flatten_comments(spark, sf):
    return comments.flatten_comment_rows(comments.build_comment_tree(V.COMMENTS.df(spark, sf)))


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(concat(c_custkey, ':42')), c_custkey LIMIT 50")
def q_seeded_sample(spark, sf):
    return sampling.seeded_sample(load(spark, sf, "customer"), 50, "c_custkey").select("c_custkey", "c_name")


@query("SELECT user_id, value, min(event_id) AS event_id FROM events GROUP BY user_id, value")
def q_dedup_first(spark, sf):
    rows = load(spark, sf, "events").select(F.struct("user_id", "value").alias("v"), "event_id")
    return ordering.dedup_first(rows, "v", "event_id").select("v.user_id", "v.value", "event_id")


def split_sql(table: str, key: str, ratio: float) -> str:
    return (
        f"SELECT {key}, CASE WHEN row_number() OVER (ORDER BY md5(concat({key}, ':42')), {key}) "
        f"<= floor((SELECT count(*) FROM {table}) * {ratio}) THEN 'train' ELSE 'val' END AS split FROM {table}"
    )


@query(split_sql("documents", "doc_id", 0.9))
def q_train_val_split(spark, sf):
    return sampling.split(load(spark, sf, "documents").select("doc_id"), 0.9, "doc_id")


@query(
    "SELECT path, (row_number() OVER (ORDER BY path) - 1) // 30 AS batch FROM "
    f"{V.MEDIA_PATHS.sql} QUALIFY batch >= 3"
)
def q_chunk_batches(spark, sf):
    return ordering.chunk(V.MEDIA_PATHS.df(spark, sf), 30, ["path"], start=3)


def _minute():
    return F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / F.lit(60))


def sample_sql(k: int) -> str:
    return (
        "WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, "
        "count(*) OVER (PARTITION BY user_id) AS n FROM events) "
        f"SELECT user_id, event_id, CAST(j AS INTEGER) AS sample_no FROM r JOIN range({k}) t(j) ON i = (j * (n - 1)) // {k - 1}"
    )


def _uniform(spark, sf, k):
    rows = load(spark, sf, "events").select("user_id", "event_id", "ts")
    picked = sampling.uniform_sample(rows, ["user_id"], ["ts", "event_id"], k, bucket=_minute())
    return picked.select("user_id", "event_id", "sample_no")


@query(sample_sql(16))
def q_uniform_sample(spark, sf):
    return _uniform(spark, sf, 16)


@query(sample_sql(100))
def q_uniform_sample_repeats(spark, sf):
    return _uniform(spark, sf, 100)


@query(
    "SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS frame_no "
    "FROM events QUALIFY frame_no <= 60 AND count(*) OVER (PARTITION BY user_id) >= 60"
)
def q_first_k_frames(spark, sf):
    rows = load(spark, sf, "events").select("user_id", "event_id", "ts")
    return sampling.first_k(rows, ["user_id"], ["ts", "event_id"], 60).select("user_id", "event_id", "frame_no")


@query("""
  WITH d AS (SELECT source, md5(text) AS ident, min(doc_id) AS doc_id FROM documents GROUP BY 1, 2),
  c AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, ident) AS rank_in_source FROM d),
  k AS (SELECT * FROM c WHERE rank_in_source <= 20 AND ident NOT IN
    (SELECT md5(text) FROM documents JOIN labels USING (doc_id) WHERE toxic = 1))
  SELECT ident, source, doc_id, CAST(rank_in_source AS INTEGER) AS rank_in_source FROM k
  QUALIFY row_number() OVER (PARTITION BY ident ORDER BY doc_id, source) = 1""")
def q_cap_per_source(spark, sf):
    docs = load(spark, sf, "documents").select("source", "doc_id", F.md5("text").alias("ident"))
    seen = docs.join(load(spark, sf, "labels").filter("toxic = 1"), "doc_id", "left_semi").select("ident")
    return ordering.cap_per_source(docs, "source", "ident", "doc_id", 20, seen)
