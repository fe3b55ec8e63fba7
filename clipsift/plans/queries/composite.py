"""The composite jobs on the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipsift.functions.labels import binary_label
from clipsift.functions.vectors import argmax, as_doubles, collapse_multiclass, softmax, total
from clipsift.operators.joins import NUMERIC_FEATURES
from clipsift.plans import jobs
from clipsift.plans import sqltext as S
from clipsift.plans import standins as V
from clipsift.plans.queries.analytics import P, RISK_SQL, TIMED_SQL, describe_sql, trend_sql
from clipsift.plans.queries.ranking import split_sql
from clipsift.plans.queries.scalars import RULES, comment_rows, near, tree_sql, vector_sql
from clipsift.plans.queries.storage import by_id_sql, crawled_events, gold_rows
from clipsift.plans.queries.streams import event_lines
from clipsift.plans.registry import query
from clipsift.session import durable, scratch_path, setting
from clipsift.sources import writers
from clipsift.sources.readers import read_vectors
from clipsift.streaming import events
from clipsift.tables import load

# Rows that a scan decodes at once; by default 4096, which for vectors of thousands of floats is gigabytes a task.
SCAN_KEY, WIDE_SCAN = "spark.sql.parquet.columnarReaderBatchSize", "64"

MEDIA = "store://lake/bronze/"
FEATURES = "store://lake/silver/"


def labeled_bronze(spark, sf):
    root = scratch_path(spark, "bronze")
    load(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("lang").alias("label"),
        F.col("source"),
        F.when(F.col("doc_id") % 10 < 8, "train").otherwise("val").alias("split"),
    ).write.json(root)
    return root


def crawled_bronze(spark, sf):
    root = scratch_path(spark, "bronze")
    crawled_events(spark, sf).write.json(root)
    return root


@query(
    "SELECT CAST(doc_id AS STRING) AS video_id, lang AS label, source, "
    "CASE WHEN doc_id % 10 < 8 THEN 'train' ELSE 'val' END AS split, "
    "concat('store://lake/bronze/', doc_id, '/video.mp4') AS bronze_video_path, true AS stamped FROM documents"
)
def q_job_labeled_silver(spark, sf):
    out = scratch_path(spark, "silver")
    jobs.labeled_silver(spark, labeled_bronze(spark, sf), out, MEDIA, multiline=False)
    return spark.read.parquet(out).select(
        "video_id", "label", "source", "split", "bronze_video_path",
        F.col("ingested_at").isNotNull().alias("stamped"),
    )


@query(
    "SELECT event_type AS source, count(*) AS n, count(CASE WHEN event_id % 4 <> 0 THEN 1 END) AS n_likes, "
    "CAST(sum(CASE WHEN event_id % 4 <> 0 THEN user_id END) AS BIGINT) AS likes, "
    "CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS comments FROM events GROUP BY 1"
)
def q_job_crawled_silver(spark, sf):
    out = scratch_path(spark, "silver")
    jobs.crawled_silver(spark, crawled_bronze(spark, sf), out, multiline=False)
    return spark.read.parquet(out).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count("likes").alias("n_likes"), F.sum("likes").alias("likes"),
        F.sum(F.col("comments_count").try_cast("long")).alias("comments"),
    )


@query(
    "SELECT 'training_set' AS name, CAST(doc_id AS STRING) AS video_id, "
    "concat('store://lake/silver/', doc_id, '/video_embedding.npy') AS video_feat_path, "
    "concat('store://lake/silver/', doc_id, '/audio_embedding.npy') AS audio_feat_path FROM documents "
    "WHERE doc_id IN (SELECT vec_id FROM embeddings) UNION ALL "
    "SELECT 'inference_set', CAST(event_id AS STRING), concat('store://lake/silver/', event_id, '/video_embedding.npy'), NULL "
    "FROM events WHERE event_id IN (SELECT vec_id FROM embeddings)"
)
def q_job_gold_sets(spark, sf):
    root = scratch_path(spark, "medallion")
    labeled, crawled = f"{root}/silver/labeled", f"{root}/silver/crawled"
    jobs.labeled_silver(spark, labeled_bronze(spark, sf), labeled, MEDIA, multiline=False)
    jobs.crawled_silver(spark, crawled_bronze(spark, sf), crawled, multiline=False)
    ready = load(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("video_id"))
    sets = jobs.gold_sets(spark, labeled, crawled, f"{root}/gold", FEATURES, ready)
    return spark.read.parquet(sets["training_set"]).select(
        F.lit("training_set").alias("name"), "video_id", "video_feat_path", "audio_feat_path"
    ).unionByName(
        spark.read.parquet(sets["inference_set"]).select(
            F.lit("inference_set").alias("name"), "video_id", "video_feat_path"
        ),
        allowMissingColumns=True,
    )


@query(
    "SELECT 'training_set' AS name, count(*) AS n, count(DISTINCT doc_id) AS n_ids FROM documents UNION ALL "
    "SELECT 'inference_set', count(*), count(DISTINCT event_id) FROM events"
)
def q_job_batch_etl(spark, sf):
    bronze = {"labeled": labeled_bronze(spark, sf), "crawled": crawled_bronze(spark, sf)}
    sets = jobs.batch_etl(spark, bronze, scratch_path(spark, "medallion"), MEDIA, FEATURES, multiline=False)
    parts = [
        spark.read.parquet(path).agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.count_distinct("video_id").alias("n_ids")
        )
        for name, path in sorted(sets.items())
    ]
    return parts[0].unionByName(parts[1])


_params = ", ".join(
    f"avg({n}) AS m_{n}, CASE WHEN stddev_pop({n}) > 0 THEN stddev_pop({n}) ELSE 1 END AS s_{n}"
    for n in NUMERIC_FEATURES
)
_scaled = ", ".join(f"{S.near(f'({n} - m_{n}) / s_{n}', 3)} AS {n}" for n in NUMERIC_FEATURES)
_raw = ", ".join(f"{S.near(n, 6)} AS raw_{n}" for n in NUMERIC_FEATURES)
_no_tags = r"regexp_replace(text, '#\S+', '', 'g')"


@query(f"""
  WITH v AS MATERIALIZED (SELECT * FROM {vector_sql(None)}), p AS (SELECT {_params} FROM v),
  d AS (SELECT CAST(doc_id AS STRING) AS id, {S.clean(_no_tags)} AS t,
          regexp_extract_all(lower(tags), '[^#\\s]+') AS tag FROM {V.CAPTIONS.sql}),
  c AS (SELECT video_id, string_agg({S.clean('text')}, ' [SEP] ' ORDER BY pos) AS said FROM {tree_sql()} GROUP BY video_id)
  SELECT v.video_id, {_scaled}, {_raw}, CASE WHEN coalesce(t, '') = '' THEN 0e0 ELSE 1e0 END AS desc_norm,
         CASE WHEN coalesce(said, '') = '' THEN 0e0 ELSE 1e0 END AS comments_norm,
         count(*) OVER (PARTITION BY coalesce(said, '')) AS alike_comments,
         min(v.video_id) OVER (PARTITION BY coalesce(list_sort(tag), [])) AS first_alike_tags
  FROM v, p LEFT JOIN d ON v.video_id = d.id LEFT JOIN c ON v.video_id = c.video_id""")
def q_job_metadata_features(spark, sf):
    captions = V.CAPTIONS.df(spark, sf).select(
        F.col("doc_id").cast("string").alias("video_id"), F.col("text").alias("description"),
        F.split("tags", " ").alias("tags"),
    )
    posts = V.POSTS.df(spark, sf).join(captions, "video_id", "left")
    out = scratch_path(spark, "silver")
    jobs.metadata_features(posts, 4096, comments=comment_rows(spark, sf), sparse=True, **RULES).write.parquet(out)
    return digests(spark, out)


def digests(spark, silver):
    """The numbers of stored metadata features, the norms of their vectors, and which vectors are alike."""

    def floats(vector):
        return F.col(f"{vector}.values").cast("array<float>")

    def norm(vector):
        return F.round(F.sqrt(total(F.transform(as_doubles(floats(vector)), lambda x: x * x))), 4)

    def marks(vector):
        parts = (f"{vector}.size", f"{vector}.indices", floats(vector))
        return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))

    # Equal texts have equal vectors, and different ones do not.
    names = {f"{v}_hash": marks(v) for v in ("comments_emb", "tags_emb")}
    found = read_vectors(spark, silver).select(
        "video_id",
        *[near(F.get("numeric_scaled", F.lit(i)), 3).alias(n) for i, n in enumerate(NUMERIC_FEATURES)],
        *[near(F.get("numeric_raw", F.lit(i))).alias(f"raw_{n}") for i, n in enumerate(NUMERIC_FEATURES)],
        norm("desc_emb").alias("desc_norm"), norm("comments_emb").alias("comments_norm"),
        *[value.alias(name) for name, value in names.items()],
    )
    # The vectors are read once and go into no shuffle.
    with setting(spark, SCAN_KEY, WIDE_SCAN):
        rows = durable(found, "digests")
    comments = rows.groupBy("comments_emb_hash").agg(F.count(F.lit(1)).alias("alike_comments"))
    tags = rows.groupBy("tags_emb_hash").agg(F.min("video_id").alias("first_alike_tags"))
    return rows.join(comments, "comments_emb_hash").join(tags, "tags_emb_hash").drop(*names)


def stored_silver(spark, sf):
    """Features already there: the embeddings of labelled items."""
    rows = load(spark, sf, "embeddings").join(
        load(spark, sf, "labels").select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi"
    )
    return rows.select(
        F.col("vec_id").cast("string").alias("video_id"),
        F.slice("embedding", 1, 32).alias("video_emb"),
        F.slice("embedding", 33, 32).alias("audio_emb"),
        F.slice("embedding", 1, 25).alias("numeric_scaled"),
        F.slice("embedding", 17, 16).alias("comments_emb"),
    )


def build_features(spark, sf):
    """Builder for items without stored features: text counts stand for the encoders."""
    docs = load(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("video_id"), "n_chars", "lang")

    def build(items):
        n = F.col("n_chars").cast("float")
        return items.join(docs, "video_id").select(
            "video_id",
            F.array_repeat(n, 32).alias("video_emb"),
            F.when(F.col("lang") != "es", F.array_repeat(n, 32)).alias("audio_emb"),
            F.array_repeat(n, 25).alias("numeric_scaled"),
            F.array_repeat(n, 16).alias("comments_emb"),
        )

    return build


def known_labels(spark, sf):
    return load(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("video_id"), F.col("quality").alias("label")
    )


FULL_SQL = (
    "(SELECT CAST(d.doc_id AS STRING) AS video_id, coalesce(quality, -1)::BIGINT AS label, 22 AS n_meta, "
    "CASE WHEN l.doc_id IS NOT NULL AND vec_id IS NOT NULL THEN ROUND(embedding[1]::DOUBLE, 6) ELSE "
    "CAST(n_chars AS DOUBLE) END AS v0 FROM documents d LEFT JOIN embeddings ON vec_id = d.doc_id "
    "LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE (l.doc_id IS NOT NULL AND vec_id IS NOT NULL) OR lang <> 'es')"
)


@query(f"SELECT * FROM {FULL_SQL}")
def q_job_full_features(spark, sf):
    items = load(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("video_id"))
    rows = jobs.full_features(items, stored_silver(spark, sf), build_features(spark, sf), known_labels(spark, sf))
    out = scratch_path(spark, "gold")
    jobs.writers.write_gold(rows, out)
    return spark.read.parquet(out).select(
        "video_id", "label", F.size("metadata_numeric").alias("n_meta"),
        F.round(F.get("video_emb", F.lit(0)).cast("double"), 6).alias("v0"),
    )


@query(
    f"WITH e AS (SELECT DISTINCT video_id FROM {V.EVENTS.sql}), "
    "n AS (SELECT video_id FROM e WHERE video_id NOT IN "
    "(SELECT CAST(vec_id AS STRING) FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels))), "
    "r AS (SELECT n.video_id, d.doc_id IS NOT NULL AS ready, CASE WHEN lang = 'es' THEN 0 ELSE n_chars END AS audio, "
    "coalesce(quality, -1) AS label FROM n LEFT JOIN documents d ON CAST(d.doc_id AS STRING) = n.video_id "
    "LEFT JOIN labels l ON l.doc_id = d.doc_id) "
    "SELECT video_id, CASE WHEN ready THEN 'watcher' END AS source, "
    "CASE WHEN ready THEN concat('bronze/', video_id, '/video.mp4') END AS raw_path, "
    "CASE WHEN ready THEN 'ready' ELSE 'failed' END AS status, CASE WHEN ready THEN CAST(audio AS DOUBLE) END AS audio, "
    "CASE WHEN ready THEN CAST(label AS BIGINT) END AS label FROM r"
)
def q_job_incremental(spark, sf):
    """Several batches; the last holds only items that fail."""
    root, lines = scratch_path(spark, "watcher"), scratch_path(spark, "events")
    rows = V.EVENTS.df(spark, sf).select("video_id", F.struct("video_id", "source", "raw_path", "timestamp").alias("e"))
    docs = load(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("video_id"), F.lit(1).alias("fine"))
    kind = F.when(F.col("fine").isNull(), 3).otherwise(F.pmod(F.xxhash64("e.raw_path"), F.lit(3)))
    # Joined once, by all tasks: the one that writes a file only passes lines on.
    ordered = durable(rows.join(docs, "video_id", "left").select(F.to_json("e").alias("value"), kind.alias("file")), "lines")
    for file in range(4):  # a batch each, the failures last
        ordered.filter(F.col("file") == file).select("value").coalesce(1).write.mode("append").text(lines)
    silver = scratch_path(spark, "silver")
    stored_silver(spark, sf).write.parquet(silver)
    stream = events.parse_events(events.event_source(spark, path=lines, max_files=1))
    jobs.incremental(
        stream, silver, build_features(spark, sf), root, scratch_path(spark, "ckpt"),
        labels=known_labels(spark, sf), audio_width=32, buckets=16,
    )
    ready = events.parse_events(spark.read.text(f"{root}/events").select("value")).select(
        "video_id", "source", "raw_path", F.col("metadata")["status"].alias("status")
    )
    gold = spark.read.parquet(f"{root}/gold").select(
        "video_id", F.get("audio_emb", F.lit(0)).cast("double").alias("audio"), "label"
    )
    failed = spark.read.parquet(f"{root}/failed").select("video_id").distinct().withColumn("status", F.lit("failed"))
    return ready.join(gold, "video_id").unionByName(failed, allowMissingColumns=True)


@query(
    "SELECT CAST(vec_id AS STRING) AS video_id, CAST(coalesce(t.label, quality, -1) AS BIGINT) AS label, "
    "count(*) FILTER (WHERE t.label IS NOT NULL AND t.label <> coalesce(quality, -1)) OVER () AS updated_count "
    f"FROM embeddings LEFT JOIN labels ON vec_id = doc_id LEFT JOIN {by_id_sql(V.TASKS_A.sql)} t "
    "ON t.video_id = CAST(vec_id AS STRING)"
)
def q_job_label_refresh(spark, sf):
    """A gold table refreshed in place and read back."""
    path = scratch_path(spark, "gold")
    writers.write_gold(gold_rows(spark, sf), path)
    counts = jobs.label_refresh(spark.read.parquet(path), V.TASKS_A.df(spark, sf), "task", "ordinal", path)
    return spark.read.parquet(path).select("video_id", "label", counts.select("updated_count").scalar().alias("updated_count"))


def _four(df):
    both = collapse_multiclass(softmax(F.slice("embedding", 1, 4)))
    return df.withColumn("b", both).select("video_id", "label", F.col("b.pred").alias("pred"), F.col("b.prob").alias("prob"))


def _two(df):
    probs = softmax(F.slice("embedding", 5, 2))
    return df.withColumn("p", probs).select(
        "video_id", "label", argmax(F.col("p")).alias("pred"), F.get("p", F.lit(1)).alias("prob")
    )


EVAL_SQL = f"""
  WITH s AS MATERIALIZED ({split_sql('embeddings', 'vec_id', 0.8)}),
  v AS (SELECT vec_id, CASE WHEN label > 0 THEN 1 ELSE 0 END AS label, embedding FROM embeddings
        JOIN s USING (vec_id) WHERE split = 'val'),
  e AS (SELECT label, [exp(embedding[1]::DOUBLE), exp(embedding[2]::DOUBLE), exp(embedding[3]::DOUBLE), exp(embedding[4]::DOUBLE)] AS a,
        embedding[6]::DOUBLE - embedding[5]::DOUBLE AS z FROM v),
  r AS (SELECT 'base' AS model, label, CASE WHEN a[1] >= list_max(a) THEN 0 ELSE 1 END AS pred,
          1 - a[1] / list_sum(a) AS prob FROM e
        UNION ALL SELECT 'other', label, CASE WHEN z > 0 THEN 1 ELSE 0 END, 1 / (1 + exp(-z)) FROM e),
  c AS (SELECT model, count(*) FILTER (WHERE label = 1 AND pred = 1)::DOUBLE AS tp,
          count(*) FILTER (WHERE label = 0 AND pred = 1)::DOUBLE AS fp,
          count(*) FILTER (WHERE label = 1 AND pred = 0)::DOUBLE AS fn,
          count(*) FILTER (WHERE label = 0 AND pred = 0)::DOUBLE AS tn FROM r GROUP BY model),
  u AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY prob)
          + (count(*) OVER (PARTITION BY model, prob) - 1) / 2e0 AS k FROM r),
  m AS (SELECT model, 'acc' AS metric, (tp + tn) / (tp + fp + fn + tn) AS value FROM c
    UNION ALL SELECT model, 'prec', coalesce(tp / nullif(tp + fp, 0), 0) FROM c
    UNION ALL SELECT model, 'rec', coalesce(tp / nullif(tp + fn, 0), 0) FROM c
    UNION ALL SELECT model, 'f1', coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) FROM c
    UNION ALL SELECT model, 'auc', coalesce((sum(k) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2e0)
      / nullif(sum(label) * sum(1 - label), 0), 0) FROM u GROUP BY model)
  SELECT metric, ROUND(max(value) FILTER (WHERE model = 'base'), 6) AS base,
    ROUND(max(value) FILTER (WHERE model = 'other'), 6) AS other,
    ROUND(max(value) FILTER (WHERE model = 'other') - max(value) FILTER (WHERE model = 'base'), 6) AS diff
  FROM m GROUP BY metric"""


@query(EVAL_SQL)
def q_job_evaluation(spark, sf):
    gold = load(spark, sf, "embeddings").select(
        F.col("vec_id").alias("video_id"), binary_label(F.col("label")).alias("label"), "embedding"
    )
    side = jobs.evaluation(gold, {"base": _four, "other": _two}, "base", "other")
    return side.select("metric", *[F.round(c, 6).alias(c) for c in ("base", "other", "diff")])


_stats = ["count", "mean", "std", "min", "p50", "p90", "p95", "p99", "max"]
_secs = "(epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) / 1e6"


@query(
    "WITH d AS (" + describe_sql(TIMED_SQL, 3) + ") "
    + " UNION ALL ".join(f"SELECT metric, '{s}' AS stat, {s}::DOUBLE AS value FROM d" for s in _stats)
    + f" UNION ALL SELECT 'throughput', 'n', count(*)::DOUBLE FROM {P}"
    + f" UNION ALL SELECT 'throughput', 'seconds', ROUND({_secs}, 3) FROM {P}"
    + f" UNION ALL SELECT 'throughput', 'per_sec', ROUND(count(*) / ({_secs} + 0.001), 3) FROM {P}"
    + f" UNION ALL SELECT 'overhead', 'overhead_ms', ROUND(avg(e2e) * 1000 - avg(inference), 3) FROM {TIMED_SQL}"
)
def q_job_latency_report(spark, sf):
    report = jobs.latency_report(V.PREDICTIONS.df(spark, sf))
    return report.withColumn("value", F.round("value", 3))


@query(
    "SELECT 'labels' AS section, coalesce(nullif(label, ''), 'Unknown') AS item, count(*)::DOUBLE AS n, NULL::VARCHAR AS note "
    f"FROM {P} GROUP BY 2 UNION ALL SELECT 'risk', 'error', total::DOUBLE, risk_text FROM ({RISK_SQL}) UNION ALL "
    "SELECT 'recent', video_id, NULL, concat('http://console.example/bronze/', video_id, '/video.mp4') FROM "
    f"(SELECT video_id FROM {P} WHERE label = 'error' ORDER BY ingested_at DESC, video_id LIMIT 50) UNION ALL "
    f"SELECT 'trend', strftime(bin, '%Y-%m-%d %H:%M:%S'), n::DOUBLE, NULL FROM ({trend_sql(5)})"
)
def q_job_dashboard(spark, sf):
    return jobs.dashboard(
        V.PREDICTIONS.df(spark, sf), "error", "http://console.example/bronze/{}/video.mp4", "error"
    )
