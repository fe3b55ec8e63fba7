"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipsift.functions.ids import layer_id
from clipsift.functions.labels import verification_label
from clipsift.operators import joins, metrics, sets
from clipsift.operators.projections import last_wins
from clipsift.plans import standins as V
from clipsift.plans.queries.storage import by_id_sql, by_path_sql
from clipsift.plans.registry import query
from clipsift.sources import annotations
from clipsift.streaming.events import linear_scorer, score_events
from clipsift.tables import load


def feature_layers(spark, sf):
    """Video, audio and metadata features keyed by doc_id."""
    emb = load(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id")
    video = emb.select("doc_id", F.slice("embedding", 1, 32).alias("video_emb"))
    audio = emb.select("doc_id", F.slice("embedding", 33, 32).alias("audio_emb"))
    numeric = F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: (i + F.col("n_chars")).cast("float"))
    meta = load(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 8 != 0, numeric).alias("numeric_scaled"),
        F.array(F.col("n_chars").cast("float")).alias("comments_emb"),
    )
    labels = load(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return video, audio, meta, labels


@query(
    "SELECT d.doc_id, coalesce(quality, -1) AS label, 32 AS n_video, 22 AS n_meta, "
    "ROUND(embedding[33]::DOUBLE, 6) AS a0, CAST(22 * n_chars + 300 - 16 - 21 - 23 AS DOUBLE) AS meta_sum "
    "FROM documents d JOIN embeddings ON d.doc_id = vec_id LEFT JOIN labels l ON l.doc_id = d.doc_id "
    "WHERE d.doc_id % 8 <> 0"
)
def q_assemble_features(spark, sf):
    rows = joins.assemble_features(*feature_layers(spark, sf), key="doc_id")
    total = F.aggregate("metadata_numeric", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select(
        "doc_id", "label", F.size("video_emb").alias("n_video"), F.size("metadata_numeric").alias("n_meta"),
        F.round(F.get("audio_emb", F.lit(0)).cast("double"), 6).alias("a0"), total.alias("meta_sum"),
    )


_GOLD = "CASE doc_id % 4 WHEN 0 THEN '3' WHEN 1 THEN '\"Adult\"' WHEN 2 THEN 'null' ELSE '0' END"
_SILVER = "CASE doc_id % 3 WHEN 0 THEN 'null' WHEN 1 THEN '\"Safe\"' ELSE '1' END"
_LABEL = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'Safe' WHEN 3 THEN 'self-harm' ELSE '1' END"
_RAW = "CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'Adult Content' ELSE 'safe' END"


@query(f"""
  WITH b AS (SELECT doc_id, {_LABEL} AS label, {_RAW} AS raw FROM documents),
  m AS (SELECT doc_id, CASE label WHEN 'Safe' THEN 0 WHEN 'self-harm' THEN 3 WHEN '1' THEN 2 END AS by_label,
    CASE raw WHEN 'Adult Content' THEN 1 WHEN 'safe' THEN 0 END AS by_raw, raw FROM b),
  j AS (SELECT m.*, coalesce(by_label, by_raw, CASE WHEN raw = '' THEN 2 END) AS bronze,
    coalesce(by_label, by_raw) AS given,
    CASE WHEN l.toxic = 1 THEN CASE m.doc_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 3 THEN 0 END END AS gold,
    CASE WHEN l.doc_id IS NOT NULL THEN CASE m.doc_id % 3 WHEN 1 THEN 0 WHEN 2 THEN 1 END END AS silver
    FROM m LEFT JOIN labels l ON l.doc_id = m.doc_id)
  SELECT doc_id, coalesce(gold, silver, bronze) AS stored_label,
    coalesce(silver, given, gold, silver, bronze, -1) AS row_label FROM j""")
def q_resolve_label(spark, sf):
    docs, known = load(spark, sf, "documents"), load(spark, sf, "labels")
    return joins.resolve_label(
        docs.select("doc_id"),
        known.filter("toxic = 1").selectExpr("doc_id", f"{_GOLD} AS label"),
        known.selectExpr("doc_id", f"{_SILVER} AS label"),
        docs.selectExpr("doc_id", f"{_LABEL} AS label", f"{_RAW} AS label_raw"),
        key="doc_id",
    )


def labelled_set(spark, sf):
    return load(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"), (F.col("doc_id") % 3).cast("int").alias("label")
    )


_SET = "(SELECT CAST(doc_id AS STRING) AS video_id, CAST(doc_id % 3 AS INTEGER) AS label FROM documents)"


@query(
    "SELECT video_id, coalesce(n.label, d.label) AS label, n.label IS NOT NULL AND n.label <> d.label AS changed "
    f"FROM {_SET} d LEFT JOIN {by_id_sql(V.TASKS_A.sql)} n USING (video_id)"
)
def q_update_labels(spark, sf):
    found = annotations.parse_annotations(V.TASKS_A.df(spark, sf), "task", "ordinal")
    return joins.update_labels(labelled_set(spark, sf), found).select("video_id", "label", "changed")


def manual_labels(spark, sf):
    tasks = annotations.parse_tasks(V.TASKS_A.df(spark, sf), "task", "ordinal")
    named = tasks.select(
        "ordinal", layer_id(F.col("path")).alias("video_id"),
        verification_label(F.get("choices", F.lit(0))).alias("label"),
    ).filter("video_id is not null and label is not null")
    return last_wins(named, "video_id", "label", "ordinal")


_MANUAL = (
    "(SELECT split_part(path, '/', -2) AS video_id, arg_max(CASE choice WHEN 'SAFE' THEN 0 ELSE 1 END, ordinal) "
    "AS label FROM (SELECT ordinal, json_extract_string(task, '$.data.video') AS path, "
    "json_extract_string(task, '$.annotations[0].result[0].value.choices[0]') AS choice "
    f"FROM {V.TASKS_A.sql}) WHERE contains(path, 'bronze/') AND choice IS NOT NULL GROUP BY 1)"
)
_VERIFIED = (
    "(SELECT video_id, CASE WHEN m.label IS NULL THEN 'missing' WHEN m.label = d.label THEN 'match' "
    f"ELSE 'mismatch' END AS status, coalesce(m.label, d.label) AS verified_label FROM {_SET} d "
    f"LEFT JOIN {_MANUAL} m USING (video_id))"
)


@query(f"SELECT * FROM {_VERIFIED}")
def q_verify_labels(spark, sf):
    verified = joins.verify_labels(labelled_set(spark, sf), manual_labels(spark, sf))
    return verified.select("video_id", "status", "verified_label")


@query(
    "SELECT count(*) FILTER (WHERE status = 'match') AS match, count(*) FILTER (WHERE status = 'mismatch') AS "
    "mismatch, count(*) FILTER (WHERE status = 'missing') AS missing, count(*) FILTER (WHERE status = 'mismatch') > 0 "
    f"OR count(*) FILTER (WHERE status = 'missing') = 0 AS publish FROM {_VERIFIED}"
)
def q_verification_summary(spark, sf):
    verified = joins.verify_labels(labelled_set(spark, sf), manual_labels(spark, sf))
    return joins.verification_summary(verified)


def overlap(spark, sf):
    a, b = (
        annotations.parse_annotations_by_path(v.df(spark, sf), "task", "ordinal")
        for v in (V.TASKS_A, V.TASKS_B)
    )
    return joins.annotator_overlap(a, b, "path")


OVERLAP_SQL = (
    f"(SELECT path, a.choice AS y1, b.choice AS y2 FROM {by_path_sql(V.TASKS_A.sql)} a "
    f"JOIN {by_path_sql(V.TASKS_B.sql)} b USING (path))"
)


@query(f"SELECT * FROM {OVERLAP_SQL}")
def q_annotator_overlap(spark, sf):
    return overlap(spark, sf)


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_unseen_ids(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "source")
    return joins.unseen(docs, load(spark, sf, "labels"), "doc_id")


@query("SELECT doc_id, doc_id IN (SELECT vec_id FROM embeddings) AS reused FROM documents")
def q_resume_split(spark, sf):
    done = load(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return joins.resume_split(load(spark, sf, "documents").select("doc_id"), done, "doc_id")


def model_rows(spark, sf):
    """Two models' answers on the labelled documents."""
    docs = load(spark, sf, "documents").select("doc_id", "n_chars")
    base = load(spark, sf, "labels").join(docs, "doc_id")
    answers = F.explode(
        F.array(
            F.struct(F.lit("base").alias("model"), (1 - F.col("toxic")).alias("pred")),
            F.struct(F.lit("other").alias("model"), (F.col("n_chars") > 1000).cast("int").alias("pred")),
        )
    )
    return base.select("doc_id", F.col("quality").alias("label"), answers.alias("a")).select(
        "doc_id", "label", "a.model", "a.pred"
    )


MODEL_ROWS_SQL = (
    "(SELECT 'base' AS model, quality AS label, 1 - toxic AS pred FROM labels JOIN documents USING (doc_id) "
    "UNION ALL SELECT 'other', quality, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END "
    "FROM labels JOIN documents USING (doc_id))"
)


def confusion_sql(rows: str) -> str:
    return (
        "(SELECT model, count(*) FILTER (WHERE label = 1 AND pred = 1)::DOUBLE AS tp, "
        "count(*) FILTER (WHERE label = 0 AND pred = 1)::DOUBLE AS fp, "
        "count(*) FILTER (WHERE label = 1 AND pred = 0)::DOUBLE AS fn, "
        f"count(*) FILTER (WHERE label = 0 AND pred = 0)::DOUBLE AS tn FROM {rows} GROUP BY model)"
    )


def metric_sql(rows: str) -> str:
    """Long (model, metric, value)."""
    cells = confusion_sql(rows)
    parts = {
        "acc": "(tp + tn) / (tp + fp + fn + tn)",
        "prec": "coalesce(tp / nullif(tp + fp, 0), 0)",
        "rec": "coalesce(tp / nullif(tp + fn, 0), 0)",
        "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    }
    return "(" + " UNION ALL ".join(
        f"SELECT model, '{m}' AS metric, {e} AS value FROM {cells}" for m, e in parts.items()
    ) + ")"


@query(
    "SELECT metric, ROUND(max(value) FILTER (WHERE model = 'base'), 6) AS base, "
    "ROUND(max(value) FILTER (WHERE model = 'other'), 6) AS other, "
    "ROUND(max(value) FILTER (WHERE model = 'other') - max(value) FILTER (WHERE model = 'base'), 6) AS diff "
    f"FROM {metric_sql(MODEL_ROWS_SQL)} GROUP BY metric"
)
def q_compare_models(spark, sf):
    wide = metrics.binary_metrics(model_rows(spark, sf), keys=["model"])
    side = metrics.compare_models(metrics.metrics_long(wide), "base", "other")
    return side.select("metric", *[F.round(c, 6).alias(c) for c in ("base", "other", "diff")])


SCORED_SQL = """
  (SELECT event_id, video_id, CASE WHEN p IS NULL THEN NULL WHEN p >= 0.5 THEN 'Safe' ELSE 'Harmful' END AS label,
    CASE WHEN p IS NULL THEN NULL WHEN p >= 0.5 THEN 0 ELSE 1 END AS label_id,
    ROUND(greatest(p, 1 - p), 6) AS confidence, ROUND(1 - p, 6) AS p_harmful
  FROM (SELECT event_id, CAST(user_id * 4 AS STRING) AS video_id,
    1 / (1 + exp(embedding[2]::DOUBLE - embedding[1]::DOUBLE)) AS p
  FROM events LEFT JOIN embeddings ON vec_id = user_id * 4))"""


def item_features(spark, sf):
    return load(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("video_id"), "embedding")


@query(f"SELECT * FROM {SCORED_SQL}")
def q_score_events(spark, sf):
    """Batch twin of the scoring join: events, feature lookup, prediction."""
    events = V.EVENTS.df(spark, sf).select("event_id", "video_id")
    scored = score_events(events, item_features(spark, sf), linear_scorer())
    return scored.select(
        "event_id", "video_id", "label", "label_id", F.round("confidence", 6).alias("confidence"),
        F.round(F.col("probabilities")["Harmful"], 6).alias("p_harmful"),
    )


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def q_set_difference(spark, sf):
    return sets.difference(load(spark, sf, "documents").select("doc_id"), load(spark, sf, "labels").select("doc_id"))


@query("SELECT doc_id FROM labels INTERSECT SELECT vec_id FROM embeddings")
def q_set_intersection(spark, sf):
    vecs = load(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return sets.intersection(load(spark, sf, "labels").select("doc_id"), vecs)


@query(
    "SELECT concat('doc', doc_id) AS video_id, text, source, NULL::VARCHAR AS role FROM documents UNION ALL "
    "SELECT concat('conv', conv_id, '-', turn), text, NULL, role FROM conversations"
)
def q_union_sources(spark, sf):
    docs = load(spark, sf, "documents").select(F.concat(F.lit("doc"), "doc_id").alias("video_id"), "text", "source")
    talks = load(spark, sf, "conversations").select(
        F.concat(F.lit("conv"), "conv_id", F.lit("-"), "turn").alias("video_id"), "role", "text"
    )
    return sets.union_sources(docs, talks)
