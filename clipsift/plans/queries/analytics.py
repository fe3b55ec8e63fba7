"""Counts, tallies, latency figures and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipsift.functions.labels import kappa_band
from clipsift.functions.vectors import softmax
from clipsift.operators import aggregates, metrics, ordering
from clipsift.plans import standins as V
from clipsift.plans.queries.relational import (
    MODEL_ROWS_SQL,
    OVERLAP_SQL,
    metric_sql,
    model_rows,
    overlap,
)
from clipsift.plans.registry import query
from clipsift.sources import annotations
from clipsift.tables import load


def predictions(spark, sf):
    return V.PREDICTIONS.df(spark, sf)


P = V.PREDICTIONS.sql


@query(f"SELECT coalesce(nullif(label, ''), 'Unknown') AS label, count(*) AS n FROM {P} GROUP BY 1")
def q_label_counts(spark, sf):
    return aggregates.label_counts(predictions(spark, sf))


RISK_SQL = (
    "SELECT count(*) AS total, count(*) FILTER (WHERE label = 'error') AS positives, "
    "ROUND(100.0::DOUBLE * count(*) FILTER (WHERE label = 'error') / count(*), 6) AS risk_pct, "
    "printf('%.1f%%', 100.0::DOUBLE * count(*) FILTER (WHERE label = 'error') / count(*)) AS risk_text "
    f"FROM {P}"
)


@query(RISK_SQL)
def q_risk_ratio(spark, sf):
    risk = aggregates.risk_ratio(predictions(spark, sf), "error")
    return risk.withColumn("risk_pct", F.round("risk_pct", 6))


@query(
    "SELECT count(*) AS total, count(*) FILTER (WHERE c = 'SAFE') AS safe, "
    "count(*) FILTER (WHERE c = 'NOT SAFE') AS not_safe, "
    "count(*) FILTER (WHERE c IS NULL OR c NOT IN ('SAFE', 'NOT SAFE')) AS unknown FROM (SELECT "
    f"json_extract_string(task, '$.annotations[0].result[0].value.choices[0]') AS c FROM {V.TASKS_A.sql})"
)
def q_annotation_tally(spark, sf):
    return aggregates.annotation_tally(
        annotations.parse_tasks(V.TASKS_A.df(spark, sf), "task", "ordinal")
    )


_raw = (
    "CASE doc_id % 8 WHEN 0 THEN '{\"label\":\"Safe\"}' WHEN 1 THEN '{\"labels\":\"1\"}' "
    "WHEN 2 THEN '{\"harmful\":true}' WHEN 3 THEN '{\"label\":null,\"harmful\":\"1\"}' "
    "WHEN 4 THEN '{\"ground_truth\":\"Hate speech\"}' WHEN 5 THEN '{}' "
    "WHEN 6 THEN '{\"violation\":\"not safe\",\"harmful\":\"0\"}' ELSE concat('{\"label\":', n_chars % 3, '}') END"
)
RAW = V.View("documents", {"doc_id": "doc_id", "meta": _raw})
_key = " ".join(f"WHEN json_exists(meta, '$.{k}') THEN lower(json_extract_string(meta, '$.{k}'))"
                for k in aggregates.RAW_LABEL_KEYS)


@query(
    "SELECT count(*) AS total, count(*) FILTER (WHERE k = 's') AS safe, count(*) FILTER (WHERE k = 'h') AS harmful, "
    "count(*) FILTER (WHERE k = 'u') AS unknown FROM (SELECT CASE WHEN v IN ('safe', '0') THEN 's' "
    "WHEN v IN ('not safe', 'harmful', '1', '2', '3') OR regexp_matches(v, 'harassment|hate|self-harm|violence') "
    f"THEN 'h' ELSE 'u' END AS k FROM (SELECT CASE {_key} END AS v FROM {RAW.sql}))"
)
def q_raw_label_tally(spark, sf):
    return aggregates.raw_label_tally(RAW.df(spark, sf), "meta")


LATENCY = {"e2e": "e2e_latency_sec", "inference": "inference_latency_ms"}
TIMED_SQL = (
    "(SELECT video_id, ingested_at, greatest(epoch_us(ingested_at) / 1e6 - timestamp, 0.001) AS e2e, "
    f"processing_time AS inference FROM {P})"
)


def describe_sql(rows: str, digits: int = 4) -> str:
    out = []
    for m in LATENCY:
        stats = {"mean": f"avg({m})", "std": f"stddev_samp({m})", "min": f"min({m})"}
        stats |= {aggregates.pct_name(p): f"quantile_cont({m}, {p})" for p in aggregates.PERCENTILES}
        stats["max"] = f"max({m})"
        cols = ", ".join(f"ROUND({e}, {digits}) AS {n}" for n, e in stats.items())
        out.append(f"SELECT '{m}' AS metric, count({m}) AS count, {cols} FROM {rows}")
    return " UNION ALL ".join(out)


def rounded_describe(df):
    found = aggregates.describe(df, {m: F.col(c) for m, c in LATENCY.items()})
    return found.select(
        "metric", "count", *[F.round(c, 4).alias(c) for c in found.columns if c not in ("metric", "count")]
    )


@query(describe_sql(TIMED_SQL))
def q_latency_describe(spark, sf):
    return rounded_describe(aggregates.with_latency(predictions(spark, sf)))


@query(describe_sql(f"(SELECT * FROM {TIMED_SQL} ORDER BY ingested_at DESC, video_id LIMIT 1000)"))
def q_latency_latest_n(spark, sf):
    latest = ordering.recent(predictions(spark, sf), 1000, "ingested_at", "video_id")
    return rounded_describe(aggregates.with_latency(latest))


_secs = "(epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) / 1e6"


@query(
    f"SELECT count(*) AS n, ROUND({_secs}, 3) AS seconds, ROUND(count(*) / ({_secs} + 0.001), 6) AS per_sec FROM {P}"
)
def q_throughput(spark, sf):
    rate = aggregates.throughput(predictions(spark, sf))
    return rate.select("n", F.round("seconds", 3).alias("seconds"), F.round("per_sec", 6).alias("per_sec"))


@query(f"SELECT ROUND(avg(e2e) * 1000 - avg(inference), 2) AS overhead_ms FROM {TIMED_SQL}")
def q_overhead(spark, sf):
    timed = aggregates.with_latency(predictions(spark, sf))
    return aggregates.overhead(timed).select(F.round("overhead_ms", 2).alias("overhead_ms"))


@query(
    "SELECT count(*) AS n, ROUND(avg(CASE WHEN y1 = y2 THEN 1e0 ELSE 0e0 END), 6) AS accuracy "
    f"FROM {OVERLAP_SQL}"
)
def q_agreement_accuracy(spark, sf):
    return metrics.agreement(overlap(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


@query(f"""
  WITH y AS (SELECT * FROM {OVERLAP_SQL}), n AS (SELECT count(*)::DOUBLE AS n,
    avg(CASE WHEN y1 = y2 THEN 1e0 ELSE 0e0 END) AS po FROM y),
  e AS (SELECT sum(r.c * s.c)::DOUBLE AS rs FROM (SELECT y1 AS k, count(*) AS c FROM y GROUP BY 1) r
    JOIN (SELECT y2 AS k, count(*) AS c FROM y GROUP BY 1) s USING (k)),
  k AS (SELECT n, po, rs / (n * n) AS pe, (po - rs / (n * n)) / (1 - rs / (n * n)) AS kappa FROM n, e)
  SELECT n::BIGINT AS n, ROUND(po, 6) AS po, ROUND(pe, 6) AS pe, ROUND(kappa, 6) AS kappa,
    CASE WHEN kappa < 0 THEN 'poor' WHEN kappa <= 0.2 THEN 'slight' WHEN kappa <= 0.4 THEN 'fair'
    WHEN kappa <= 0.6 THEN 'moderate' WHEN kappa <= 0.8 THEN 'substantial' ELSE 'almost perfect' END AS band FROM k""")
def q_cohen_kappa(spark, sf):
    kappa = metrics.cohen_kappa(overlap(spark, sf)).withColumn("band", kappa_band(F.col("kappa")))
    return kappa.select("n", *[F.round(c, 6).alias(c) for c in ("po", "pe", "kappa")], "band")


@query(
    "SELECT l AS y1, p AS y2, count(y1) AS n FROM (SELECT unnest(['SAFE', 'NOT SAFE']) AS l), "
    f"(SELECT unnest(['SAFE', 'NOT SAFE']) AS p) LEFT JOIN {OVERLAP_SQL} y ON l = y1 AND p = y2 GROUP BY 1, 2"
)
def q_confusion_matrix(spark, sf):
    return metrics.confusion(overlap(spark, sf), ["SAFE", "NOT SAFE"], "y1", "y2")


LABELLED = V.View("labels", {"model": "'base'", "label": "quality", "pred": "1 - toxic"})


@query(
    f"SELECT max(value) FILTER (WHERE metric = 'acc') AS acc, max(value) FILTER (WHERE metric = 'prec') AS prec, "
    "max(value) FILTER (WHERE metric = 'rec') AS rec, max(value) FILTER (WHERE metric = 'f1') AS f1 FROM "
    f"(SELECT metric, ROUND(value, 6) AS value FROM {metric_sql(LABELLED.sql)})"
)
def q_binary_metrics(spark, sf):
    found = metrics.binary_metrics(LABELLED.df(spark, sf))
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


MACRO_VIEW = V.View(
    "documents",
    {"label": "CAST(doc_id % 4 AS INTEGER)", "pred": "CAST((doc_id + CASE WHEN n_chars % 3 = 0 THEN 1 ELSE 0 END) % 5 AS INTEGER)"},
)
_classes = f"""
  (SELECT c, 2e0 * sum(tp) / sum(y + p) AS f1, coalesce(sum(tp)::DOUBLE / nullif(sum(y), 0), 0) AS rec FROM (
    SELECT label AS c, 1 AS y, 0 AS p, CASE WHEN label = pred THEN 1 ELSE 0 END AS tp FROM {MACRO_VIEW.sql}
    UNION ALL SELECT pred, 0, 1, 0 FROM {MACRO_VIEW.sql}) GROUP BY c)"""


@query(f"SELECT ROUND(avg(f1), 6) AS macro_f1, ROUND(max(rec) FILTER (WHERE c = 1), 6) AS recall_pos FROM {_classes}")
def q_macro_f1(spark, sf):
    found = metrics.macro_f1(MACRO_VIEW.df(spark, sf))
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


def scored(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("prob"))
    return load(spark, sf, "labels").join(docs, "doc_id").select(F.col("quality").alias("label"), "prob")


SCORES = "(SELECT quality AS label, n_chars::DOUBLE AS prob FROM labels JOIN documents USING (doc_id))"


def auc_sql(scores: str) -> str:
    return (
        "SELECT ROUND(coalesce((sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2) / nullif(p * q, 0), 0), 6) AS auc "
        "FROM (SELECT label, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2e0 AS r, "
        "sum(label) OVER ()::DOUBLE AS p, sum(1 - label) OVER ()::DOUBLE AS q "
        f"FROM {scores}) GROUP BY p, q"
    )


@query(auc_sql(SCORES))
def q_roc_auc(spark, sf):
    return metrics.roc_auc(scored(spark, sf)).select(F.round("auc", 6).alias("auc"))


@query(
    "SELECT prob AS threshold, ROUND(fp / max(fp) OVER (), 6) AS fpr, ROUND(tp / max(tp) OVER (), 6) AS tpr FROM "
    "(SELECT DISTINCT prob, sum(1 - label) OVER (ORDER BY prob DESC)::DOUBLE AS fp, "
    f"sum(label) OVER (ORDER BY prob DESC)::DOUBLE AS tp FROM {SCORES}) "
    "UNION ALL SELECT 'Infinity'::DOUBLE, 0, 0"
)
def q_roc_curve(spark, sf):
    curve = metrics.roc_curve(scored(spark, sf))
    return curve.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(f"SELECT model, metric, ROUND(value, 6) AS value FROM {metric_sql(MODEL_ROWS_SQL)}")
def q_metrics_long(spark, sf):
    wide = metrics.binary_metrics(model_rows(spark, sf), keys=["model"])
    return metrics.metrics_long(wide).withColumn("value", F.round("value", 6))


@query(
    "SELECT ROUND(avg(-ln(exp(embedding[label % 4 + 1]::DOUBLE) / (exp(embedding[1]::DOUBLE) + exp(embedding[2]::DOUBLE) "
    "+ exp(embedding[3]::DOUBLE) + exp(embedding[4]::DOUBLE)))), 6) AS log_loss FROM embeddings"
)
def q_log_loss(spark, sf):
    rows = load(spark, sf, "embeddings").select(
        softmax(F.slice("embedding", 1, 4)).alias("probs"), (F.col("label") % 4).alias("label")
    )
    return aggregates.log_loss(rows).select(F.round("log_loss", 6).alias("log_loss"))


def trend_sql(minutes: int, rows: str = P) -> str:
    step = f"INTERVAL {minutes} MINUTE"
    bins = f"(SELECT time_bucket({step}, ingested_at) AS bin, count(label) AS n FROM {rows} GROUP BY 1)"
    return (
        f"SELECT s.bin, coalesce(b.n, 0) AS n FROM (SELECT unnest(generate_series(min(bin), max(bin), {step})) AS bin "
        f"FROM {bins}) s LEFT JOIN {bins} b ON s.bin = b.bin"
    )


@query(trend_sql(5))
def q_trend_5min(spark, sf):
    return aggregates.trend(predictions(spark, sf), "ingested_at")


@query(trend_sql(60))
def q_trend_hourly(spark, sf):
    return aggregates.trend(predictions(spark, sf), "ingested_at", every="1 hour")


@query("SELECT user_id, value, count(*) - 1 AS n_extra FROM events GROUP BY ALL HAVING count(*) > 1")
def q_duplicate_report(spark, sf):
    pairs = load(spark, sf, "events").select(F.struct("user_id", "value").alias("v"))
    return ordering.duplicate_report(pairs, "v").select("v.user_id", "v.value", "n_extra")


@query(
    "SELECT label, count(*) AS n, min(len(embedding))::INTEGER AS min_width, max(len(embedding))::INTEGER AS max_width "
    "FROM embeddings GROUP BY ROLLUP (label)"
)
def q_dataset_profile(spark, sf):
    return aggregates.dataset_profile(load(spark, sf, "embeddings"), "embedding")


@query(
    "SELECT CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 400000 THEN 36 ELSE "
    "CAST(floor((o_totalprice - 50000) / 10000) AS BIGINT) + 1 END AS bucket, count(*) AS n FROM orders GROUP BY 1"
)
def q_histogram(spark, sf):
    return aggregates.histogram(load(spark, sf, "orders"), "o_totalprice", 50000, 400000, 35)
