"""Counts, tallies, distributions and latency figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer

from clipsift.functions.labels import display_label
from clipsift.operators.ordering import running_totals

PERCENTILES = (0.5, 0.9, 0.95, 0.99)
MIN_LATENCY = 0.001
BYTES_PER_MB = 1024 * 1024


def label_counts(df: DataFrame, col: str = "label") -> DataFrame:
    """Rows per label, absent and empty labels together as Unknown."""
    return df.groupBy(display_label(F.col(col)).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def risk_ratio(df: DataFrame, positive: str, col: str = "label") -> DataFrame:
    """Share of ``positive`` in percent, 0 for no rows, also as text with one decimal."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col(col) == positive).alias("positives")
    )
    share = F.coalesce(F.try_divide(F.col("positives"), F.col("total")) * 100, F.lit(0.0))
    return counted.withColumn("risk_pct", share).withColumn(
        "risk_text", F.format_string("%.1f%%", F.col("risk_pct"))
    )


def annotation_tally(df: DataFrame, choices: str = "choices") -> DataFrame:
    """Tasks by outcome; SAFE is tested first, tasks without choices are unknown."""
    def holds(choice: str) -> Column:
        return F.coalesce(F.array_contains(choices, choice), F.lit(False))

    safe, unsafe = holds("SAFE"), holds("NOT SAFE")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(safe).alias("safe"),
        F.count_if(~safe & unsafe).alias("not_safe"),
        F.count_if(~safe & ~unsafe).alias("unknown"),
    )


# Label fields in the order they are looked up, and the texts they may hold.
RAW_LABEL_KEYS = ("label", "labels", "ground_truth", "violation", "harmful")
RAW_SAFE = ("safe", "0")
RAW_HARMFUL = ("not safe", "harmful", "1", "2", "3")
RAW_HARMFUL_PARTS = ("harassment", "hate", "self-harm", "violence")


def raw_label_class(json_col: Column, keys: Sequence[str] = RAW_LABEL_KEYS) -> Column:
    """safe / harmful / unknown from the first label field that is present in the JSON text."""
    present = F.coalesce(F.json_object_keys(json_col), F.array().cast("array<string>"))
    value = F.lit(None).cast("string")
    for key in reversed(keys):
        value = F.when(
            F.array_contains(present, key), F.get_json_object(json_col, f"$.{key}")
        ).otherwise(value)
    text = F.lower(value)
    return (
        F.when(text.isin(*RAW_SAFE), "safe")
        .when(text.isin(*RAW_HARMFUL) | text.rlike("|".join(RAW_HARMFUL_PARTS)), "harmful")
        .otherwise("unknown")
    )


def raw_label_tally(df: DataFrame, json_col: str) -> DataFrame:
    kind = raw_label_class(F.col(json_col))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(kind == k).alias(k) for k in ("safe", "harmful", "unknown")],
    )


def with_latency(
    df: DataFrame,
    ingested: str = "ingested_at",
    event: str = "timestamp",
    times: Sequence[str] = ("processing_time", "processing_time_ms"),
) -> DataFrame:
    """Add ``e2e_latency_sec`` and ``inference_latency_ms``.

    Naive timestamps count as UTC; negative latencies are raised to a millisecond.
    """
    stored = F.col(event)
    if ingested in df.columns:
        stored = F.unix_micros(F.col(ingested).cast("timestamp")) / F.lit(1e6)
    e2e = stored - F.col(event)
    known = [F.col(c) for c in times if c in df.columns]
    inference = F.coalesce(*known) if known else F.lit(None)
    return df.withColumns(
        {
            "e2e_latency_sec": F.when(e2e.isNotNull(), F.greatest(e2e, F.lit(MIN_LATENCY))),
            "inference_latency_ms": inference.cast("double"),
        }
    )


def describe(
    df: DataFrame,
    metrics: Mapping[str, Column],
    percentiles: Sequence[float] = PERCENTILES,
    approx: bool = False,
) -> DataFrame:
    """count, mean, sample std, min, percentiles (linear interpolation) and max per metric.

    The exact percentiles come from counts per distinct value and running totals over them, so
    no task holds a whole column; ``approx`` uses a sketch instead.
    """
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value"))
                    for m, c in metrics.items()
                ]
            )
        ).alias("r")
    ).select("r.*")
    base = long.groupBy("metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *(
            [
                F.approx_percentile("value", F.lit(float(p)), F.lit(10000)).alias(pct_name(p))
                for p in percentiles
            ]
            if approx
            else []
        ),
    )
    if approx:
        return base
    return base.join(_exact_percentiles(long, percentiles), "metric", "left")


def pct_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def _exact_percentiles(long: DataFrame, percentiles: Sequence[float]) -> DataFrame:
    counts = long.filter("value is not null").groupBy("metric", "value").agg(
        F.count(F.lit(1)).alias("c")
    )
    ranked = running_totals(
        counts, ["metric"], ["value"], {"cum": F.col("c")}, totals={"cum": "n"}
    )
    picks = []
    for i, p in enumerate(percentiles):
        place = F.lit(float(p)) * (F.col("n") - 1)
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            covers = (at >= F.col("cum") - F.col("c")) & (at < F.col("cum"))
            picks.append(F.max(F.when(covers, F.col("value"))).alias(f"{side}{i}"))
    found = ranked.groupBy("metric").agg(F.max("n").alias("n"), *picks)
    cols = []
    for i, p in enumerate(percentiles):
        place = F.lit(float(p)) * (F.col("n") - 1)
        part = place - F.floor(place)
        cols.append(
            (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * part).alias(pct_name(p))
        )
    return found.select("metric", *cols)


def throughput(df: DataFrame, ts: str = "ingested_at") -> DataFrame:
    """Rows, seconds between first and last row, and rows per second."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    seconds = (F.max(micros) - F.min(micros)) / F.lit(1e6)
    counted = df.agg(F.count(F.lit(1)).alias("n"), seconds.alias("seconds"))
    return counted.withColumn("per_sec", F.col("n") / (F.col("seconds") + F.lit(MIN_LATENCY)))


def overhead(df: DataFrame) -> DataFrame:
    """Mean end-to-end latency less mean inference time, in milliseconds."""
    mean_e2e, mean_inf = F.avg("e2e_latency_sec"), F.avg("inference_latency_ms")
    return df.agg((mean_e2e * 1000 - mean_inf).alias("overhead_ms"))


# Bins that one row of the spine is spread into.
SPAN_BINS = 10_000


def trend(
    df: DataFrame, ts: str = "ts", label: str = "label", every: str = "5 minutes", fill: bool = True
) -> DataFrame:
    """Labelled rows per time bin, left-closed; ``fill`` adds the empty bins in between."""
    bins = (
        df.groupBy(F.window(ts, every).alias("w"))
        .agg(F.count(label).alias("n"))
        .select(F.col("w.start").alias("bin"), "n")
    )
    if not fill:
        return bins
    step = F.expr(f"interval {every}")
    ends = bins.agg(F.min("bin").alias("a"), F.max("bin").alias("b"))
    # Spans of many bins first, dealt out, then the bins of each, so no row holds them all.
    span = F.expr(f"interval {every}") * F.lit(SPAN_BINS)
    starts = ends.select("b", F.explode(F.sequence("a", "b", span)).alias("s")).repartition("s")
    spine = starts.select(
        F.explode(F.sequence("s", F.least(F.col("b"), F.col("s") + span - step), step)).alias("bin")
    )
    return spine.join(bins, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def histogram(df: DataFrame, col: str, lo: float, hi: float, n: int) -> DataFrame:
    """Rows per equal-width bucket 1..n; 0 and n+1 collect what lies outside."""
    bucket = F.width_bucket(F.col(col), F.lit(float(lo)), F.lit(float(hi)), F.lit(n).cast("int"))
    return df.groupBy(bucket.cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def dataset_profile(df: DataFrame, vector: str, label: str = "label") -> DataFrame:
    """Rows and vector widths per label, and over all rows (label null)."""
    width = F.size(vector)
    return df.rollup(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(width).alias("min_width"),
        F.max(width).alias("max_width"),
    )


def object_listing_stats(df: DataFrame, path: str = "path", size: str = "size") -> DataFrame:
    """Objects, distinct bronze ids, files per layer and size of gold datasets (MB)."""
    parts = F.split(path, "/")
    layer = F.when(F.size(parts) >= 2, F.get(parts, F.lit(0)))
    dataset = (layer == "gold") & F.endswith(F.col(path), F.lit(".npz"))
    return df.agg(
        F.count(F.lit(1)).alias("n_objects"),
        F.count_distinct(F.when(layer == "bronze", F.get(parts, F.lit(1)))).alias("n_bronze_ids"),
        F.count_if(layer == "silver").alias("n_silver"),
        F.count_if(layer == "gold").alias("n_gold"),
        F.count_if(dataset).alias("n_gold_sets"),
        (F.sum(F.when(dataset, F.col(size)).otherwise(0)) / F.lit(float(BYTES_PER_MB))).alias("gold_mb"),
    )


def list_subdirs(df: DataFrame, prefix: str, path: str = "path") -> DataFrame:
    """Distinct first path segments below ``prefix``, sorted."""
    head = prefix.rstrip("/") + "/"
    rest = F.substring(F.col(path), len(head) + 1, 2**31 - 1)
    return (
        df.filter(F.startswith(F.col(path), F.lit(head)) & F.contains(rest, F.lit("/")))
        .select(F.substring_index(rest, "/", 1).alias("name"))
        .distinct()
        .orderBy("name")
    )


def mean_pool(
    df: DataFrame, key: str, emb: str, mask: str | None = None, eps: float = 1e-5
) -> DataFrame:
    """Mean vector per key, masked rows left out; all rows masked -> zeros."""
    weight = F.col(mask).cast("double") if mask else F.lit(1.0)
    vector = F.col(emb).cast("array<double>")
    shown = F.transform(vector, lambda x: x * F.col("_m")) if mask else vector
    pooled = (
        df.select(key, weight.alias("_m"), F.col(emb))
        .groupBy(key)
        .agg(
            Summarizer.mean(array_to_vector(shown)).alias("_mean"),
            F.count(F.lit(1)).alias("_n"),
            F.sum("_m").alias("_w"),
        )
    )
    scale = F.col("_n") / F.greatest(F.col("_w"), F.lit(eps))
    return pooled.select(
        key, F.transform(vector_to_array("_mean"), lambda x: x * scale).alias(emb)
    )


def log_loss(df: DataFrame, probs: str = "probs", label: str = "label") -> DataFrame:
    """Mean negative log of the probability given to the true class."""
    return df.agg(F.avg(-F.ln(F.get(F.col(probs), F.col(label)))).alias("log_loss"))
