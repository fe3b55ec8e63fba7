"""Live label counts and trends.

State is one row per bin or label, so no watermark is set: rows count whenever they arrive. A
maintained view needs no state at all: each batch's counts are added to the parts they touch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsift.functions.labels import display_label
from clipsift.session import durable
from clipsift.sources.files import Folder


def trend_stream(
    df: DataFrame, ts: str = "ts", label: str = "label", every: str = "5 minutes"
) -> DataFrame:
    """Labelled rows per tumbling window."""
    return (
        df.withColumn(ts, F.col(ts).cast("timestamp"))
        .groupBy(F.window(ts, every).alias("w"))
        .agg(F.count(label).alias("n"))
        .select(F.col("w.start").alias("bin"), "n")
    )


def label_counts_stream(
    df: DataFrame, ts: str = "ts", label: str = "label", every: str | None = None
) -> DataFrame:
    """Rows per label over the whole log, or per label and tumbling window of length ``every``."""
    name = display_label(F.col(label)).alias("label")
    if every is None:
        return df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return (
        df.withColumn(ts, F.col(ts).cast("timestamp"))
        .groupBy(F.window(ts, every).alias("w"), name)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("bin"), "label", "n")
    )


def latest(updates: DataFrame, *keys: str) -> DataFrame:
    """Last value of ``n`` per key from the batches written in update mode."""
    return updates.groupBy(*keys).agg(F.max_by("n", "batch_id").alias("n"))


# Maintained views: one row per key, in parts that are rewritten only when a batch touches them.
PART, BATCH = "part", "applied"


def by_day() -> Column:
    return F.date_format("bin", "'d'yyyyMMdd")


def whole() -> Column:
    return F.lit("all")


def fold(path: str, counts: DataFrame, batch_id: int, keys: Sequence[str], part: Column) -> None:
    """Add a batch's counts ``n`` per ``keys`` to the view, rewriting only the parts they are in.

    Each part names the last batch in it, so a batch that runs again, also after it failed halfway,
    changes no part twice. Batches come in the order of their numbers.
    """
    spark = counts.sparkSession
    fresh = durable(counts.select(*keys, "n", part.alias(PART)), "counts")
    touched = [r[0] for r in fresh.select(PART).distinct().collect()]
    if not touched:
        return
    there = [f"{path}/{PART}={p}" for p in touched if p in set(Folder(spark, path).partitions(PART))]
    if there:
        stored = spark.read.option("basePath", path).parquet(*there)
        applied = stored.filter(F.col(BATCH) >= batch_id).select(PART).distinct()
        fresh = fresh.join(applied, PART, "left_anti")
        old = stored.join(fresh.select(PART).distinct(), PART, "left_semi")
        fresh = old.select(*keys, "n", PART).unionByName(fresh.select(*keys, "n", PART))
    merged = fresh.groupBy(PART, *keys).agg(F.sum("n").alias("n")).withColumn(BATCH, F.lit(batch_id).cast("long"))
    durable(merged, "merged").repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        PART
    ).parquet(path)


def view_sink(
    path: str, view: Callable[[DataFrame], DataFrame], keys: Sequence[str], part: Column
) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: each batch's ``view`` (keys and n) is folded into the table at ``path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        fold(path, view(batch), batch_id, keys, part)

    return write


def read_view(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART, BATCH)
