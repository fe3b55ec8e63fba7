"""Prediction log in a folder per hour, and its latest rows without reading the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsift.operators.filters import filter_label
from clipsift.operators.ordering import recent
from clipsift.sources.files import Folder

HOUR = "hour"
NO_HOUR = "__HIVE_DEFAULT_PARTITION__"  # rows without a time; they come last


def write_log(rows: DataFrame, path: str, ts: str = "ingested_at", mode: str = "append") -> None:
    """Add rows to the folders of their hours (UTC)."""
    hour = F.date_format(F.col(ts).cast("timestamp"), "'h'yyyyMMddHH")
    rows.withColumn(HOUR, hour).repartition(HOUR).write.mode(mode).partitionBy(HOUR).parquet(path)


def read_hours(spark: SparkSession, path: str, hours: Sequence[str]) -> DataFrame:
    folders = [f"{path}/{HOUR}={h}" for h in hours]
    return spark.read.option("basePath", path).parquet(*folders).drop(HOUR)


def latest(
    spark: SparkSession, path: str, n: int, ts: str = "ingested_at", id_col: str = "video_id", label: str = "All",
    label_col: str = "label", columns: Sequence[str] | None = None,
) -> DataFrame:
    """Latest ``n`` rows of one label (or all), newest first, ties by id, as ``ordering.recent`` gives them.

    Hours are counted backwards, twice as many each time, until they hold ``n`` such rows; older
    ones cannot have any of the latest and are not opened. An hour is taken whole, so ties are right.
    """
    hours = sorted(Folder(spark, path).partitions(HOUR), key=lambda h: (h != NO_HOUR, h), reverse=True)
    if not hours:
        raise LookupError(f"{path} has no hours")
    taken = held = 0
    step = 1
    while taken < len(hours) and held < n:
        more = hours[taken : taken + step]
        held += filter_label(read_hours(spark, path, more), label, label_col).count()
        taken, step = taken + len(more), 2 * step
    return recent(read_hours(spark, path, hours[: max(taken, 1)]), n, ts, id_col, label, label_col, columns)
