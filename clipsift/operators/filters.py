"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_label(df: DataFrame, label: str = "All", col: str = "label") -> DataFrame:
    return df if label == "All" else df.filter(F.col(col) == label)


def filter_time(df: DataFrame, col: str, start=None, end=None) -> DataFrame:
    """Inclusive range; applies only when both bounds are given."""
    if start is None or end is None:
        return df
    kind = df.schema[col].dataType.simpleString()
    return df.filter(F.col(col).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def filter_ids(df: DataFrame, key: str, ids: Sequence | DataFrame | None) -> DataFrame:
    """Rows of the listed ids, or all rows when the list is empty or missing."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key).distinct(), key, "left_semi")
    return df.filter(F.col(key).isin(list(ids))) if ids else df


def filter_split(df: DataFrame, splits: Sequence[str], col: str = "split") -> DataFrame:
    return df.filter(F.col(col).isin(list(splits)))


def complete_ids(key: str, *layers: DataFrame) -> DataFrame:
    """Ids present in every layer."""
    marked = [
        layer.select(key, F.lit(i).alias("_layer")) for i, layer in enumerate(layers)
    ]
    stacked = marked[0]
    for part in marked[1:]:
        stacked = stacked.unionByName(part)
    present = stacked.groupBy(key).agg(
        *[F.bool_or(F.col("_layer") == i).alias(f"has_{i}") for i in range(len(layers))]
    )
    keep = F.lit(True)
    for i in range(len(layers)):
        keep = keep & F.col(f"has_{i}")
    return present.filter(keep).select(key)


def route(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy ``ok``, the others, unknown counted as failed)."""
    good = F.coalesce(ok, F.lit(False))
    return df.filter(good), df.filter(~good)
