"""Set operations on keys and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
