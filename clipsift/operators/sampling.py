"""Seeded sampling and splitting; hash order instead of ``rand()`` so reruns agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsift.operators.ordering import first_per_key, numbered

# Hash prefixes of this many hex digits cut the table into 65,536 even buckets; one task ranks
# the counts, and one the rows of the single bucket that holds the cut.
PREFIX_DIGITS = 4


def hash_order(key: str | Column, seed: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows in hash order of the key (a distributed top-n)."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def split(
    df: DataFrame, ratio: float, key: str, seed: int = 42, digits: int = PREFIX_DIGITS
) -> DataFrame:
    """Mark the first ``int(n * ratio)`` rows in hash order as train, the rest as val.

    The exact cut is found from the counts per hash prefix; only the one prefix that holds the
    cut is ranked, so no task ever orders the whole table. Rows with the same key, also a null
    one, stay on the same side.
    """
    work = df.withColumn("_h", hash_order(key, seed)).withColumn(
        "_p", F.substring("_h", 1, digits)
    )
    counts = work.groupBy("_p").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marks = counts.select(
        "_p", "c", F.sum("c").over(upto).alias("cum"), F.sum("c").over(Window.partitionBy()).alias("n")
    ).withColumn("want", F.floor(F.col("n") * F.lit(float(ratio))))
    cut = marks.filter("want > cum - c and want <= cum").select(
        F.struct("_p", (F.col("want") - (F.col("cum") - F.col("c"))).alias("take")).alias("cut")
    )
    edge = (
        work.select(key, "_h", "_p", cut.scalar().alias("_cut"))
        .filter("_p = _cut._p")
        .withColumn("_rank", F.row_number().over(Window.partitionBy("_p").orderBy("_h", key)))
        .filter("_rank = _cut.take")
        .select(F.struct("_h", F.col(key).alias("id")).alias("edge"))
    )
    last = F.col("_last")
    in_train = (F.col("_h") < last["_h"]) | (
        (F.col("_h") == last["_h"]) & F.coalesce(F.col(key) <= last["id"], F.lit(True))
    )
    return (
        work.withColumn("_last", edge.scalar())
        .withColumn("split", F.when(in_train, "train").otherwise("val"))
        .drop("_h", "_p", "_last")
    )


def uniform_sample(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    k: int = 16,
    bucket: Column | None = None,
) -> DataFrame:
    """``k`` evenly spaced rows per key, ``sample_no`` 0..k-1; short keys repeat rows."""
    ranked = numbered(df, keys, order, "_rn", total="_n", bucket=bucket)
    # Row r (0-based) of n is sample i when floor(i * (n - 1) / (k - 1)) = r.
    steps, gap = max(k - 1, 1), F.col("_n") - 1
    first = F.ceil((F.col("_rn") - 1) * steps / gap)
    last = F.least(F.ceil(F.col("_rn") * steps / gap) - 1, F.lit(k - 1))
    some = F.when(first <= last, F.sequence(first, last))
    wanted = F.when(gap > 0, some).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    picked = ranked.select(*df.columns, F.explode(wanted).alias("sample_no"))
    return picked.withColumn("sample_no", F.col("sample_no").cast("int"))


def first_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int = 16
) -> DataFrame:
    """The first ``k`` rows of each key; keys with fewer rows are rejected whole."""
    head = first_per_key(df, keys, order, k, "frame_no")
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return head.withColumn("_n", size).filter(F.col("_n") == k).drop("_n")
