"""Ordering, ranking and running totals that never put one group into one task.

A plain ``row_number`` over a key sorts all rows of that key in a single task. The operators
here cut every key's ordered rows into slices, total the slices, and add each slice's carry to
the totals computed inside it, so one key holding a third of the table is still spread out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsift.session import durable

SLICE = "_slice"

# Rows without a bucket sort first, like nulls.
FIRST_SLICE = -(2**63)


def _ordering(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: Mapping[str, Column],
    totals: Mapping[str, str] | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Add inclusive running sums of ``sums`` per key in the given order.

    ``totals`` maps a name in ``sums`` to a column that receives the key's grand total.
    ``bucket`` may give a slice number that never falls as the order advances (a position
    span, a minute, a hash prefix; none counts as the first); no intermediate table is needed
    then. Without it the rows
    are range-partitioned on (keys, order) and the slices written to the shared folder, so
    that both passes see the same slices.
    """
    keys = list(keys)
    order = _ordering([o for o in order if not (isinstance(o, str) and o in keys)])
    kept = [c for c in df.columns if c not in keys]
    # Keys travel as one struct: equal also where a key is null, so the join below can use the
    # partitioning of the window instead of shuffling the rows again.
    key = [F.struct(*keys).alias("_key")] if keys else []
    work = df.select(
        *key,
        *kept,
        *[expr.alias(f"_{name}") for name, expr in sums.items()],
        *([F.coalesce(bucket.cast("long"), F.lit(FIRST_SLICE)).alias(SLICE)] if bucket is not None else []),
    )
    group = [F.col("_key")] if keys else []
    if bucket is None:
        ranged = work.repartitionByRange(*[F.col(f"_key.{k}") for k in keys], *order)
        work = durable(
            ranged.withColumn(SLICE, F.spark_partition_id().cast("long")), "slices"
        )

    inside = Window.partitionBy(*group, SLICE).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = work.withColumns({n: F.sum(f"_{n}").over(inside) for n in sums})

    per_slice = work.groupBy(*group, SLICE).agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select(
        *[c.alias("_carry_key") for c in group],
        F.col(SLICE).alias("_carry_slice"),
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums],
        *[F.sum(f"_{n}").over(whole).alias(out) for n, out in (totals or {}).items()],
    )
    same = F.col(SLICE) == F.col("_carry_slice")
    if keys:
        same = same & (F.col("_key") == F.col("_carry_key"))
    joined = local.join(carry, same, "inner")
    return joined.select(
        *[(F.col(f"_key.{c}") if c in keys else F.col(c)).alias(c) for c in df.columns],
        *[(F.col(n) + F.col(f"_c_{n}")).alias(n) for n in sums],
        *(totals or {}).values(),
    )


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rn",
    total: str | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Row numbers 1..n per key (and optionally n) without a one-task window."""
    return running_totals(
        df,
        keys,
        order,
        {name: F.lit(1).cast("long")},
        totals={name: total} if total else None,
        bucket=bucket,
    )


# Spark cuts ranked rows before the shuffle only up to this setting's value.
LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, name: str = "rn"
) -> DataFrame:
    """First ``n`` rows of each key, numbered from 1.

    Up to the group-limit threshold each task's rows are cut to ``n`` before the shuffle; a
    larger ``n`` is counted over slices, so a hot key never fills one task.
    """
    if n > int(df.sparkSession.conf.get(LIMIT_KEY, "1000")):
        return numbered(df, keys, order, name).filter(F.col(name) <= n)
    window = Window.partitionBy(*keys).orderBy(*_ordering(order))
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def recent(
    df: DataFrame,
    n: int,
    order_col: str,
    id_col: str,
    label: str = "All",
    label_col: str = "label",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Latest ``n`` rows of one label (or all), newest first, ties by id."""
    from clipsift.operators.filters import filter_label

    out = filter_label(df, label, label_col).orderBy(F.col(order_col).desc(), F.col(id_col))
    out = out.limit(n)
    return out.select(*columns) if columns else out


def dedup_first(df: DataFrame, col: str, pos: str) -> DataFrame:
    """Keep each value at its first position (partial aggregation, no window)."""
    rest = [c for c in df.columns if c not in (col, pos)]
    first = df.groupBy(col).agg(
        F.min_by(F.struct(pos, *rest), F.col(pos)).alias("_first")
    )
    return first.select(col, "_first.*").select(*df.columns)


def duplicate_report(df: DataFrame, col: str) -> DataFrame:
    """Values that occur again, with the number of extra occurrences."""
    counts = df.groupBy(col).agg((F.count(F.lit(1)) - 1).alias("n_extra"))
    return counts.filter("n_extra > 0")


def cap_per_source(
    df: DataFrame, source: str, ident: str, order: str, n: int, seen: DataFrame | None = None
) -> DataFrame:
    """At most ``n`` distinct ids per source (0: no limit) in discovery order, each id kept once.

    Ids already in ``seen`` use up their source's allowance but are not returned; an id found
    under several sources stays with the source that met it first.
    """
    distinct = df.groupBy(source, ident).agg(F.min(order).alias(order))
    if n > 0:
        capped = first_per_key(distinct, [source], [order, ident], n, "rank_in_source")
    else:
        capped = numbered(distinct, [source], [order, ident], "rank_in_source")
    if seen is not None:
        capped = capped.join(seen.select(ident).distinct(), ident, "left_anti")
    kept = capped.groupBy(ident).agg(
        F.min_by(F.struct(source, order, "rank_in_source"), F.struct(order, source)).alias("k")
    )
    return kept.select(ident, "k.*")


def chunk(
    df: DataFrame,
    size: int,
    order: Sequence[str | Column],
    start: int = 0,
    max_rows: int | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Number the ordered rows into batches of ``size``, beginning at batch ``start``."""
    out = numbered(df, [], order, "_rn", bucket=bucket)
    if max_rows is not None:
        out = out.filter(F.col("_rn") <= max_rows)
    out = out.withColumn("batch", F.floor((F.col("_rn") - 1) / F.lit(size)).cast("long"))
    return out.filter(F.col("batch") >= start).drop("_rn")
