"""Standard scaling of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsift.operators.sampling import seeded_sample


@dataclass(frozen=True)
class Scaler:
    """Means and population deviations as a one-row frame, read as a scalar subquery."""

    params: DataFrame
    cols: tuple[str, ...]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Standardise the fitted columns, in place or under ``suffix``."""
        one = self.params.select(F.struct("*")).scalar()
        work = df.withColumn("_scale", one)
        scaled = {
            f"{c}{suffix}": (F.col(c) - F.col("_scale")[f"{c}_mean"]) / F.col("_scale")[f"{c}_std"]
            for c in self.cols
        }
        return work.withColumns(scaled).drop("_scale")

    def long(self) -> DataFrame:
        """(feature, mean, std) rows."""
        rows = [
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"{c}_mean").alias("mean"),
                F.col(f"{c}_std").alias("std"),
            )
            for c in self.cols
        ]
        return self.params.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def fit_scaler(
    df: DataFrame, cols: Sequence[str], sample_n: int | None = None, key: str | None = None
) -> Scaler:
    """Mean and population deviation of all columns in one aggregate; constant columns scale by 1."""
    source = seeded_sample(df, sample_n, key) if sample_n else df
    aggs = []
    for c in cols:
        std = F.stddev_pop(c)
        aggs += [
            F.avg(c).alias(f"{c}_mean"),
            F.when(std > 0, std).otherwise(F.lit(1.0)).alias(f"{c}_std"),
        ]
    return Scaler(source.agg(*aggs), tuple(cols))
