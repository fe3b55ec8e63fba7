"""Month-day strings without a year."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FIELDS = ("age_days", "month_sin", "month_cos", "has_date")


# Two whole numbers around one separator, blanks around either.
MONTH_DAY = r"(?U)^\s*(\+?[0-9]+)\s*[-/.]\s*(\+?[0-9]+)\s*$"


def parse_mm_dd(c: Column) -> Column:
    """``"8-9"``, ``"08/09"`` or ``"8.9"`` -> struct(month, day); anything else -> null."""
    month, day = (
        F.nullif(F.regexp_extract(c, MONTH_DAY, g), F.lit("")).try_cast("int") for g in (1, 2)
    )
    valid = month.between(1, 12) & day.between(1, 31)
    return F.when(valid, F.struct(month.alias("month"), day.alias("day")))


def date_features_of(parsed: Column, ref: dt.date, year: int) -> Column:
    """Date features of a parsed struct(month, day), read in the given year."""
    day = F.concat_ws("-", F.lit(f"{year:04d}"), parsed["month"], parsed["day"]).try_cast("date")
    known = parsed.isNotNull() & day.isNotNull()
    angle = parsed["month"] * F.lit(2 * math.pi) / F.lit(12.0)
    age = F.greatest(F.datediff(F.lit(ref), day), F.lit(0)).cast("double")
    values = (age, F.sin(angle), F.cos(angle), F.lit(1.0))
    return F.when(known, F.struct(*[v.alias(n) for n, v in zip(DATE_FIELDS, values)])).otherwise(
        F.struct(*[F.lit(0.0).alias(n) for n in DATE_FIELDS])
    )


def date_features(c: Column, ref: dt.date, year: int) -> Column:
    """struct(age_days, month_sin, month_cos, has_date), all zero when there is no valid date.

    For wide tables select ``parse_mm_dd`` first and use ``date_features_of`` on its column, so
    that the text is parsed once.
    """
    return date_features_of(parse_mm_dd(c), ref, year)
