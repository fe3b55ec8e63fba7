"""Display counts, guarded ratios and engagement rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Count suffixes and their factors.
SUFFIX_FACTORS = {"K": 1e3, "M": 1e6, "B": 1e9}

# A decimal number and one optional suffix, blanks around either.
COUNT = (
    r"(?U)^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*"
    rf"([{''.join(SUFFIX_FACTORS)}{''.join(SUFFIX_FACTORS).lower()}]?)\s*$"
)

# Unicode whitespace.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim Unicode whitespace at both ends without a regex."""
    return F.trim(c, F.lit(BLANKS))


def parse_count(c: Column) -> Column:
    """``"307K"`` -> 307000.0; blank, ``N/A`` and anything that is no number -> null.

    Each piece is read once, so the input expression is not repeated per suffix. Text without a
    number becomes null before the cast, which would have to catch an exception for it.
    """
    text = c.cast("string")
    number = F.nullif(F.regexp_extract(text, COUNT, 1), F.lit("")).try_cast("double")
    suffix = F.upper(F.regexp_extract(text, COUNT, 2))
    # An absent suffix is found at place 1, the letters after it.
    place = F.instr(F.lit(" " + "".join(SUFFIX_FACTORS)), suffix)
    factors = F.array(F.lit(1.0), *[F.lit(f) for f in SUFFIX_FACTORS.values()])
    return number * F.try_element_at(factors, place)


def count_of(c: Column, kind: str) -> Column:
    """Count from a column of the given Spark type: text, number, or list (its length)."""
    if kind.startswith("array"):
        return F.when(c.isNotNull(), F.size(c).cast("double"))
    if kind == "string":
        return parse_count(c)
    return c.cast("double")


def safe_log1p(c: Column) -> Column:
    return F.when(c >= 0, F.log1p(c)).otherwise(F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """a / b, or 0 when either is missing or b is not positive."""
    return F.when(a.isNotNull() & (b > 0), a / b).otherwise(F.lit(0.0))


def engagement_features(counts: Mapping[str, Column]) -> dict[str, Column]:
    """The twelve engagement features from the five counts, in vector order."""
    kinds = ("likes", "comments", "shares", "bookmarks", "views")
    views = counts["views"]
    out = {f"{k}_log": safe_log1p(counts[k]) for k in kinds}
    for k in kinds[:4]:
        out[f"{k[:-1]}_rate"] = ratio(counts[k], views)
    total = sum((F.coalesce(counts[k], F.lit(0.0)) for k in kinds[1:4]),
                F.coalesce(counts["likes"], F.lit(0.0)))
    out["engagement_rate"] = ratio(total, views)
    out["has_views"] = views.isNotNull().cast("double")
    out["has_bookmarks"] = counts["bookmarks"].isNotNull().cast("double")
    return out
