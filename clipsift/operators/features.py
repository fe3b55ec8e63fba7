"""The numeric feature vector of a post."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsift.functions.comments import (
    STAT_FIELDS,
    comment_flags,
    comment_stats,
    is_constructive,
    is_toxic,
)
from clipsift.functions.counts import count_of, engagement_features
from clipsift.functions.dates import DATE_FIELDS, date_features_of, parse_mm_dd
from clipsift.functions.text import normalize_text
from clipsift.operators.comments import comment_features_by
from clipsift.operators.joins import NUMERIC_FEATURES

# Reference date and the year month-day strings are read in.
REFERENCE_DATE = dt.date(2025, 12, 5)
ASSUMED_YEAR = 2025

COUNT_COLUMNS = ("likes", "comments", "shares", "bookmarks", "views")


def numeric_vector(
    posts: DataFrame,
    ref: dt.date = REFERENCE_DATE,
    year: int = ASSUMED_YEAR,
    emoji_stats_on: str = "normalized",
    toxic=is_toxic,
    constructive=is_constructive,
    comments: DataFrame | None = None,
    key: str = "video_id",
) -> DataFrame:
    """Add the 25 feature columns and ``numeric_raw`` in one projection.

    ``posts`` has the five counts, ``date`` and ``comment_texts`` (array), unless ``comments`` holds
    them as rows (key, text): their statistics are then partial aggregates, so that a post may have
    any number of them. The statistics run on the normalised comments unless ``emoji_stats_on`` is
    ``"raw"``. Every post stays one row, also one without a key or with a repeated one.
    """
    schema = posts.schema
    kinds = {c: schema[c].dataType.simpleString() for c in COUNT_COLUMNS}
    counts = {c: count_of(F.col(c), kinds[c]) for c in COUNT_COLUMNS}
    work = posts.withColumns({f"_{c}": v for c, v in counts.items()}).withColumn("_day", parse_mm_dd(F.col("date")))
    if comments is None:
        texts = F.coalesce(F.col("comment_texts"), F.array().cast("array<string>"))
        work = work.withColumn("_clean", F.transform(texts, lambda t: normalize_text(t)))
        said = {
            "_stats": comment_stats(texts if emoji_stats_on == "raw" else F.col("_clean")),
            "_toxic": comment_flags(F.col("_clean"), toxic, "toxic"),
            "_constructive": comment_flags(F.col("_clean"), constructive, "constructive"),
        }
    else:
        rules = {"toxic": toxic, "constructive": constructive}
        rows = comment_features_by(comments, key, rules, stats_on_raw=emoji_stats_on == "raw")
        values = [F.struct(*[c for c in rows.columns if c != key]).alias("_said")]
        work = work.join(rows.select(key, *values), key, "left")
        zero = F.struct(*[F.lit(0.0).alias(c) for c in rows.columns if c != key])
        said = {name: F.coalesce("_said", zero) for name in ("_stats", "_toxic", "_constructive")}
    work = work.withColumns({"_date": date_features_of(F.col("_day"), ref, year), **said})
    found = engagement_features({c: F.col(f"_{c}") for c in COUNT_COLUMNS})
    found |= {n: F.col(f"_date.{n}") for n in DATE_FIELDS}
    found |= {n: F.col(f"_stats.{n}") for n in STAT_FIELDS}
    for name in ("toxic", "constructive"):
        found |= {n: F.col(f"_{name}.{n}") for n in (f"n_{name}_comments", f"frac_{name}_comments")}
    rows = work.select(*posts.columns, *[found[n].alias(n) for n in NUMERIC_FEATURES])
    return rows.withColumn("numeric_raw", F.array(*[F.col(n) for n in NUMERIC_FEATURES]))
