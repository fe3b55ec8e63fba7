"""Column-level reshaping of posts, predictions and paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.functions import ids
from clipsift.operators.ordering import numbered

# Artefact file names below an item's folder.
FEATURE_FILES = {
    "audio": "audio_embedding.npy",
    "video": "video_embedding.npy",
    "text": "metadata_features.npz",
}
MEDIA_FILE = "video.mp4"

# The unified post schema.
POST_COLUMNS = {
    "video_id": "string",
    "url": "string",
    "description": "string",
    "author": "string",
    "date": "string",
    "likes": "string",
    "comments": "string",
    "shares": "string",
    "bookmarks": "string",
    "views": "string",
    "tags": "array<string>",
    "comments_tree": "array<struct<text:string,replies:array<struct<text:string>>>>",
    "source": "string",
    "ts": "double",
}
STAT_COLUMNS = ("likes", "comments", "comments_count", "shares", "bookmarks", "views")


def with_audit(df: DataFrame, name: str = "ingested_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def with_media_path(df: DataFrame, root: str, key: str = "video_id") -> DataFrame:
    path = F.concat(F.lit(root), F.col(key).cast("string"), F.lit(f"/{MEDIA_FILE}"))
    return df.withColumn("bronze_video_path", path)


def with_feature_paths(
    df: DataFrame, root: str, kinds: Sequence[str] = ("audio", "video", "text"), key: str = "video_id"
) -> DataFrame:
    return df.withColumns(
        {
            f"{k}_feat_path": F.concat(
                F.lit(root), F.col(key).cast("string"), F.lit(f"/{FEATURE_FILES[k]}")
            )
            for k in kinds
        }
    )


def extract_stats(df: DataFrame, map_col: str = "stats") -> DataFrame:
    """Counts from the stats map, or from top-level columns where the map lacks them.

    ``likes`` is a whole number (unreadable text -> null), the other two stay text.
    """
    def pick(key: str, column: str) -> Column:
        found = F.col(map_col).getItem(key)
        return F.coalesce(found, F.col(column)) if column in df.columns else found

    return df.withColumns(
        {
            "likes": pick("likes", "likes").try_cast("long"),
            "comments_count": pick("comments", "comments_count"),
            "shares": pick("shares", "shares"),
        }
    )


def flatten_prediction(df: DataFrame, response: str = "response") -> DataFrame:
    """Scoring response plus event fields -> one flat prediction record."""
    r = F.col(response)
    return df.select(
        r["video_id"].alias("video_id"),
        r["label_name"].alias("label"),
        r["label_id"].alias("label_id"),
        r["confidence"].alias("confidence"),
        r["probabilities"].alias("probabilities"),
        r["processing_time_ms"].alias("processing_time"),
        "source",
        "raw_path",
        "timestamp",
    )


def with_link(df: DataFrame, template: str, key: str = "video_id", name: str = "link") -> DataFrame:
    """``template`` with ``{}`` replaced by the id."""
    head, tail = template.split("{}")
    return df.withColumn(name, F.concat(F.lit(head), F.col(key).cast("string"), F.lit(tail)))


def canonical_urls(df: DataFrame, col: str, site: str, marker: str = "/video/") -> DataFrame:
    """Distinct absolute URLs holding the marker, without query strings."""
    href = F.col(col)
    full = F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(site), href))
    return (
        df.filter(F.contains(href, F.lit(marker)))
        .select(ids.strip_query(full).alias("url"))
        .distinct()
    )


def running_index_id(
    df: DataFrame, keys: tuple[str, str], order: Sequence[str], width: int = 6
) -> DataFrame:
    """Add ``{split}_{slug}_{000001}`` numbered per (split, slug) in the given order."""
    ranked = numbered(df, keys, order, "_rn")
    ident = ids.numbered_id(F.col(keys[0]), F.col(keys[1]), F.col("_rn"), width)
    return ranked.withColumn("video_id", ident).drop("_rn")


def unify_metadata(df: DataFrame) -> DataFrame:
    """Any crawl variant -> the unified post schema; ``N/A`` and absent fields -> null."""
    have = set(df.columns)

    def first(*names: str) -> Column:
        found = [F.col(n) for n in names if n in have]
        if "stats" in have:
            found += [F.col("stats").getItem(n) for n in names if n in STAT_COLUMNS]
        return F.coalesce(*found) if found else F.lit(None)

    def tree() -> Column:
        if "comments_tree" not in have:
            return F.lit(None)
        fields = df.schema["comments_tree"].dataType.elementType.names
        replies = (lambda c: c["replies"]) if "replies" in fields else (lambda c: F.lit(None))
        return F.transform(
            "comments_tree", lambda c: F.struct(c["text"].alias("text"), replies(c).alias("replies"))
        )

    wanted = {
        "video_id": first("video_id")
        if "video_id" in have
        else ids.id_from_url(first("url", "videoUrl")),
        "url": first("url", "videoUrl"),
        "comments": first("comments_count", "comments"),
        "comments_tree": tree(),
        "ts": first("timestamp"),
    }
    out = []
    for name, kind in POST_COLUMNS.items():
        value = wanted.get(name, first(name)).cast(kind)
        if kind == "string":
            value = F.nullif(value, F.lit("N/A"))
        out.append(value.alias(name))
    return df.select(*out)


def last_wins(df: DataFrame, key: str, value: str, ordinal: str) -> DataFrame:
    """One row per key with the value of the highest ordinal."""
    return df.groupBy(key).agg(F.max_by(value, ordinal).alias(value))

