"""Equi-joins on item ids.

Right-hand sides are reduced to one row per id first, so a join never multiplies rows; a hot id
on the left is split by adaptive skew-join handling. No broadcast is forced: Spark converts a
side it has measured to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.functions.labels import DEFAULT_LABEL, UNLABELLED, map_label
from clipsift.functions.vectors import select_dims

# The 25 numeric features in vector order.
NUMERIC_FEATURES = (
    "likes_log",
    "comments_log",
    "shares_log",
    "bookmarks_log",
    "views_log",
    "like_rate",
    "comment_rate",
    "share_rate",
    "bookmark_rate",
    "engagement_rate",
    "has_views",
    "has_bookmarks",
    "age_days",
    "month_sin",
    "month_cos",
    "has_date",
    "n_comments",
    "avg_len_chars",
    "avg_len_words",
    "frac_has_laugh_emoji",
    "frac_has_question",
    "n_toxic_comments",
    "frac_toxic_comments",
    "n_constructive_comments",
    "frac_constructive_comments",
)
COUNT_FEATURES = ("n_comments", "n_toxic_comments", "n_constructive_comments")


def one_per_id(df: DataFrame, key: str, ordinal: str | None = None) -> DataFrame:
    """One row per id: the last in the order of ``ordinal``, without one the greatest row.

    Partial aggregation before the shuffle; a join on the id needs no further one.
    """
    rest = [c for c in df.columns if c != key]
    row = F.struct(*rest)
    best = F.max(row) if ordinal is None else F.max_by(row, F.struct(ordinal, *[c for c in rest if c != ordinal]))
    return df.groupBy(key).agg(best.alias("_row")).select(key, "_row.*")


def count_positions(names: Sequence[str] = NUMERIC_FEATURES) -> list[int]:
    return [i for i, n in enumerate(names) if n in COUNT_FEATURES]


def assemble_features(
    video: DataFrame,
    audio: DataFrame,
    meta: DataFrame,
    labels: DataFrame | None = None,
    key: str = "video_id",
    drop: Sequence[int] | None = None,
) -> DataFrame:
    """Items that have all three feature sets, with their label (-1 when there is none).

    ``video``(key, video_emb), ``audio``(key, audio_emb), ``meta``(key, numeric_scaled,
    comments_emb), ``labels``(key, label). Repeated ids on the right give one row.
    """
    rows = video.join(one_per_id(audio.select(key, "audio_emb"), key), key)
    rows = rows.join(one_per_id(meta.select(key, "numeric_scaled", "comments_emb"), key), key)
    return finish_rows(rows, labels, key, drop)


def finish_rows(
    rows: DataFrame,
    labels: DataFrame | None = None,
    key: str = "video_id",
    drop: Sequence[int] | None = None,
) -> DataFrame:
    """Gold rows from joined features: incomplete rows out, count features out, label in."""
    drop = count_positions() if drop is None else drop
    rows = rows.filter("video_emb is not null and audio_emb is not null")
    rows = rows.filter("numeric_scaled is not null and comments_emb is not null")
    if labels is not None:
        rows = rows.join(one_per_id(labels.select(key, "label"), key), key, "left")
    else:
        rows = rows.withColumn("label", F.lit(None).cast("int"))
    numeric = select_dims(F.col("numeric_scaled"), drop) if drop else F.col("numeric_scaled")
    return rows.select(
        key,
        F.col("video_emb").cast("array<float>").alias("video_emb"),
        F.col("audio_emb").cast("array<float>").alias("audio_emb"),
        F.col("comments_emb").cast("array<float>").alias("text_emb"),
        numeric.cast("array<float>").alias("metadata_numeric"),
        F.coalesce(F.col("label"), F.lit(UNLABELLED)).cast("int").alias("label"),
    )


def json_label(value: Column) -> Column:
    """Label held as JSON text: a whole number as is, a string by vocabulary, null -> null."""
    text = F.trim(value)
    quoted = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string")["v"]
    return (
        F.when(text.isNull() | (text == "null"), F.lit(None).cast("int"))
        .when(text.rlike(r"^-?[0-9]+$"), text.try_cast("int"))
        .when(text.isin("true", "false"), (text == "true").cast("int"))
        .otherwise(map_label(quoted))
    )


def _given(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def bronze_label(label: Column, raw: Column, empty_raw_counts: bool = True) -> Column:
    """``label``, else ``label_raw``; an empty ``label`` is missing.

    With ``empty_raw_counts`` an empty ``label_raw`` still yields the default class.
    """
    fallback = F.when(_given(raw), map_label(raw))
    if empty_raw_counts:
        fallback = F.when(_given(raw), map_label(raw)).when(raw.isNotNull(), F.lit(DEFAULT_LABEL))
    return F.when(_given(label), map_label(label)).otherwise(fallback)


def resolve_label(
    items: DataFrame,
    gold: DataFrame,
    silver: DataFrame,
    bronze: DataFrame,
    key: str = "video_id",
    default: int = UNLABELLED,
    ordinal: str | None = None,
) -> DataFrame:
    """Add ``stored_label`` (gold, silver, bronze) and ``row_label`` (silver, bronze, stored).

    ``gold``/``silver`` carry the label as JSON text in ``label``; ``bronze`` carries the texts
    ``label`` and ``label_raw``. Of repeated ids the last by ``ordinal`` counts.
    """
    order = [ordinal] if ordinal else []
    gold, silver = (one_per_id(t.select(key, "label", *order), key, ordinal) for t in (gold, silver))
    bronze = one_per_id(bronze.select(key, "label", "label_raw", *order), key, ordinal)
    joined = (
        items.join(gold.select(key, json_label(F.col("label")).alias("_gold")), key, "left")
        .join(silver.select(key, json_label(F.col("label")).alias("_silver")), key, "left")
        .join(
            bronze.select(
                key,
                bronze_label(F.col("label"), F.col("label_raw")).alias("_bronze"),
                bronze_label(F.col("label"), F.col("label_raw"), False).alias("_given"),
            ),
            key,
            "left",
        )
    )
    stored = F.coalesce("_gold", "_silver", "_bronze")
    return joined.withColumns(
        {
            "stored_label": stored,
            "row_label": F.coalesce(F.col("_silver"), F.col("_given"), stored, F.lit(default)),
        }
    ).drop("_gold", "_silver", "_bronze", "_given")


def _given_labels(labels: DataFrame, key: str, ordinal: str | None, name: str) -> DataFrame:
    columns = [key, "label", *([ordinal] if ordinal else [])]
    return one_per_id(labels.select(*columns), key, ordinal).select(key, F.col("label").alias(name))


def update_labels(
    df: DataFrame, labels: DataFrame, key: str = "video_id", ordinal: str | None = None
) -> DataFrame:
    """Replace labels by the given ones; ``changed`` marks rows whose value differs.

    Of several labels for one id the last by ``ordinal`` counts.
    """
    new = _given_labels(labels, key, ordinal, "_new")
    return (
        df.join(new, key, "left")
        .withColumn("changed", F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("label")))
        .withColumn("label", F.coalesce("_new", "label"))
        .drop("_new")
    )


def verify_labels(
    df: DataFrame, manual: DataFrame, key: str = "video_id", ordinal: str | None = None
) -> DataFrame:
    """Add ``status`` (match, mismatch, missing) and ``verified_label`` (manual wins).

    Of several manual labels for one id the last by ``ordinal`` counts.
    """
    joined = df.join(_given_labels(manual, key, ordinal, "_manual"), key, "left")
    status = (
        F.when(F.col("_manual").isNull(), "missing")
        .when(F.col("_manual") == F.col("label"), "match")
        .otherwise("mismatch")
    )
    return (
        joined.withColumn("status", status)
        .withColumn("verified_label", F.coalesce("_manual", "label"))
        .drop("_manual")
    )


def verification_summary(verified: DataFrame) -> DataFrame:
    """Counts per status and whether a verified set should be published."""
    counts = verified.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("match", "mismatch", "missing")]
    )
    return counts.withColumn("publish", (F.col("mismatch") > 0) | (F.col("missing") == 0))


def annotator_overlap(a: DataFrame, b: DataFrame, key: str, value: str = "choice") -> DataFrame:
    """Items both annotators labelled, once each: (key, y1, y2)."""
    return one_per_id(a.select(key, F.col(value).alias("y1")), key).join(
        one_per_id(b.select(key, F.col(value).alias("y2")), key), key
    )


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    return df.join(seen.select(key), key, "left_anti")


def resume_split(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Add ``reused``: whether the id has been processed before (one pass, one join)."""
    known = done.select(key).distinct().withColumn("_done", F.lit(True))
    return df.join(known, key, "left").withColumn(
        "reused", F.coalesce("_done", F.lit(False))
    ).drop("_done")
