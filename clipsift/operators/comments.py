"""Comment trees and comment statistics over comment rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.functions.counts import strip
from clipsift.functions.text import SEPARATOR, has_laugh, normalize_text, word_count
from clipsift.operators.ordering import first_per_key, numbered, running_totals

# Positions per slice when root numbers are counted and texts joined.
POSITION_SPAN = 4096


def build_comment_tree(
    nodes: DataFrame,
    key: str = "video_id",
    pos: str = "pos",
    level: str = "level",
    text: str = "text",
    max_total: int | None = None,
    max_replies: int | None = None,
    span: int = POSITION_SPAN,
) -> DataFrame:
    """Accepted nodes as (key, pos, root_no, level, text).

    Level 1 is a root, level 2 a reply. Blank texts and replies before the first root are skipped.
    A crawl's limits can be given: each root then keeps ``max_replies`` replies, and the key the
    first ``max_total`` accepted nodes; without them everything is kept. Root numbers are counted
    over slices of ``span`` positions, so a key with very many nodes is spread over tasks; both
    limits cut rows before their shuffle.
    """
    shown = nodes.select(
        key, F.col(pos).alias("pos"), F.col(level).alias("level"),
        strip(F.col(text)).alias("text"),
    ).filter("text <> '' and level in (1, 2)")
    rooted = running_totals(
        shown,
        [key],
        ["pos"],
        {"root_no": (F.col("level") == 1).cast("long")},
        bucket=F.floor(F.col("pos") / F.lit(span)),
    ).filter("root_no > 0")
    kept = rooted
    if max_replies is not None and max_replies < 1:
        kept = rooted.filter("level = 1")
    elif max_replies is not None:
        # Roots are numbered one by one, so a limit on their rows keeps them all.
        kept = first_per_key(rooted, [key, "root_no", "level"], ["pos"], max_replies, "_r").drop("_r")
    if max_total is not None:
        kept = first_per_key(kept, [key], ["pos"], max_total, "_r").drop("_r")
    return kept.select(key, "pos", "root_no", "level", "text")


def nest_comment_tree(nodes: DataFrame, key: str = "video_id") -> DataFrame:
    """Accepted nodes -> one nested ``comments_tree`` per key, the stored shape of a post's comments.

    A post's comments are one array in one row here; statistics of very many comments come from
    the rows (``comment_stats_by``, ``comment_flags_by``).
    """
    is_reply = F.col("level") != 1
    roots = nodes.groupBy(key, "root_no").agg(
        F.min_by("text", "pos").alias("text"),
        F.array_sort(F.collect_list(F.when(is_reply, F.struct("pos", "text")))).alias("replies"),
    )
    root = F.struct(
        "root_no",
        "text",
        F.transform("replies", lambda r: F.struct(r["text"].alias("text"))).alias("replies"),
    )
    trees = roots.groupBy(key).agg(F.array_sort(F.collect_list(root)).alias("t"))
    return trees.select(
        key,
        F.transform(
            "t", lambda r: F.struct(r["text"].alias("text"), r["replies"].alias("replies"))
        ).alias("comments_tree"),
    )


def flatten_comment_rows(nodes: DataFrame, key: str = "video_id", span: int = POSITION_SPAN) -> DataFrame:
    """Accepted nodes -> (key, idx, text), ``idx`` from 0 in reading order.

    A root stands before its replies, so reading order is the order of positions; they are
    counted over slices, and no post's comments are collected.
    """
    rows = nodes.filter("text <> ''").select(key, "pos", "text")
    counted = numbered(rows, [key], ["pos"], "idx", bucket=F.floor(F.col("pos") / F.lit(span)))
    return counted.select(key, (F.col("idx") - 1).alias("idx"), "text")


def joined_text_by(
    rows: DataFrame, key: str, pos: str = "pos", text: str = "text", sep: str = SEPARATOR,
    out: str = "joined", blanks: bool = True, span: int = POSITION_SPAN,
) -> DataFrame:
    """One text per key from its cleaned rows in the order of ``pos``, nulls as empty texts.

    Pieces of ``span`` positions are joined first, wherever their rows are; a key then collects
    one value a piece. Without ``blanks`` rows that are empty after cleaning are left out.
    """
    shown = rows.select(
        F.col(key).alias("_key"), F.col(pos).alias("_pos"), normalize_text(F.col(text)).alias("_text"),
        F.floor(F.col(pos) / F.lit(span)).alias("_piece"),
    )
    if not blanks:
        shown = shown.filter("_text <> ''")

    def together(df: DataFrame, by: list[str], order: str) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(order, "_text")))
        return df.groupBy(*by).agg(F.array_join(F.transform(parts, lambda x: x["_text"]), sep).alias("_text"))

    pieces = together(shown, ["_key", "_piece"], "_pos")
    return together(pieces, ["_key"], "_piece").select(F.col("_key").alias(key), F.col("_text").alias(out))


def _stat_columns(t: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).cast("double").alias("n_comments"),
        F.avg(F.length(t)).alias("avg_len_chars"),
        F.avg(word_count(t)).alias("avg_len_words"),
        F.avg(has_laugh(t).cast("double")).alias("frac_has_laugh_emoji"),
        F.avg(F.contains(t, F.lit("?")).cast("double")).alias("frac_has_question"),
    ]


def comment_stats_by(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The five comment statistics per key from comment rows (partial aggregation)."""
    return df.groupBy(key).agg(*_stat_columns(F.col(text)))


def comment_flags_by(
    df: DataFrame,
    key: str,
    classifiers: dict[str, Callable[[Column], Column]],
    text: str = "text",
) -> DataFrame:
    """Count and share of flagged comments per key over the non-blank comments."""
    return df.groupBy(key).agg(*_flag_columns(F.col(text), classifiers))


def comment_features_by(
    df: DataFrame, key: str, classifiers: dict[str, Callable[[Column], Column]], text: str = "text", stats_on_raw: bool = False,
) -> DataFrame:
    """Statistics and flags of the cleaned comments per key, in one aggregation.

    With ``stats_on_raw`` the five statistics are of the comments as they are.
    """
    clean = df.select(key, F.col(text).alias("_raw"), normalize_text(F.col(text)).alias("_clean"))
    stats = _stat_columns(F.col("_raw" if stats_on_raw else "_clean"))
    return clean.groupBy(key).agg(*stats, *_flag_columns(F.col("_clean"), classifiers))


def _flag_columns(t: Column, classifiers: dict[str, Callable[[Column], Column]]) -> list[Column]:
    spoken = F.trim(t) != ""
    n = F.count_if(spoken)
    aggs = []
    for name, classify in classifiers.items():
        hits = F.count_if(spoken & (classify(t) == 1)).cast("double")
        aggs += [
            hits.alias(f"n_{name}_comments"),
            F.coalesce(F.try_divide(hits, n), F.lit(0.0)).alias(f"frac_{name}_comments"),
        ]
    return aggs
