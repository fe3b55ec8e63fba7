"""Comment trees held as arrays inside a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsift.functions.text import has_laugh, word_count

# Names of the comment statistics, in order.
STAT_FIELDS = (
    "n_comments",
    "avg_len_chars",
    "avg_len_words",
    "frac_has_laugh_emoji",
    "frac_has_question",
)

# Default word lists of the rule classifiers.
TOXIC_WORDS = ("hate", "kill", "stupid", "ugly", "idiot", "die", "trash")
CONSTRUCTIVE_WORDS = ("because", "should", "suggest", "improve", "please", "agree", "reason")


def flatten_comments(tree: Column) -> Column:
    """Root text followed by its replies, in order, empty texts left out."""
    texts = F.flatten(
        F.transform(
            tree,
            lambda c: F.concat(
                F.array(c["text"]),
                F.coalesce(
                    F.transform(c["replies"], lambda r: r["text"]),
                    F.array().cast("array<string>"),
                ),
            ),
        )
    )
    return F.filter(texts, lambda t: F.coalesce(t, F.lit("")) != "")


def _mean(comments: Column, value: Callable[[Column], Column]) -> Column:
    summed = F.aggregate(
        comments, F.lit(0.0), lambda acc, t: acc + value(t).cast("double")
    )
    return F.when(F.size(comments) > 0, summed / F.size(comments)).otherwise(F.lit(0.0))


def comment_stats(comments: Column) -> Column:
    """struct of the five comment statistics of an array of texts; zeros when empty."""
    values = (
        F.greatest(F.size(comments), F.lit(0)).cast("double"),
        _mean(comments, F.length),
        _mean(comments, word_count),
        _mean(comments, has_laugh),
        _mean(comments, lambda t: F.contains(t, F.lit("?"))),
    )
    return F.struct(*[v.alias(n) for n, v in zip(STAT_FIELDS, values)])


def has_word(words) -> Callable[[Column], Column]:
    """Rule classifier: 1 when the whole text holds one of the words, 0 for blank text."""
    pattern = r"(?i)(?<![\p{L}\p{N}])(" + "|".join(words) + r")(?![\p{L}\p{N}])"
    return lambda c: F.coalesce(c.rlike(pattern), F.lit(False)).cast("int")


is_toxic = has_word(TOXIC_WORDS)
is_constructive = has_word(CONSTRUCTIVE_WORDS)


def comment_flags(comments: Column, classifier: Callable[[Column], Column], name: str) -> Column:
    """struct(n_<name>_comments, frac_<name>_comments) over the non-blank comments."""
    spoken = F.filter(comments, lambda t: F.trim(t) != "")
    hits = F.aggregate(spoken, F.lit(0.0), lambda acc, t: acc + classifier(t).cast("double"))
    share = F.when(F.size(spoken) > 0, hits / F.size(spoken)).otherwise(F.lit(0.0))
    return F.struct(hits.alias(f"n_{name}_comments"), share.alias(f"frac_{name}_comments"))
