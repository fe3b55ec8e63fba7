"""Line-first quality rules, as column expressions only.

Every line with a word is held against punctuation, navigation, boilerplate, symbol and shouting
rules. Failing lines go; a document that loses too large a share of its text goes as a whole. No
shuffle: each document is judged in its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.llm.common import text_of

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5  # words in a repeated window
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_LOST_PCT = 50  # share of the characters in words that removed lines may hold

# Patterns of the line rules; the same text is valid for Java's and RE2's engines.
LINE_END = r"[.!?…:;,\"'”’»)\]]$"
SEPARATORS = r"[|»›•·¦]"
BOILERPLATE = (
    r"(?i)lorem ipsum|all rights reserved|privacy policy|terms of (use|service)|cookie (policy|settings)"
    r"|use of cookies|enable javascript|click here|subscribe to|sign up for|log ?in to|skip to (main )?content"
    r"|^(home|menu|search|share|next|previous|back to top)$|licen[sc]ed under|released under the"
)
SYMBOL = r"[^#*$%&|<>{}=^~@\\]"  # removed, what stays are symbols
LETTER = r"[^\p{L}]"
CAPITAL = r"[^\p{Lu}]"
MIN_LINE_WORDS = 6  # a line with fewer needs no closing mark to be a heading
MIN_SEPARATORS = 3
MIN_CAPITALS = 20


def words_of(text: Column) -> Column:
    """Runs of anything but the six ASCII space characters."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[\x20\x09-\x0D]+")
    )


def line_fails(line: Column) -> Column:
    """Whether a line (with a word in it) breaks one of the rules."""
    bare = F.btrim(line, F.lit(SPACES))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(bare, pattern, ""))

    # Cheap rules first; the classes are counted only on lines that they pass.
    unended = ~F.rlike(bare, F.lit(LINE_END)) & (F.size(F.split(bare, r"[\x20\x09-\x0D]+")) >= MIN_LINE_WORDS)
    navigation = F.regexp_count(bare, F.lit(SEPARATORS)) >= MIN_SEPARATORS
    boilerplate = F.rlike(bare, F.lit(BOILERPLATE))
    symbols = left(SYMBOL) * 10 > F.length(bare)
    shouting = (left(CAPITAL) >= MIN_CAPITALS) & (left(CAPITAL) * 10 > left(LETTER) * 6)
    return unended | navigation | boilerplate | symbols | shouting


def _chars(text: Column) -> Column:
    """Code points that are not one of the six spaces."""
    return F.length(F.translate(text, SPACES, ""))


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows whose hash stands in the array twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(
        F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(None)
    ).otherwise(pairs)


def clean_lines(
    docs: DataFrame,
    max_lost_pct: int = MAX_LOST_PCT,
    min_words: int = MIN_WORDS,
    max_repeat_pct: int = MAX_REPEAT_PCT,
) -> DataFrame:
    """Judge every whole text.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines_failed, lost_chars, clean_text (failing lines removed), kept. A null or empty text has
    no words and fails. Null and repeated doc_ids are judged row by row; an empty table gives no
    rows; other columns are not read.
    """
    rows = docs.select("doc_id", text_of(docs).alias("t"))
    rows = rows.select("doc_id", "t", words_of(F.col("t")).alias("w"), F.split("t", "\n").alias("l"))
    rows = rows.select(
        "doc_id",
        "t",
        "l",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.filter("l", lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("full"),
        F.when(
            F.size("w") > WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("w") - WINDOW),
                lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]),
            ),
        ).alias("h"),
    )
    rows = rows.select(
        "doc_id",
        "t",
        "l",
        "n_words",
        "word_chars",
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("h").isNotNull(), _repeat_words(F.col("h"))).alias("s"),
        F.filter("full", line_fails).alias("bad"),
    )
    rows = rows.withColumn(
        "p",
        F.array_sort(F.transform(
            F.filter("s", lambda x, k: (F.get("s", k - 1)["h"] == x["h"]) | (F.get("s", k + 1)["h"] == x["h"])),
            lambda x: x["i"],
        )),
    )
    covered = F.aggregate(
        F.transform("p", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("p", k + 1) - x, F.lit(WINDOW)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    rows = rows.select(
        "doc_id",
        "t",
        "l",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("bad").cast("long").alias("n_lines_failed"),
        _chars(F.array_join("bad", "")).cast("long").alias("lost_chars"),
    )
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words")
    )
    stays = F.filter("l", lambda x: (F.btrim(x, F.lit(SPACES)) == "") | ~line_fails(x))
    clean = F.when(F.col("n_lines_failed") == 0, F.col("t")).otherwise(F.array_join(stays, "\n"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        "n_lines_failed",
        "lost_chars",
        clean.alias("clean_text"),
        (~base_failed & (100 * F.col("lost_chars") <= max_lost_pct * F.col("word_chars"))).alias("kept"),
    )
