"""Text cleaning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Emoji sets and the token each set is replaced by.
EMOJI_TOKENS = {
    "<EMOJI_LAUGH>": ("😂", "🤣", "😄", "😆", "😅", "😹", "😸"),
    "<EMOJI_SAD>": ("😔", "😢", "😭", "😞", "☹️", "🙁"),
    "<EMOJI_SCARE>": ("😱", "🤯", "😨", "😰", "😧"),
}
LAUGH_EMOJIS = EMOJI_TOKENS["<EMOJI_LAUGH>"]
SEPARATOR = " [SEP] "


# Every sign outside the basic plane starts with these UTF-8 bytes up to U+1FFFF.
ASTRAL_PREFIX = bytearray(b"\xf0\x9f")


def any_of(signs) -> str:
    """Pattern for one of the signs; single code points go into one class."""
    single = "".join(s for s in signs if len(s) == 1)
    return "|".join([f"[{single}]", *(s for s in signs if len(s) > 1)])


def may_have_emoji(c: Column) -> Column:
    """Cheap byte test that is true for every text holding one of the emojis."""
    plain = {s[0] for signs in EMOJI_TOKENS.values() for s in signs if ord(s[0]) < 0x10000}
    found = F.contains(c.cast("binary"), F.lit(ASTRAL_PREFIX))
    for sign in sorted(plain):
        found = found | F.contains(c, F.lit(sign))
    return found


def map_emojis(c: Column) -> Column:
    """One regex pass per emoji set, only for texts that may hold an emoji."""
    mapped = c
    for token, signs in EMOJI_TOKENS.items():
        mapped = F.regexp_replace(mapped, any_of(signs), f" {token} ")
    return F.when(may_have_emoji(c), mapped).otherwise(c)


def strip_hashtags(c: Column) -> Column:
    return F.when(
        F.contains(c, F.lit("#")), F.regexp_replace(c, r"(?U)#\S+", "")
    ).otherwise(c)


def normalize_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_text(c: Column, normalizer: Callable[[Column], Column] | None = None) -> Column:
    """Normaliser, emoji tokens, single blanks; null becomes the empty string."""
    c = F.coalesce(c, F.lit(""))
    if normalizer is not None:
        c = normalizer(c)
    return normalize_whitespace(map_emojis(c))


def tag_text(tags: Column) -> Column:
    return F.array_join(F.transform(tags, lambda t: F.ltrim(t, F.lit("#"))), " ")


def join_comments(comments: Column) -> Column:
    return F.array_join(F.transform(comments, lambda t: normalize_text(t)), SEPARATOR)


def truncate(c: Column, n: int = 600) -> Column:
    return F.substring(c, 1, n)


def merged_text(caption: Column, comments: Column) -> Column:
    """Cleaned caption followed by the cleaned comments, as one text."""
    spoken = F.array_join(
        F.filter(F.transform(F.coalesce(comments, F.array().cast("array<string>")), lambda t: normalize_text(t)),
                 lambda t: t != ""), " "
    )
    return merged_with(caption, spoken)


def merged_with(caption: Column, spoken: Column) -> Column:
    """Cleaned caption followed by a text of cleaned comments, as one text."""
    return F.trim(F.concat_ws(" ", normalize_text(strip_hashtags(caption)), spoken))


def has_laugh(c: Column) -> Column:
    return c.rlike(any_of(LAUGH_EMOJIS))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda t: t != ""))
