"""Pieces of plain SQL shared by the checks."""

from __future__ import annotations

from clipsift.functions.text import EMOJI_TOKENS

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def emojis(x: str) -> str:
    for token, signs in EMOJI_TOKENS.items():
        x = f"regexp_replace({x}, '{'|'.join(signs)}', ' {token} ', 'g')"
    return x


def blanks(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def clean(x: str) -> str:
    return blanks(emojis(f"coalesce({x}, '')"))


def count(x: str) -> str:
    """Display count -> double."""
    t = f"upper(trim({x}))"
    body = f"trim(regexp_replace({t}, '[KMB]$', ''))"
    factor = f"CASE right({t}, 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 ELSE 1e0 END"
    return f"CASE WHEN regexp_matches({body}, '{NUMBER}') THEN TRY_CAST({body} AS DOUBLE) * {factor} END"


def log1p(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN ln(1 + CAST({x} AS DOUBLE)) ELSE 0e0 END"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NOT NULL AND {b} > 0 THEN {a} / {b} ELSE 0e0 END"


def words(x: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> ''))"


def month_day(x: str) -> tuple[str, str, str]:
    """(valid, month, day) of a month-day text."""
    parts = f"regexp_split_to_array(trim({x}), '[-/.]')"
    month = f"TRY_CAST(trim({parts}[1]) AS INTEGER)"
    day = f"TRY_CAST(trim({parts}[2]) AS INTEGER)"
    valid = f"(len({parts}) = 2 AND {month} BETWEEN 1 AND 12 AND {day} BETWEEN 1 AND 31)"
    return valid, month, day


def date_of(x: str, year: int) -> str:
    valid, month, day = month_day(x)
    stamp = f"printf('%04d-%02d-%02d', {year}, {month}, {day})"
    return f"CASE WHEN {valid} THEN TRY_CAST({stamp} AS DATE) END"


def holds_word(x: str, words: tuple[str, ...]) -> str:
    edge = r"[^\p{L}\p{N}]"
    return rf"regexp_matches({x}, '(?i)(^|{edge})({'|'.join(words)})({edge}|$)')"


def near(x: str, digits: int) -> str:
    """Nearest value with that many decimals, in plain arithmetic."""
    return f"floor(({x}) * 1e{digits} + 0.5::DOUBLE) / 1e{digits}"
