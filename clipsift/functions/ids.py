"""Identifiers from URLs and object paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def id_from_url(url: Column, marker: str = "/video/") -> Column:
    """Text after the last marker, without the query string."""
    return strip_query(F.substring_index(url, marker, -1))


def segment_id(path: Column, back: int = 2, at_least: int = 5) -> Column:
    """The path segment ``back`` from the end, for paths of at least ``at_least`` segments."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= at_least, F.try_element_at(parts, F.lit(-back)))


def layer_id(path: Column, layer: str = "bronze") -> Column:
    """The segment that follows the first ``layer/`` in the path; null without it."""
    after = F.regexp_extract(path, rf"^.*?{layer}/([^/]*)", 1)
    return F.when(F.contains(path, F.lit(f"{layer}/")), after)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-case extension with its dot; empty for none and for dot files."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+?(\.[^.]*)?$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def underscored(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("_"))


def composite_id(split: Column, label: Column, file_stem: Column) -> Column:
    """``{split}_{label}_{stem}`` with blanks as underscores and the label in lower case."""
    return F.concat_ws("_", split, F.lower(underscored(label)), underscored(file_stem))


def numbered_id(split: Column, slug: Column, number: Column, width: int = 6) -> Column:
    """``{split}_{slug}_{000001}``; numbers wider than ``width`` keep all their digits."""
    digits = number.cast("string")
    return F.concat_ws("_", split, slug, F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))
