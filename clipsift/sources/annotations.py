"""Annotation exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift import schemas
from clipsift.functions.ids import segment_id
from clipsift.functions.labels import annotation_label
from clipsift.operators.projections import last_wins


def first_choices(task: Column) -> Column:
    """Choices of the first result of the first annotation; null when a step is missing."""
    result = F.get(task["annotations"], F.lit(0))["result"]
    return F.get(result, F.lit(0))["value"]["choices"]


def parse_tasks(df: DataFrame, json_col: str, ordinal: str) -> DataFrame:
    """One task per row of JSON text -> (ordinal, path, choices)."""
    task = F.from_json(F.col(json_col), schemas.ANNOTATION_TASK)
    return df.select(F.col(ordinal).alias("ordinal"), task.alias("t")).select(
        "ordinal", F.col("t.data.video").alias("path"), first_choices(F.col("t")).alias("choices")
    )


def parse_annotations(df: DataFrame, json_col: str, ordinal: str) -> DataFrame:
    """(video_id, label): id from the path, known choices only, the last task of an id wins."""
    tasks = parse_tasks(df, json_col, ordinal)
    named = tasks.select(
        "ordinal",
        segment_id(F.col("path")).alias("video_id"),
        annotation_label(F.get("choices", F.lit(0))).alias("label"),
    ).filter("video_id is not null and label is not null")
    return last_wins(named, "video_id", "label", "ordinal")


def parse_annotations_by_path(df: DataFrame, json_col: str, ordinal: str) -> DataFrame:
    """(path, choice) with the raw choice; the last task of a path wins."""
    tasks = parse_tasks(df, json_col, ordinal)
    named = tasks.select(
        "ordinal", "path", F.get("choices", F.lit(0)).alias("choice")
    ).filter("path is not null and choice is not null")
    return last_wins(named, "path", "choice", "ordinal")
