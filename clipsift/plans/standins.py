"""Views that give the input tables the shape of posts, comments, predictions and listings.

Each view is one table and a list of expressions valid in Spark SQL and in plain SQL, so a query
and its check read the same input. ``MICROS(x)`` stands for the epoch microseconds of ``x``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clipsift.tables import load


@dataclass(frozen=True)
class View:
    table: str
    columns: dict[str, str]

    def df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        exprs = [f"{_spark(e)} AS {c}" for c, e in self.columns.items()]
        return load(spark, sf_dir, self.table).selectExpr(*exprs)

    @property
    def sql(self) -> str:
        exprs = ", ".join(f"{_plain(e)} AS {c}" for c, e in self.columns.items())
        return f"(SELECT {exprs} FROM {self.table})"


def _spark(expr: str) -> str:
    return re.sub(r"MICROS\((\w+)\)", r"unix_micros(CAST(\1 AS TIMESTAMP))", expr)


def _plain(expr: str) -> str:
    return re.sub(r"MICROS\((\w+)\)", r"epoch_us(\1)", expr)


def whole(expr: str) -> str:
    return f"CAST(floor({expr}) AS BIGINT)"


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def display_count(amount: str, key: str, shift: int) -> str:
    """Amount as a display count: K, m with a decimal, N/A, padded, junk, plain or missing."""
    kilo, rest = text(whole(f"{amount} / 1000")), text(f"{whole(f'{amount} / 100')} % 10")
    plain = text(whole(amount))
    return (
        f"CASE ({key} + {shift}) % 7 WHEN 0 THEN concat({kilo}, 'K') "
        f"WHEN 1 THEN concat({kilo}, '.', {rest}, 'm') WHEN 2 THEN ' N/A ' "
        f"WHEN 3 THEN concat(' ', {plain}, ' ') WHEN 4 THEN concat({plain}, 'KK') "
        f"WHEN 5 THEN {plain} ELSE NULL END"
    )


MONTH_DAY = (
    "CASE o_orderkey % 9 WHEN 0 THEN '13-1' WHEN 1 THEN '2-30' WHEN 2 THEN '' "
    "WHEN 3 THEN NULL WHEN 4 THEN concat(CAST(month(o_orderdate) AS STRING), '/', "
    "CAST(day(o_orderdate) AS STRING)) WHEN 5 THEN ' 08.09 ' ELSE "
    "concat(CAST(month(o_orderdate) AS STRING), '-', CAST(day(o_orderdate) AS STRING)) END"
)

POSTS = View(
    "orders",
    {
        "video_id": text("o_orderkey"),
        "likes": display_count("o_totalprice", "o_orderkey", 0),
        "comments": display_count("o_totalprice / 7", "o_orderkey", 3),
        "shares": display_count("o_totalprice / 11", "o_orderkey", 5),
        "bookmarks": display_count("o_totalprice / 13", "o_orderkey", 1),
        "views": display_count("o_totalprice * 9", "o_orderkey", 4),
        "date": MONTH_DAY,
        "author": text("o_custkey"),
        "source": "o_orderpriority",
    },
)

COMMENTS = View(
    "conversations",
    {
        "video_id": text("conv_id"),
        "pos": "turn",
        "level": "CASE WHEN turn % 3 = 0 THEN 1 ELSE 2 END",
        "text": "CASE WHEN (conv_id + turn) % 13 = 0 THEN '   ' ELSE concat(text, "
        "CASE turn % 3 WHEN 0 THEN ' 😂 ?' WHEN 1 THEN ' 😢' ELSE '' END) END",
    },
)

PREDICTIONS = View(
    "events",
    {
        "video_id": text("event_id"),
        "label": "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '' "
        "ELSE event_type END",
        "processing_time": "value",
        "ingested_at": "ts",
        "timestamp": "MICROS(ts) / 1e6 - value / 10 + CASE WHEN event_id % 7 = 0 THEN 30 ELSE 0 END",
        "source": text("user_id"),
    },
)

EVENTS = View(
    "events",
    {
        "video_id": text("user_id * 4"),
        "source": "event_type",
        "raw_path": "concat('bronze/', CAST(event_id AS STRING), '/video.mp4')",
        "timestamp": "MICROS(ts) / 1e6",
        "event_id": "event_id",
        "props": "props",
    },
)


def _tasks(choice: str) -> dict[str, str]:
    ident = "CASE WHEN doc_id % 10 = 1 THEN doc_id - 1 ELSE doc_id END"
    path = (
        "CASE WHEN doc_id % 23 = 0 THEN 'short/clip.mp4' ELSE "
        f"concat('store://lake/bronze/', {text(ident)}, '/video.mp4') END"
    )
    marks = (
        "CASE doc_id % 11 WHEN 0 THEN ',\"annotations\":[]' "
        "WHEN 1 THEN ',\"annotations\":[{\"result\":[]}]' WHEN 3 THEN '' "
        "WHEN 2 THEN ',\"annotations\":[{\"result\":[{\"value\":{\"choices\":[\"MAYBE\"]}}]}]' ELSE "
        f"concat(',\"annotations\":[{{\"result\":[{{\"value\":{{\"choices\":[\"', {choice}, "
        "'\"]}}]}]') END"
    )
    task = (
        f"concat('{{\"id\":', {text('doc_id')}, ',\"data\":{{\"video\":\"', {path}, "
        f"'\"}}', {marks}, '}}')"
    )
    return {"ordinal": "doc_id", "task": task}


TASKS_A = View("labels", _tasks("CASE WHEN quality = 1 THEN 'SAFE' ELSE 'NOT SAFE' END"))
TASKS_B = View("labels", _tasks("CASE WHEN toxic = 0 THEN 'SAFE' ELSE 'NOT SAFE' END"))

LISTING = View(
    "documents",
    {
        "path": "CASE doc_id % 4 WHEN 0 THEN concat('bronze/', source, '/video.mp4') "
        "WHEN 1 THEN concat('silver/', CAST(doc_id AS STRING), '/video_embedding.npy') "
        "WHEN 2 THEN concat('gold/multimodal_', CAST(doc_id AS STRING), '.npz') "
        "ELSE concat('readme_', CAST(doc_id AS STRING), '.txt') END",
        "size": "n_chars",
    },
)

MEDIA_PATHS = View(
    "part",
    {
        "path": "concat(CASE p_partkey % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'val' WHEN 2 THEN 'test' "
        "ELSE 'extra' END, '/', CASE p_size % 4 WHEN 0 THEN 'Safe' WHEN 1 THEN 'Adult Content' "
        "WHEN 2 THEN 'Harmful Content' ELSE 'Suicide' END, '/', p_brand, '/', p_name, ' v.', "
        "CAST(p_partkey AS STRING), CASE p_partkey % 5 WHEN 0 THEN '.MP4' WHEN 1 THEN '.mov' "
        "WHEN 2 THEN '.txt' WHEN 3 THEN '.avi' ELSE '' END)",
    },
)

LABEL_TEXTS = View(
    "part",
    {
        "p_partkey": "p_partkey",
        "label": "CASE p_partkey % 9 WHEN 0 THEN ' Safe ' WHEN 1 THEN 'Adult Content' "
        "WHEN 2 THEN 'self-harm' WHEN 3 THEN 'SUICIDAL' WHEN 4 THEN 'unsafe' WHEN 5 THEN NULL "
        "WHEN 6 THEN '' WHEN 7 THEN 'adult' ELSE p_type END",
    },
)

CAPTIONS = View(
    "documents",
    {
        "doc_id": "doc_id",
        "text": "CASE doc_id % 6 WHEN 0 THEN concat('😂', text, ' #fun #a-b') "
        "WHEN 1 THEN concat(text, '😭☹️ 😱 ') WHEN 2 THEN '  ' ELSE text END",
        "tags": "concat('##', source, ' #', lang, ' ', lang)",
    },
)

EVALUATION = View(
    "labels",
    {"doc_id": "doc_id", "label": "quality", "pred": "1 - toxic"},
)
