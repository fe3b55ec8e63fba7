"""From documents to packed training sequences, in stages that each write a table.

Toxic documents go, one of each group of near duplicates stays, byte strings that occur again are
cut, secrets are replaced, and what is left is packed into sequences of token ids.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from clipsift.llm import neardup, packing, secrets, suffixes, toxicity
from clipsift.llm.common import documents, tokenizer_path
from clipsift.llm.queries import WORD_MODEL
from clipsift.session import durable
from clipsift.tables import load

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# No SQL can say what a trained machine rejects.
ORACLE_SQL = None

# Rows that are handed over at once, at most. Rows hold whole texts, and several batches of them are in
# memory in each task, in the JVM and in Python.
WIDE_ROWS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.parquet.columnarReaderBatchSize": 1024,
}


def in_small_batches(stage: Stage) -> Stage:
    """The stage in a session that hands over few rows at once, also when its result is written later."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, most in WIDE_ROWS.items():
            now = int(spark.conf.get(key))
            if not 0 < now <= most:
                spark.conf.set(key, str(most))
        return stage(spark, docs, sf_dir)

    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine, trained on the labelled ones among them, lets pass."""
    return toxicity.without_toxic(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, on shingles of five words."""
    return neardup.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur elsewhere too."""
    return suffixes.without_repeats(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by a mark."""
    found = secrets.redact(docs, secrets.train(secrets.made_findings(spark)))
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of token ids."""
    return packing.pack_documents(docs, tokenizer_path(WORD_MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", in_small_batches(drop_toxic)),
    ("near_duplicates", in_small_batches(drop_near_duplicates)),
    ("suffix_dedup", in_small_batches(cut_repeats)),
    ("secret_scan", in_small_batches(hide_secrets)),
    ("packing", in_small_batches(pack)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
