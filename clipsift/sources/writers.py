"""Writers; every rewrite is idempotent, appends are marked as such."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clipsift import schemas
from clipsift.sources.files import Folder


def write_layer(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Parquet table; ``append`` adds rows again on a rerun, ``overwrite`` replaces the table as a whole."""
    if mode == "overwrite":
        replace_table(df, path, partition_by=partition_by)
        return
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_table(
    df: DataFrame, path: str, may_be_empty: bool = True, partition_by: Sequence[str] = (), **counts: Column
) -> dict[str, int]:
    """Write ``df`` beside ``path`` and put it in its place; the old table stays until then.

    ``df`` may read ``path`` itself. One execution also gives the row count ``n`` and ``counts``.
    A failed write, an empty result where none may be, and a count ``changed`` of 0 leave the old
    table as it is.
    """
    spark, seen = df.sparkSession, Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in counts.items()])
    if "changed" in df.columns and "changed" in counts:
        observed = observed.drop("changed")
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer = observed.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(fresh)
        found = dict(seen.get)
        if not found["n"] and not may_be_empty:
            raise ValueError("no rows to save")
        there = files.exists(place(path))
        if there and found.get("changed") == 0:
            return found
        if there and not files.rename(place(path), place(old)):
            raise OSError(f"cannot move {path}")
        if not files.rename(place(fresh), place(path)):
            if there:
                files.rename(place(old), place(path))
            raise OSError(f"cannot move {fresh}")
        files.delete(place(old), True)
        return found
    finally:
        files.delete(place(fresh), True)


RUNS = "_runs"  # markers of finished runs, hidden from plain readers


def append_run(df: DataFrame, path: str, run_id: str, partition_by: Sequence[str] = ()) -> None:
    """Add the rows of a run, or replace what the same run has added before.

    Rows are written to a folder of this attempt, then the run's marker is pointed at it: readers see
    the run's old rows or its new ones, and nothing of an attempt that failed.
    """
    folder, run = Folder(df.sparkSession, path), quote(str(run_id), safe="")
    attempt = f"attempt={uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder.root}/run={run}/{attempt}")
    folder.replace(f"{RUNS}/{run}", f"run={run}/{attempt}")
    for name in folder.names(f"run={run}"):
        if name != attempt:
            folder.delete(f"run={run}/{name}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all finished runs of a table that ``append_run`` has written."""
    folder = Folder(spark, path)
    if not folder.names(RUNS):
        raise LookupError(f"{path} has no finished run")
    markers = spark.read.text(f"{folder.root}/{RUNS}", wholetext=True).collect()  # a line a run
    rows = spark.read.option("basePath", folder.root).parquet(*sorted(f"{folder.root}/{r[0]}" for r in markers))
    return rows.drop("run", "attempt")


def gold_rows(df: DataFrame, *more: str) -> DataFrame:
    """The columns of a gold table in its fixed types, and ``more``."""
    target = df.sparkSession.createDataFrame([], schemas.GOLD_ROW).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target], *more)


def write_gold(df: DataFrame, path: str, may_be_empty: bool = False) -> int:
    """Gold rows in the fixed schema; refuses an empty set unless told otherwise. Returns the count."""
    return replace_table(gold_rows(df), path, may_be_empty)["n"]


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_eval_results(df: DataFrame, path: str) -> None:
    """Predictions, labels and probabilities, one partition per model."""
    df.select("model", "label", "pred", "prob").write.mode("overwrite").partitionBy(
        "model"
    ).parquet(path)


def write_manifest(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


# The folder name that table writers give rows without a key.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def write_keyed_files(rows: DataFrame, root: str, key: str = "id", value: str = "value") -> None:
    """One text file a key, in a folder ``key=…`` of its own below ``root``; a value a line.

    What a key's folder held is replaced, other folders stay. On disk the tasks write the files
    themselves, as a table writer starts several processes a file there to set its permissions;
    other stores get them from the table writer. Both give the same folders.
    """
    folder = Folder(rows.sparkSession, root)
    place, name, dealt = folder.on_disk(), f"part-{uuid.uuid4().hex}.txt", rows.select(key, value).repartition(key)
    if place is None:
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).text(root)
        return
    folder.make()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, n, hidden = None, None, 0, f"_{uuid.uuid4().hex}"

        def close() -> None:
            out.close()
            for old in os.listdir(at):
                if old not in (name, hidden):
                    os.remove(f"{at}/{old}")
            os.replace(f"{at}/{hidden}", f"{at}/{name}")

        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = f"{place}/{key}={quote(ident, safe=' ') if ident else NO_KEY}"
                if own != at:
                    if out is not None:
                        close()
                    at = own
                    os.makedirs(at, exist_ok=True)
                    out, n = open(f"{at}/{hidden}", "wb"), n + 1
                out.write((text or "").encode() + b"\n")
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    strings = dealt.select(F.col(key).cast("string"), F.col(value).cast("string"))
    strings.sortWithinPartitions(key).mapInArrow(write, "n long").agg(F.sum("n")).collect()
