"""Tables made from file listings."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsift.functions import ids
from clipsift.session import durable, setting
from clipsift.sources.files import Folder

# Splits and media extensions of a labelled folder tree.
SPLITS = ("train", "val", "test")
MEDIA_EXTENSIONS = (".mp4", ".mov", ".avi")


LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 4  # listing tasks a core
# What a file counts beside its bytes when files are dealt to tasks; by default 4 MB, so 32 small files fill a task.
OPEN_COST_KEY = "spark.sql.files.openCostInBytes"
OPEN_COST = 128 << 10

# What a task opens at most, or nearly so; fewer files than that are dealt to all cores.
FILES_A_TASK, BYTES_A_TASK, FEW_FILES = 10_000, 128 << 20, 100
# What a task holds of listed names, and of file contents, before it hands them on.
NAMES_HELD, BYTES_HELD = 10_000, 8 << 20
LISTED = "path string, size long, stamp long"  # without a size: a folder to look into; stamp: in milliseconds


def _plain(path: str) -> str | None:
    """A path whose escaped pattern marks stand for themselves; None if it is a pattern."""
    return None if re.search(r"(?<!\\)[*?\[\]{}]", path) else re.sub(r"\\(.)", r"\1", path)


def _on_disk(spark: SparkSession, paths: str | list[str]) -> list[str] | None:
    """The folders and files as paths of the operating system; None for patterns, other stores and what is not there."""
    if isinstance(paths, str):
        plain = _plain(paths)
        folder = Folder(spark, plain) if plain else None
        place = folder.on_disk() if folder else None
        return [place] if place is not None and folder.exists() else None
    names = [_plain(p) for p in paths]
    return [re.sub("^file:/+", "/", n) for n in names] if all(n and n.startswith("file:/") for n in names) else None


def _look(named: str, whole: bool):
    """Task that replaces each folder by what is in it, or by the files anywhere below; keeps files.

    Names that Spark's readers pass over, as hidden ones or copies under way, are left out, and so are empty files.
    """

    def hidden(name: str) -> bool:
        odd = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
        return odd and not name.startswith(("_common_metadata", "_metadata"))

    def data(name: str) -> bool:
        return not (name.startswith("_") and "=" not in name or name.startswith("."))

    def entries(place: str) -> Iterator[tuple[str, int | None, int | None]]:
        with os.scandir(place) as found:
            for x in found:
                if hidden(x.name):
                    continue
                try:
                    if x.is_dir():
                        if whole:
                            yield from entries(x.path)
                        else:
                            yield x.path, None, None
                    elif data(x.name) and wanted(x.name):
                        about = x.stat()
                        if about.st_size:
                            yield x.path, about.st_size, about.st_mtime_ns // 1_000_000
                except FileNotFoundError:  # gone since the folder was opened
                    continue

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int | None, int | None]]:
        for batch in batches:
            for path, size, stamp in zip(*[c.to_pylist() for c in batch.columns]):
                if size is not None:
                    yield path, size, stamp
                elif os.path.isdir(path):
                    yield from entries(path)
                elif wanted(os.path.basename(path)):  # a file that was named; an error if it is gone
                    about = os.stat(path)
                    if about.st_size:
                        yield path, about.st_size, about.st_mtime_ns // 1_000_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for row in files(batches):
            held.append(row)
            if len(held) >= NAMES_HELD:
                yield pack(held)
                held = []
        yield pack(held)

    def pack(held: list) -> pa.RecordBatch:
        columns = list(zip(*held)) or [(), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "size", "stamp"])

    wanted = re.compile(named, re.DOTALL).fullmatch
    return run


def _open():
    """Task that adds their contents to the named files, a few megabytes at once."""
    names = ["path", "size", "stamp", "content"]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())

    def pack(held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as file:
                    about = os.fstat(file.fileno())
                    content = file.read()
                held.append((path, about.st_size, about.st_mtime_ns // 1_000_000, content))
                n += len(content)
                if n >= BYTES_HELD or len(held) >= NAMES_HELD:
                    yield pack(held)
                    held, n = [], 0
        if held:
            yield pack(held)

    return run


def _walked(spark: SparkSession, places: list[str], files: str) -> DataFrame:
    """``LISTED`` of the ``files`` at and below ``places``, found by tasks; the driver holds no names.

    The first two levels of a folder are dealt to all tasks, so it does not matter which of them is wide.
    """
    named = spark._jvm.org.apache.hadoop.fs.GlobPattern(files).compiled().pattern()
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    found = spark.createDataFrame([(p, None, None) for p in places], LISTED)
    if len(places) == 1:
        for _ in range(2):
            found = found.mapInArrow(_look(named, False), LISTED).repartition(tasks)
    return found.mapInArrow(_look(named, True), LISTED)


def _uri(path: str = "path"):
    return F.concat(F.lit("file:"), path).alias("path")


def _dealt(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """Listed files in as many partitions as opening them is worth tasks."""
    listed = durable(listed, "listed")
    n, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    few = min(spark.sparkContext.defaultParallelism, -(-n // FEW_FILES))
    return listed.repartition(max(1, -(-n // FILES_A_TASK), -(-size // BYTES_A_TASK), few))


def binary_files(spark: SparkSession, paths: str | list[str], files: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) of the ``files`` below ``paths``.

    On disk tasks find and open the files, so that the driver's memory does not grow with their number; in
    other stores Spark's reader does, which holds all their names on the driver.
    """
    places = _on_disk(spark, paths)
    if places is not None:
        walked = _walked(spark, places, files)
        opened = (_dealt(spark, walked) if isinstance(paths, str) else walked).mapInArrow(_open(), f"{LISTED}, content binary")
        return opened.select(_uri(), F.timestamp_millis("stamp").alias("modificationTime"), F.col("size").alias("length"), "content")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", files)
    # By default each folder is listed by a task of its own.
    with setting(spark, LISTING_KEY, str(LISTING_TASKS * spark.sparkContext.defaultParallelism)):
        return reader.load(paths)


def list_files(spark: SparkSession, root: str, files: str = "*") -> DataFrame:
    """(path, size, modified) of every file below ``root``; file contents are not read."""
    places = _on_disk(spark, root)
    if places is not None:
        return _walked(spark, places, files).select(_uri(), "size", F.timestamp_millis("stamp").alias("modified"))
    return binary_files(spark, root, files).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def directory_manifest(
    paths: DataFrame, col: str = "path", exts: Sequence[str] = MEDIA_EXTENSIONS
) -> DataFrame:
    """``split/label/.../file`` paths -> (video_id, split, label, original_path)."""
    p = F.col(col)
    parts = F.split(p, "/")
    split, label = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    return paths.filter(
        split.isin(*SPLITS) & (F.size(parts) >= 3) & ids.extension(p).isin(*exts)
    ).select(
        ids.composite_id(split, label, ids.stem(p)).alias("video_id"),
        split.alias("split"),
        label.alias("label"),
        p.alias("original_path"),
    )
