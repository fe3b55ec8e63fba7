"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Folders that scratch_path has named in this process.
_MADE: list[str] = []

# Methods above 8000 bytecodes are not compiled by the JVM's JIT; wide projections such as the
# feature vector run faster when Spark splits them instead of fusing them into one method.
DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app: str = "clipsift", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the defaults the library relies on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="clipsift-")
    spark.conf.set(CHECKPOINT_KEY, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; ``clear_scratch`` removes what is there later."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as a plan is made or run."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables made so far; call it when no frame that reads them is left."""
    place, conf, gone = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration(), 0
    while _MADE:
        path = place(_MADE.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Every consumer sees the same rows, also when an executor is lost and tasks run again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
