"""Event source, parsing, emission, scoring and the prediction sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipsift import schemas
from clipsift.functions.labels import SERVING_NAMES
from clipsift.functions.vectors import prob_map, softmax, top_class
from clipsift.sources.featurestore import FeatureStore, SeenIds


def event_source(spark: SparkSession, kind: str = "files", **options) -> DataFrame:
    """Stream with one text column ``value``: JSON-line files or a topic from its beginning."""
    if kind == "files":
        reader = spark.readStream.format("text")
        if "max_files" in options:
            reader = reader.option("maxFilesPerTrigger", options["max_files"])
        return reader.load(options["path"])
    if kind == "kafka":
        reader = spark.readStream.format("kafka").option("startingOffsets", "earliest")
        reader = reader.option("kafka.bootstrap.servers", options["servers"])
        return reader.option("subscribe", options["topic"]).load().select(
            F.col("value").cast("string").alias("value")
        )
    raise ValueError(f"unknown event source {kind!r}")


def parse_events(df: DataFrame) -> DataFrame:
    """JSON text -> event columns; malformed text gives an all-null row, extra fields vanish."""
    return df.select(F.from_json("value", schemas.INGESTION_EVENT).alias("data")).select("data.*")


def event_json(
    video_id: Column, source: Column, raw_path: Column, timestamp: Column, metadata: Column
) -> Column:
    return F.to_json(
        F.struct(
            video_id.alias("video_id"),
            source.alias("source"),
            raw_path.alias("raw_path"),
            timestamp.alias("timestamp"),
            metadata.alias("metadata"),
        )
    )


def emit_events(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a frame with a ``value`` column of event JSON as text lines."""
    df.select("value").write.mode(mode).text(path)


def linear_scorer(emb: str = "embedding", names=SERVING_NAMES) -> Callable[[DataFrame], DataFrame]:
    """Scorer reading the logits off the first components of a vector."""
    def score(df: DataFrame) -> DataFrame:
        logits = F.slice(F.col(emb), 1, len(names))
        scored = df.withColumn("_p", softmax(logits))
        return scored.select(
            "video_id",
            top_class(F.col("_p"), names).alias("top"),
            prob_map(F.col("_p"), names).alias("probabilities"),
        ).select(
            "video_id",
            F.col("top.label").alias("label"),
            F.col("top.label_id").alias("label_id"),
            F.col("top.confidence").alias("confidence"),
            "probabilities",
        )

    return score


def score_events(
    events: DataFrame, features: DataFrame | FeatureStore, scorer: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Events with their prediction; events without features keep nulls.

    Each wanted item is scored once however many events name it; the small predictions are
    joined back to the events, where adaptive execution splits a hot item. Of a feature store only
    the buckets of the wanted items are read.
    """
    wanted = events.select("video_id").distinct()
    if isinstance(features, FeatureStore):
        found = features.lookup(wanted)
        if found is None:
            raise LookupError(f"nothing is stored in {features.root}")
    else:
        found = features.join(wanted, "video_id", "left_semi")
    return events.join(scorer(found), "video_id", "left")


def prediction_sink(
    path: str, features: DataFrame | FeatureStore, scorer: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of scored events, partitioned by batch and outcome.

    The outcome ``failed`` is the dead-letter side. Each batch is scored and written once and
    overwrites its own folder, so a batch that runs again leaves no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by the guard, for its ids and for the join
        try:
            if batch.isEmpty():
                return
            scored = score_events(batch, features, scorer).withColumns(
                {
                    "ingested_at": F.current_timestamp(),
                    "outcome": F.when(F.col("label").isNotNull(), "ok").otherwise("failed"),
                }
            )
            scored.write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def read_predictions(spark: SparkSession, path: str, outcome: str = "ok") -> DataFrame:
    """Rows of one outcome from the prediction table; only its folders are read."""
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.filter(F.col("outcome") == outcome).drop("outcome", "batch_id")


def table_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of plain rows; each batch overwrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def run_available(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> StreamingQuery:
    """Process everything that is there and stop."""
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()
    return query


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that is there into a parquet folder and stop."""
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def new_ids_sink(path: str, seen: SeenIds) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of the ids that no earlier batch had, each once, and their recorder.

    A batch that runs again finds and writes the same ids to its own folder. The stream keeps no state.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        seen.admit(batch, batch_id).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def new_items(stream: DataFrame, done: DataFrame, key: str = "video_id") -> DataFrame:
    """Ids not in ``done``, each once over the whole stream.

    The ids seen are kept as state, which grows with them; ``new_ids_sink`` keeps them in a table
    with a filter for each bucket instead.
    """
    return stream.join(done.select(key), key, "left_anti").dropDuplicates([key])
