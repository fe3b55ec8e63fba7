"""Readers and writers. Inputs are whole tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipsift import schemas
from clipsift.operators import aggregates
from clipsift.plans import standins as V
from clipsift.plans.registry import query
from clipsift.session import scratch_path
from clipsift.sources import annotations, listings, readers, writers
from clipsift.sources.manifest import DocumentTable
from clipsift.tables import load


@query(
    "SELECT CAST(doc_id AS STRING) AS video_id, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' "
    "ELSE 'test' END AS split, CASE WHEN doc_id % 5 <> 0 THEN lang END AS label_raw, source AS label, "
    "CAST(NULL AS STRING) AS original_filename, 'upload' AS source FROM documents"
)
def q_read_labeled_json(spark, sf):
    root = scratch_path(spark, "labeled")
    load(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.expr("CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END").alias("split"),
        F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("label_raw"),
        F.col("source").alias("label"),
        F.lit("upload").alias("source"),
        "n_chars",
        F.col("lang").alias("folder"),
    ).write.partitionBy("folder").json(root)
    return readers.read_labeled_bronze(spark, f"{root}/*/*.json", multiline=False)


def crawled_events(spark, sf):
    """Events as crawled posts with a stats map and tags."""
    return load(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("video_id"),
        F.concat(F.lit("https://site.example/@u/video/"), F.col("event_id")).alias("url"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("timestamp"),
        F.col("event_type").alias("source"),
        F.col("props").alias("description"),
        F.create_map(
            F.lit("likes"),
            F.when(F.col("event_id") % 4 == 0, F.concat(F.col("user_id"), F.lit("K"))).otherwise(
                F.col("user_id").cast("string")
            ),
            F.lit("comments"),
            F.get_json_object("props", "$.k"),
        ).alias("stats"),
        F.array(F.lit("#a"), F.col("event_type")).alias("tags"),
    )


_crawled = (
    "SELECT CAST(event_id AS STRING) AS video_id, "
    "concat('https://site.example/@u/video/', event_id) AS url, epoch_us(ts) / 1e6 AS timestamp, "
    "event_type AS source, props AS description, "
    "CASE WHEN event_id % 4 = 0 THEN concat(user_id, 'K') ELSE CAST(user_id AS STRING) END AS likes, "
    "json_extract_string(props, '$.k') AS comments FROM events"
)


@query(f"SELECT c.*, c.source AS tag FROM ({_crawled}) c")
def q_read_crawled_json(spark, sf):
    root = scratch_path(spark, "crawled")
    df = crawled_events(spark, sf)
    df.withColumn("folder", F.col("source")).write.partitionBy("folder").json(root)
    return readers.read_crawled_bronze(spark, f"{root}/*/*.json", multiline=False).select(
        "video_id", "url", "timestamp", "source", "description",
        F.col("stats")["likes"].alias("likes"),
        F.col("stats")["comments"].alias("comments"),
        F.get("tags", F.lit(1)).alias("tag"),
    )


@query("SELECT concat('v', doc_id) AS folder, doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents")
def q_read_keyed_metadata(spark, sf):
    """Every document as an indented file in a folder of its own; every tenth has a broken neighbour."""
    root = scratch_path(spark, "keyed")
    good = F.to_json(F.struct("doc_id", "lang", "n_chars", "text"), {"pretty": "true"})
    both = F.when(
        F.col("doc_id") % 10 == 0,
        F.array(F.struct(F.concat(F.lit("v"), "doc_id").alias("id"), good.alias("value")),
                F.struct(F.concat(F.lit("x"), "doc_id").alias("id"), F.lit('{"doc_id": ').alias("value"))),
    ).otherwise(F.array(F.struct(F.concat(F.lit("v"), "doc_id").alias("id"), good.alias("value"))))
    writers.write_keyed_files(load(spark, sf, "documents").select(F.explode(both).alias("f")).select("f.*"), root)
    rows = readers.read_keyed_metadata(
        spark, root, "doc_id long, lang string, n_chars long, text string", "folder",
        r"id=([^/]+)/[^/]+$", files="*.txt",
    )
    return rows.select("folder", "doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query(
    "SELECT concat('v', doc_id) AS folder, doc_id, CASE WHEN doc_id % 10 = 0 THEN concat(lang, ' again') ELSE lang END AS lang, "
    "md5(text) AS text_md5, (SELECT count(*) FROM documents WHERE doc_id % 10 = 0) AS opened FROM documents "
    "WHERE doc_id % 10 <> 3"
)
def q_refresh_documents(spark, sf):
    """A file per document, of which a tenth changes and a tenth is emptied; the second run opens these alone."""
    root = scratch_path(spark, "listed")
    docs = load(spark, sf, "documents").withColumn("id", F.concat(F.lit("v"), "doc_id"))

    def write(rows, value):
        writers.write_keyed_files(rows.select("id", value.alias("value")), root)

    table = DocumentTable(
        spark, scratch_path(spark, "manifest"), "doc_id long, lang string, text string", "folder",
        r"id=([^/]+)/[^/]+$", files="*.txt",
    )
    write(docs, F.to_json(F.struct("doc_id", "lang", "text")))
    table.refresh(root)
    write(docs.filter("doc_id % 10 = 0"), F.to_json(F.struct("doc_id", F.concat("lang", F.lit(" again")).alias("lang"), "text")))
    write(docs.filter("doc_id % 10 = 3"), F.lit(""))
    opened = table.refresh(root)["opened"] - docs.filter("doc_id % 10 = 3").count()
    return table.read().select("folder", "doc_id", "lang", F.md5("text").alias("text_md5"), F.lit(opened).cast("long").alias("opened"))


@query(
    "SELECT CAST(event_id AS STRING) AS video_id, event_type AS label, value AS processing_time_ms, "
    "CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' ELSE ts END AS ingested_at FROM events"
)
def q_read_jsonl_tolerant(spark, sf):
    root = scratch_path(spark, "lines")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    broken = F.when(F.col("event_id") % 10 == 0, F.lit("soon")).otherwise(F.lit(None))
    record = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("video_id"),
            F.col("event_type").alias("label"),
            F.col("value").alias("processing_time_ms"),
            F.when(F.col("event_id") % 5 == 0, broken).otherwise(stamp).alias("timestamp"),
        )
    )
    lines = F.explode(F.array(record, F.lit("   "), F.lit('{"video_id": "x", ')))
    load(spark, sf, "events").select(lines.alias("value")).write.text(root)
    rows = readers.read_jsonl_tolerant(
        spark, root, schemas.PREDICTION_LINE, default_ts="2000-01-01 00:00:00"
    )
    return rows.select(
        "video_id", "label", "processing_time_ms",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
    )


def choice_sql(tasks: str) -> str:
    return (
        "(SELECT ordinal, json_extract_string(task, '$.data.video') AS path, "
        "json_extract_string(task, '$.annotations[0].result[0].value.choices[0]') AS choice "
        f"FROM {tasks})"
    )


def by_id_sql(tasks: str, safe: int = 0, unsafe: int = 2) -> str:
    return (
        "(SELECT split_part(path, '/', -2) AS video_id, "
        f"arg_max(CASE choice WHEN 'SAFE' THEN {safe} ELSE {unsafe} END, ordinal) AS label "
        f"FROM {choice_sql(tasks)} WHERE len(string_split(path, '/')) >= 5 "
        "AND choice IN ('SAFE', 'NOT SAFE') GROUP BY 1)"
    )


def by_path_sql(tasks: str) -> str:
    return (
        f"(SELECT path, arg_max(choice, ordinal) AS choice FROM {choice_sql(tasks)} "
        "WHERE choice IS NOT NULL GROUP BY path)"
    )


@query(f"SELECT * FROM {by_id_sql(V.TASKS_A.sql)}")
def q_parse_annotations(spark, sf):
    return annotations.parse_annotations(V.TASKS_A.df(spark, sf), "task", "ordinal")


@query(f"SELECT * FROM {by_path_sql(V.TASKS_A.sql)}")
def q_parse_annotations_by_path(spark, sf):
    return annotations.parse_annotations_by_path(V.TASKS_A.df(spark, sf), "task", "ordinal")


@query(
    "SELECT count(*) AS n_objects, "
    "count(DISTINCT CASE WHEN path LIKE 'bronze/%' THEN split_part(path, '/', 2) END) AS n_bronze_ids, "
    "count(*) FILTER (WHERE path LIKE 'silver/%') AS n_silver, "
    "count(*) FILTER (WHERE path LIKE 'gold/%') AS n_gold, "
    "count(*) FILTER (WHERE path LIKE 'gold/%.npz') AS n_gold_sets, "
    "ROUND(sum(CASE WHEN path LIKE 'gold/%.npz' THEN size ELSE 0 END) / 1048576.0::DOUBLE, 6) AS gold_mb "
    f"FROM {V.LISTING.sql}"
)
def q_object_listing_stats(spark, sf):
    stats = aggregates.object_listing_stats(V.LISTING.df(spark, sf))
    return stats.withColumn("gold_mb", F.round("gold_mb", 6))


@query(
    "SELECT DISTINCT split_part(path, '/', 2) AS name FROM "
    f"{V.LISTING.sql} WHERE path LIKE 'silver/%/%' ORDER BY name"
)
def q_list_subdirs(spark, sf):
    return aggregates.list_subdirs(V.LISTING.df(spark, sf), "silver")


@query("SELECT DISTINCT CAST(user_id AS STRING) AS video_id FROM events")
def q_read_id_list(spark, sf):
    root = scratch_path(spark, "ids")
    user = F.col("user_id").cast("string")
    lines = F.explode(F.array(user, F.lit("  "), F.concat(F.lit(" "), user, F.lit(" "))))
    load(spark, sf, "events").select(lines.alias("value")).write.text(root)
    return readers.read_id_list(spark, root)


_ext = r"lower(regexp_extract(path, '(\.[^./]*)$', 1))"
MANIFEST_SQL = (
    "SELECT concat(split_part(path, '/', 1), '_', lower(replace(split_part(path, '/', 2), ' ', '_')), '_', "
    r"replace(regexp_replace(split_part(path, '/', -1), '\.[^.]*$', ''), ' ', '_')) AS video_id, "
    "split_part(path, '/', 1) AS split, split_part(path, '/', 2) AS label, path AS original_path "
    f"FROM {V.MEDIA_PATHS.sql} WHERE {_ext} IN ('.mp4', '.mov', '.avi') "
    "AND split_part(path, '/', 1) IN ('train', 'val', 'test')"
)


@query(MANIFEST_SQL)
def q_directory_manifest(spark, sf):
    root = scratch_path(spark, "manifest")
    writers.write_manifest(listings.directory_manifest(V.MEDIA_PATHS.df(spark, sf)), root)
    fields = "video_id string, split string, label string, original_path string"
    return spark.read.schema(fields).json(root)


def gold_rows(spark, sf):
    """Embeddings joined to labels as gold rows."""
    labels = load(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), "quality")
    return load(spark, sf, "embeddings").join(labels, "vec_id", "left").select(
        F.col("vec_id").cast("string").alias("video_id"),
        F.slice("embedding", 1, 32).alias("video_emb"),
        F.slice("embedding", 33, 32).alias("audio_emb"),
        F.slice("embedding", 17, 32).alias("text_emb"),
        F.slice("embedding", 1, 22).alias("metadata_numeric"),
        F.coalesce("quality", F.lit(-1)).alias("label"),
    )


_gold = (
    "FROM embeddings LEFT JOIN labels ON vec_id = doc_id"
)


@query(
    "SELECT CAST(vec_id AS STRING) AS video_id, coalesce(quality, -1)::BIGINT AS label, "
    "ROUND(embedding[1]::DOUBLE, 6) AS v0, ROUND(embedding[33]::DOUBLE, 6) AS a0, "
    f"ROUND(embedding[17]::DOUBLE, 6) AS t0, CAST(22 AS INTEGER) AS n_meta {_gold}"
)
def q_write_gold(spark, sf):
    root = scratch_path(spark, "gold")
    writers.write_gold(gold_rows(spark, sf), root)
    first = F.lit(0)
    return readers.read_gold(spark, root).select(
        "video_id", "label",
        F.round(F.get("video_emb", first).cast("double"), 6).alias("v0"),
        F.round(F.get("audio_emb", first).cast("double"), 6).alias("a0"),
        F.round(F.get("text_emb", first).cast("double"), 6).alias("t0"),
        F.size("metadata_numeric").alias("n_meta"),
    )


@query(f"SELECT CAST(vec_id AS STRING) AS video_id, coalesce(quality, -1)::BIGINT AS label {_gold}")
def q_load_gold(spark, sf):
    root = scratch_path(spark, "gold")
    writers.write_gold(gold_rows(spark, sf), root)
    return readers.read_gold(spark, root, ["video_id", "label"])


@query("SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents")
def q_sink_overwrite(spark, sf):
    root = scratch_path(spark, "layer")
    docs = load(spark, sf, "documents")
    for _ in range(2):
        writers.write_layer(docs, root)
    return readers.read_layer(spark, root).select(
        "doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5")
    )


@query("SELECT source, 2 * count(*) AS n, CAST(2 * sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def q_sink_append_partitioned(spark, sf):
    root = scratch_path(spark, "layer")
    for _ in range(2):
        writers.write_layer(load(spark, sf, "documents"), root, "append", ["source"])
    return readers.read_layer(spark, root).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )


@query("SELECT source, 2 * count(*) AS n, CAST(2 * sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY source")
def q_sink_append_runs(spark, sf):
    """One run twice and another once; the repeated one counts once."""
    root = scratch_path(spark, "runs")
    for run in ("monday", "monday", "tuesday 2/3"):
        writers.append_run(load(spark, sf, "documents"), root, run, ["source"])
    return writers.read_runs(spark, root).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )


@query(
    "SELECT video_id, label, processing_time FROM (SELECT * FROM "
    f"{V.PREDICTIONS.sql} UNION ALL SELECT * FROM {V.PREDICTIONS.sql})"
)
def q_sink_jsonl(spark, sf):
    root = scratch_path(spark, "jsonl")
    for _ in range(2):
        writers.append_jsonl(V.PREDICTIONS.df(spark, sf), root)
    return spark.read.schema("video_id string, label string, processing_time double").json(root)


@query(
    "SELECT m.model, label, CASE WHEN m.model = 'base' THEN pred ELSE label END AS pred, "
    f"CAST(pred AS DOUBLE) AS prob FROM {V.EVALUATION.sql}, (SELECT unnest(['base', 'tuned']) AS model) m"
)
def q_sink_eval_results(spark, sf):
    root = scratch_path(spark, "results")
    rows = V.EVALUATION.df(spark, sf).select(
        "label", "pred", F.col("pred").cast("double").alias("prob"),
        F.explode(F.array(F.lit("base"), F.lit("tuned"))).alias("model"),
    ).withColumn("pred", F.when(F.col("model") == "base", F.col("pred")).otherwise(F.col("label")))
    writers.write_eval_results(rows, root)
    return spark.read.schema(schemas.EVAL_RESULT).parquet(root).select("model", "label", "pred", "prob")
