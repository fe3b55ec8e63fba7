"""Column-level reshaping and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipsift.functions import ids, labels
from clipsift.operators import filters, projections
from clipsift.operators.sets import union_sources
from clipsift.plans import standins as V
from clipsift.plans.queries.storage import crawled_events
from clipsift.plans.registry import query
from clipsift.tables import load

ROOT = "store://lake/bronze/"


@query(
    "SELECT doc_id, CASE WHEN doc_id % 9 <> 0 THEN concat('store://lake/bronze/', doc_id, '/video.mp4') END "
    "AS bronze_video_path FROM documents"
)
def q_bronze_paths(spark, sf):
    some = F.when(F.col("doc_id") % 9 != 0, F.col("doc_id"))
    df = load(spark, sf, "documents").select("doc_id", some.alias("video_id"))
    out = projections.with_media_path(projections.with_audit(df), ROOT)
    return out.select("doc_id", "bronze_video_path")


@query(
    "SELECT doc_id, concat('store://lake/silver/', doc_id, '/audio_embedding.npy') AS audio_feat_path, "
    "concat('store://lake/silver/', doc_id, '/video_embedding.npy') AS video_feat_path, "
    "concat('store://lake/silver/', doc_id, '/metadata_features.npz') AS text_feat_path FROM documents"
)
def q_feature_paths(spark, sf):
    df = load(spark, sf, "documents").select("doc_id")
    return projections.with_feature_paths(df, "store://lake/silver/", key="doc_id")


@query(
    "SELECT CAST(event_id AS STRING) AS video_id, CASE WHEN event_id % 4 <> 0 THEN user_id END AS likes, "
    "json_extract_string(props, '$.k') AS comments_count, event_type AS shares FROM events"
)
def q_extract_stats(spark, sf):
    df = crawled_events(spark, sf).withColumn("shares", F.col("source"))
    return projections.extract_stats(df).select("video_id", "likes", "comments_count", "shares")


@query(
    "SELECT CAST(event_id AS STRING) AS video_id, event_type AS label, CAST(event_id % 2 AS INTEGER) AS label_id, "
    "value / 1000 AS confidence, value AS processing_time, CAST(user_id AS STRING) AS source, "
    "concat('bronze/', event_id) AS raw_path, epoch_us(ts) / 1e6 AS timestamp, value / 1000 AS p_safe FROM events"
)
def q_flatten_prediction(spark, sf):
    e = load(spark, sf, "events")
    confidence = F.col("value") / 1000
    response = F.struct(
        F.col("event_id").cast("string").alias("video_id"),
        F.col("event_type").alias("label_name"),
        (F.col("event_id") % 2).cast("int").alias("label_id"),
        confidence.alias("confidence"),
        F.create_map(F.lit("Safe"), confidence).alias("probabilities"),
        F.col("value").alias("processing_time_ms"),
    )
    rows = e.select(
        response.alias("response"),
        F.col("user_id").cast("string").alias("source"),
        F.concat(F.lit("bronze/"), F.col("event_id")).alias("raw_path"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("timestamp"),
    )
    flat = projections.flatten_prediction(rows)
    return flat.withColumn("p_safe", F.col("probabilities")["Safe"]).drop("probabilities")


@query(
    "SELECT event_id AS video_id, event_type AS label, ts AS ingested_at, "
    "concat('http://console.example/bronze/', event_id, '/video.mp4') AS link FROM events"
)
def q_link_column(spark, sf):
    e = load(spark, sf, "events").select(
        F.col("event_id").alias("video_id"), F.col("event_type").alias("label"), F.col("ts").alias("ingested_at")
    )
    return projections.with_link(e, "http://console.example/bronze/{}/video.mp4")


@query(
    "SELECT page_id, split_part(split_part(url, 'example.com/', -1), '?', 1) AS ident, "
    "split_part(split_part(url, '/', -1), '?', 1) AS last FROM pages"
)
def q_id_from_url(spark, sf):
    url = F.col("url")
    return load(spark, sf, "pages").select(
        "page_id", ids.id_from_url(url, "example.com/").alias("ident"), ids.id_from_url(url, "/").alias("last")
    )


@query(
    "SELECT DISTINCT split_part(CASE WHEN starts_with(h, 'http') THEN h ELSE "
    "concat('https://site.example', h) END, '?', 1) AS url FROM (SELECT "
    "unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS h FROM pages) WHERE contains(h, '/t')"
)
def q_canonical_urls(spark, sf):
    hrefs = F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1))
    links = load(spark, sf, "pages").select(hrefs.alias("href"))
    return projections.canonical_urls(links, "href", "https://site.example", "/t")


_paths = {
    "path": "CASE doc_id % 4 WHEN 0 THEN concat('store://lake/bronze/', source, '_', doc_id, '/video.mp4') "
    "WHEN 1 THEN concat('bronze/', doc_id, '/metadata.json') WHEN 2 THEN concat('silver/', source) "
    "ELSE concat('store://lake/gold/', lang, '/', doc_id, '.npz') END",
    "doc_id": "doc_id",
}
PATHS = V.View("documents", _paths)


@query(
    "SELECT doc_id, CASE WHEN len(string_split(path, '/')) >= 5 THEN split_part(path, '/', -2) END AS by_segment, "
    "CASE WHEN contains(path, 'bronze/') THEN split_part(split_part(path, 'bronze/', 2), '/', 1) END AS by_layer "
    f"FROM {PATHS.sql}"
)
def q_id_from_path(spark, sf):
    path = F.col("path")
    return PATHS.df(spark, sf).select(
        "doc_id", ids.segment_id(path).alias("by_segment"), ids.layer_id(path).alias("by_layer")
    )


@query(
    "SELECT p_partkey, concat_ws('_', CASE p_partkey % 2 WHEN 0 THEN 'train' ELSE 'val' END, "
    "lower(replace(concat(p_type, ' Content'), ' ', '_')), replace(p_name, ' ', '_')) AS video_id FROM part"
)
def q_composite_id(spark, sf):
    split = F.when(F.col("p_partkey") % 2 == 0, "train").otherwise("val")
    label = F.concat(F.col("p_type"), F.lit(" Content"))
    return load(spark, sf, "part").select(
        "p_partkey", ids.composite_id(split, label, F.col("p_name")).alias("video_id")
    )


_slug = (
    "CASE split_part(path, '/', 2) WHEN 'Safe' THEN 'safe' WHEN 'Adult Content' THEN 'adult' "
    "WHEN 'Harmful Content' THEN 'harmful' ELSE 'suicide' END"
)


@query(
    "SELECT path, concat_ws('_', split, slug, lpad(CAST(row_number() OVER (PARTITION BY split, slug "
    "ORDER BY path) AS STRING), 6, '0')) AS video_id FROM (SELECT path, split_part(path, '/', 1) AS split, "
    f"{_slug} AS slug FROM {V.MEDIA_PATHS.sql})"
)
def q_running_index_id(spark, sf):
    parts = F.split("path", "/")
    df = V.MEDIA_PATHS.df(spark, sf).select(
        "path", parts[0].alias("split"), labels.folder_slug(parts[1]).alias("slug")
    )
    return projections.running_index_id(df, ("split", "slug"), ["path"]).select("path", "video_id")


@query(
    "SELECT CAST(event_id AS STRING) AS video_id, concat('https://site.example/@u/video/', event_id) AS url, "
    "props AS description, NULL::VARCHAR AS author, "
    "CASE WHEN event_id % 4 = 0 THEN concat(user_id, 'K') ELSE CAST(user_id AS STRING) END AS likes, "
    "json_extract_string(props, '$.k') AS comments, NULL::VARCHAR AS bookmarks, event_type AS source, "
    "epoch_us(ts) / 1e6 AS ts, 2 AS n_tags FROM events UNION ALL "
    "SELECT CAST(doc_id AS STRING), concat('https://site.example/@', lang, '/video/', doc_id, '?a=1'), text, "
    "lang, CASE WHEN doc_id % 3 <> 0 THEN CAST(n_chars AS STRING) END, CAST(length(text) AS STRING), '7', NULL, NULL, 1 FROM documents "
    "UNION ALL SELECT CAST(o_orderkey AS STRING), NULL, NULL, CAST(o_custkey AS STRING), "
    "CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, o_orderpriority, NULL, 'orders', "
    "o_totalprice, NULL FROM orders"
)
def q_unify_metadata(spark, sf):
    """Three crawl variants under one schema."""
    mapped = crawled_events(spark, sf)
    paged = load(spark, sf, "documents").select(
        F.col("lang").alias("author"),
        F.col("text").alias("description"),
        F.when(F.col("doc_id") % 3 == 0, "N/A").otherwise(F.col("n_chars").cast("string")).alias("likes"),
        F.length("text").cast("string").alias("comments"),
        F.lit("7").alias("bookmarks"),
        F.concat(F.lit("https://site.example/@"), "lang", F.lit("/video/"), "doc_id", F.lit("?a=1")).alias("videoUrl"),
        F.array("source").alias("tags"),
    )
    scraped = load(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.col("o_custkey").cast("string").alias("author"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise(F.lit("N/A")).alias("likes"),
        F.col("o_orderpriority").alias("comments_count"),
        F.lit("orders").alias("source"),
        F.col("o_totalprice").alias("timestamp"),
    )
    posts = union_sources(*[projections.unify_metadata(d) for d in (mapped, paged, scraped)])
    n_tags = F.when(F.col("tags").isNotNull(), F.size("tags"))
    return posts.select(
        "video_id", "url", "description", "author", "likes", "comments", "bookmarks", "source", "ts",
        n_tags.alias("n_tags"),
    )


@query("SELECT event_id, ts, value FROM events WHERE event_type = 'click'")
def q_filter_label(spark, sf):
    e = load(spark, sf, "events")
    return filters.filter_label(filters.filter_label(e), "click", "event_type").select("event_id", "ts", "value")


@query(
    "SELECT event_id, ts, event_type FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' "
    "AND TIMESTAMP '2024-01-12 12:00:00'"
)
def q_filter_time_range(spark, sf):
    e = filters.filter_time(load(spark, sf, "events"), "ts", start="2024-01-01")
    return filters.filter_time(e, "ts", "2024-01-10 00:00:00", "2024-01-12 12:00:00").select(
        "event_id", "ts", "event_type"
    )


@query(
    "SELECT doc_id FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings) "
    "AND doc_id IN (SELECT doc_id FROM labels)"
)
def q_complete_features(spark, sf):
    return filters.complete_ids(
        "doc_id",
        load(spark, sf, "documents"),
        load(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id"),
        load(spark, sf, "labels"),
    )


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def q_filter_ids(spark, sf):
    wanted = load(spark, sf, "labels").filter("toxic = 1")
    docs = filters.filter_ids(load(spark, sf, "documents"), "doc_id", [])
    return filters.filter_ids(docs, "doc_id", wanted).select("doc_id", "lang", "source")


@query(f"SELECT path FROM {V.MEDIA_PATHS.sql} WHERE split_part(path, '/', 1) IN ('train', 'val')")
def q_filter_split(spark, sf):
    df = V.MEDIA_PATHS.df(spark, sf).withColumn("split", F.split("path", "/")[0])
    return filters.filter_split(df, ["train", "val"]).select("path")


@query(
    "SELECT CASE WHEN event_type <> 'error' AND event_id % 21 <> 0 THEN 'ok' ELSE 'failed' END AS outcome, "
    "event_type, count(*) AS n, ROUND(sum(value), 2) AS total FROM events GROUP BY 1, 2"
)
def q_route_status(spark, sf):
    e = load(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_id") % 21 != 0, 200)
    ok, failed = filters.route(e.withColumn("status", status), F.col("status") == 200)
    both = ok.withColumn("outcome", F.lit("ok")).unionByName(failed.withColumn("outcome", F.lit("failed")))
    return both.groupBy("outcome", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )
