"""Composite jobs over the layered tables. None of them stops the session."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsift.functions.text import join_comments, normalize_text, strip_hashtags, tag_text
from clipsift.operators import aggregates, filters, joins, metrics, ordering, projections, sampling
from clipsift.operators.comments import joined_text_by
from clipsift.operators.features import numeric_vector
from clipsift.operators.models import encode_text
from clipsift.operators.scaling import fit_scaler
from clipsift.operators.sets import union_sources
from clipsift.session import durable
from clipsift.sources import annotations, readers, writers
from clipsift.sources.featurestore import BUCKETS, SeenIds
from clipsift.streaming.events import event_json, run_available

log = logging.getLogger(__name__)

Build = Callable[[DataFrame], DataFrame]

FEATURE_COLUMNS = ("video_emb", "audio_emb", "numeric_scaled", "comments_emb")


def _missing(err: AnalysisException) -> bool:
    """Whether a table is not there; any other error is one."""
    return err.getCondition() == "PATH_NOT_FOUND"


def labeled_silver(
    spark: SparkSession, bronze: str, silver: str, media_root: str, multiline: bool = True
) -> None:
    """Labelled metadata -> silver table with audit column and media path."""
    rows = readers.read_labeled_bronze(spark, bronze, multiline)
    writers.write_layer(projections.with_media_path(projections.with_audit(rows), media_root), silver)


def crawled_silver(
    spark: SparkSession, bronze: str, silver: str, multiline: bool = True, run_id: str | None = None
) -> None:
    """Crawled metadata -> silver table partitioned by source (append).

    With a ``run_id`` the same run may be repeated without a second copy of its rows, and
    ``writers.read_runs`` reads the table.
    """
    rows = projections.extract_stats(readers.read_crawled_bronze(spark, bronze, multiline))
    rows = projections.with_audit(rows, "processed_at")
    if run_id is None:
        writers.write_layer(rows, silver, "append", ["source"])
    else:
        writers.append_run(rows, silver, run_id, ["source"])


def gold_sets(
    spark: SparkSession,
    labeled: str,
    crawled: str,
    gold: str,
    feature_root: str,
    available: DataFrame | None = None,
) -> dict[str, str]:
    """Training and inference sets with feature paths.

    Either half may fail alone when its silver table is missing. With ``available`` (ids whose
    features exist) only those items are kept.
    """
    written = {}
    for name, source, kinds in (
        ("training_set", labeled, ("audio", "video", "text")),
        ("inference_set", crawled, ("video",)),
    ):
        try:
            rows = readers.read_layer(spark, source)
            if available is not None:
                rows = filters.filter_ids(rows, "video_id", available)
            path = f"{gold}/{name}"
            writers.write_layer(projections.with_feature_paths(rows, feature_root, kinds), path)
            written[name] = path
        except AnalysisException as err:
            if not _missing(err):
                raise
            log.warning("%s skipped: %s", name, err)
    return written


def batch_etl(
    spark: SparkSession, bronze: Mapping[str, str], root: str, media_root: str, feature_root: str,
    multiline: bool = True,
) -> dict[str, str]:
    """Bronze to silver for both sources, then silver to gold; a missing source skips its half."""
    labeled, crawled = f"{root}/silver/labeled", f"{root}/silver/crawled"
    for job in (
        lambda: labeled_silver(spark, bronze["labeled"], labeled, media_root, multiline),
        lambda: crawled_silver(spark, bronze["crawled"], crawled, multiline),
    ):
        try:
            job()
        except AnalysisException as err:
            if not _missing(err):
                raise
            log.warning("silver step skipped: %s", err)
    return gold_sets(spark, labeled, crawled, f"{root}/gold", feature_root)


def metadata_features(
    posts: DataFrame,
    dim: int,
    sample_n: int | None = None,
    encoder=None,
    key: str = "video_id",
    comments: DataFrame | None = None,
    sparse: bool = False,
    **vector_options,
) -> DataFrame:
    """Posts -> silver metadata features: scaled and raw numerics, three text vectors.

    ``posts`` holds the five counts, date, description, tags and comment_texts; instead of these
    ``comments`` may hold the comments as rows (key, pos, text), which are never collected for the
    numbers and joined to a post's text from pieces of bounded length. The 25 numbers are
    written once with the texts beside them, since the scaler reads them before the output does;
    the texts are encoded only for the output. Rows stay as they are, also those without a key or
    with a repeated one. Without an ``encoder`` the text vectors may stay ``sparse``, as in
    ``encode_text``, for a table that is written.
    """
    names = joins.NUMERIC_FEATURES
    texts = {
        "desc": normalize_text(strip_hashtags(F.col("description"))),
        "tags": normalize_text(tag_text(F.col("tags"))),
    }
    if comments is None:
        texts["comments"] = join_comments(F.col("comment_texts"))
    else:
        posts = posts.join(joined_text_by(comments, key, out="_spoken"), key, "left")
        texts["comments"] = F.col("_spoken")
    carried = [text.alias(f"_{name}") for name, text in texts.items()]
    raw = durable(numeric_vector(posts, comments=comments, key=key, **vector_options).select(key, *names, *carried), "numeric")
    both = raw.withColumn("numeric_raw", F.array(*[F.col(n) for n in names]))
    rows = fit_scaler(raw, names, sample_n, key if sample_n else None).transform(both)
    rows = rows.withColumn("numeric_scaled", F.array(*[F.col(n) for n in names]))
    for name in texts:
        rows = encode_text(rows, f"_{name}", dim, f"{name}_emb", encoder, sparse=sparse)
    return rows.select(key, "numeric_scaled", "numeric_raw", *[f"{name}_emb" for name in texts])


def full_features(
    items: DataFrame,
    silver: DataFrame,
    build: Build,
    labels: DataFrame | None = None,
    key: str = "video_id",
    drop: Sequence[int] | None = None,
    save: str | None = None,
) -> DataFrame:
    """Gold rows for ``items``: features already in ``silver`` are reused, others built.

    Both hold (key, video_emb, audio_emb, numeric_scaled, comments_emb); an item whose feature
    is null is left out without failing the others (``failed_items`` lists it). Complete new rows
    are added to the silver table ``save``, so that the next run finds them.
    """
    wanted = items.select(key).distinct()
    marked = joins.resume_split(wanted, silver, key)
    fresh = build(marked.filter(~F.col("reused")).select(key))
    kept = silver.join(marked.filter("reused").select(key), key, "left_semi")
    if save is not None:
        fresh = durable(fresh, "fresh")
        writers.write_layer(_complete(fresh).select(*silver.columns), save, "append")
    rows = union_sources(kept, fresh)
    return joins.finish_rows(rows, labels, key, drop)


def _complete(rows: DataFrame) -> DataFrame:
    return rows.filter(" and ".join(f"{c} is not null" for c in FEATURE_COLUMNS))


def failed_items(items: DataFrame, gold: DataFrame, key: str = "video_id") -> DataFrame:
    """Items that were wanted and have no gold row."""
    return items.select(key).distinct().join(gold.select(key), key, "left_anti")


def incremental(
    stream: DataFrame,
    silver: str,
    build: Build,
    root: str,
    checkpoint: str,
    source: str = "watcher",
    labels: DataFrame | None = None,
    drop: Sequence[int] | None = None,
    audio_width: int | None = None,
    buckets: int = BUCKETS,
) -> None:
    """New ids on a stream -> features, gold rows and one event per finished item, below ``root``.

    An id is new if neither the table ``silver`` nor an earlier batch has its features. Finished ids
    are kept in ``seen``, by bucket and with filters, so that a batch reads only the buckets that may
    hold one of its ids (a root keeps its number of ``buckets``); what ``silver`` has got besides is added there when the stream starts. No
    state is kept. Failed audio becomes zeros of ``audio_width``; other items without a feature go to
    ``failed`` and are tried again when they come again. New features go to ``silver``, gold rows
    to ``gold``, events to ``events``, each in the batch's own folder, which a batch that runs
    again overwrites.
    """
    seen = SeenIds(stream.sparkSession, f"{root}/seen", buckets=buckets)
    known = _if_there(stream.sparkSession, silver)
    if known is not None:
        seen.add_outside(known.select("video_id"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, target = batch.sparkSession, f"batch_id={batch_id}"
        wanted = durable(seen.unseen(batch, batch_id), "wanted")
        rows = build(wanted)
        if audio_width is not None:
            silence = F.array_repeat(F.lit(0.0).cast("float"), audio_width)
            rows = rows.withColumn("audio_emb", F.coalesce("audio_emb", silence))
        done_path = f"{root}/silver/{target}"
        _complete(rows).select("video_id", *FEATURE_COLUMNS).write.mode("overwrite").parquet(done_path)
        done = spark.read.parquet(done_path)
        failed_items(wanted, done).write.mode("overwrite").parquet(f"{root}/failed/{target}")
        writers.gold_rows(joins.finish_rows(done, labels, drop=drop)).write.mode("overwrite").parquet(
            f"{root}/gold/{target}"
        )
        path = F.concat(F.lit("bronze/"), F.col("video_id"), F.lit("/video.mp4"))
        note = event_json(
            F.col("video_id"), F.lit(source), path, F.unix_micros(F.current_timestamp()) / F.lit(1e6),
            F.create_map(F.lit("status"), F.lit("ready")),
        )
        done.select(note.alias("value")).write.mode("overwrite").text(f"{root}/events/{target}")
        seen.add(done, batch_id)

    run_available(stream.select("video_id"), write, checkpoint)


def _if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if not _missing(err):
            raise
        return None


def label_refresh(
    gold: DataFrame, tasks: DataFrame, json_col: str, ordinal: str, path: str
) -> DataFrame:
    """Gold rows with the labels of an annotation export, saved to ``path``; returns the change count.

    ``path`` may be the table that ``gold`` reads; it is replaced as a whole after a complete
    write, and left alone if no label changes.
    """
    labels = annotations.parse_annotations(tasks, json_col, ordinal)
    updated = writers.gold_rows(joins.update_labels(gold, labels), "changed")
    counts = writers.replace_table(updated, path, may_be_empty=False, changed=F.count_if("changed"))
    return gold.sparkSession.createDataFrame(
        [(counts["n"], counts["changed"])], "n long, updated_count long"
    )


def evaluation(
    gold: DataFrame,
    scorers: Mapping[str, Callable[[DataFrame], DataFrame]],
    base: str,
    other: str,
    ratio: float = 0.8,
    key: str = "video_id",
) -> DataFrame:
    """Held-out comparison of two models: acc, prec, rec, f1 and auc side by side.

    Each scorer turns the held-out rows into (key, label, pred, prob).
    """
    held_out = sampling.split(gold, ratio, key).filter("split = 'val'")
    parts = [
        scorer(held_out).select(key, "label", "pred", "prob", F.lit(name).alias("model"))
        for name, scorer in scorers.items()
    ]
    rows = union_sources(*parts)
    wide = metrics.binary_metrics(rows, keys=["model"]).join(
        metrics.roc_auc(rows, keys=["model"]), "model"
    )
    return metrics.compare_models(metrics.metrics_long(wide), base, other)


def latency_report(df: DataFrame, limit: int | None = None, id_col: str = "video_id") -> DataFrame:
    """(section, metric, value) rows: latency figures, throughput and overhead."""
    rows = ordering.recent(df, limit, "ingested_at", id_col) if limit else df
    timed = aggregates.with_latency(rows)
    found = aggregates.describe(
        timed, {"e2e": F.col("e2e_latency_sec"), "inference": F.col("inference_latency_ms")}
    )
    stats = [c for c in found.columns if c != "metric"]
    figures = found.select(
        "metric", *[F.col(c).cast("double").alias(c) for c in stats]
    ).unpivot(["metric"], stats, "stat", "value")
    rates = aggregates.throughput(timed).select(
        F.lit("throughput").alias("metric"),
        F.explode(
            F.create_map(
                F.lit("n"), F.col("n").cast("double"), F.lit("seconds"), "seconds", F.lit("per_sec"), "per_sec"
            )
        ).alias("stat", "value"),
    )
    extra = aggregates.overhead(timed).select(
        F.lit("overhead").alias("metric"), F.lit("overhead_ms").alias("stat"), F.col("overhead_ms").alias("value")
    )
    return figures.unionByName(rates).unionByName(extra)


def dashboard(
    df: DataFrame,
    positive: str,
    link: str,
    label: str = "All",
    recent_n: int = 50,
    trend_n: int | None = None,
    id_col: str = "video_id",
    ts: str = "ingested_at",
) -> DataFrame:
    """(section, item, n, note) rows: label counts, risk ratio, latest items with links, trend.

    ``trend_n`` restricts the trend to the latest rows.
    """
    def part(name: str, item: Column, n: Column, note: Column) -> list[Column]:
        return [
            F.lit(name).alias("section"),
            item.cast("string").alias("item"),
            n.cast("double").alias("n"),
            note.cast("string").alias("note"),
        ]

    none = F.lit(None)
    stamp = "yyyy-MM-dd HH:mm:ss"
    counts = aggregates.label_counts(df).select(*part("labels", F.col("label"), F.col("n"), none))
    risk = aggregates.risk_ratio(df, positive).select(
        *part("risk", F.lit(positive), F.col("total"), F.col("risk_text"))
    )
    latest = projections.with_link(
        ordering.recent(df, recent_n, ts, id_col, label), link, id_col
    ).select(*part("recent", F.col(id_col), none, F.col("link")))
    rows = ordering.recent(df, trend_n, ts, id_col) if trend_n else df
    trend = aggregates.trend(rows, ts).select(
        *part("trend", F.date_format("bin", stamp), F.col("n"), none)
    )
    return counts.unionByName(risk).unionByName(latest).unionByName(trend)
