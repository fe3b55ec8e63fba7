"""Readers, writers and composite jobs on small folders."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from clipsift import session
from clipsift.operators.features import numeric_vector
from clipsift.operators.joins import NUMERIC_FEATURES
from clipsift.plans import jobs
from clipsift.sources import listings, readers, writers


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(f"{root}/x-")
    df = session.durable(spark.range(3), "numbers")
    assert f"{root}/numbers-" in df.inputFiles()[0] and df.count() == 3


def test_scratch_can_be_cleared(spark):
    df = session.durable(spark.range(3), "short")
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    kept, session._MADE[:] = list(session._MADE[:-1]), session._MADE[-1:]  # only what this test made
    assert os.path.isdir(folder) and session.clear_scratch(spark) == 1 and not os.path.exists(folder)
    session._MADE[:] = kept


def test_labeled_reader_ignores_extra_fields(spark, tmp_path):
    put(tmp_path / "v1" / "metadata.json", {"video_id": "v1", "label": "Safe", "original_path": "x"})
    got = readers.read_labeled_bronze(spark, f"{tmp_path}/*/*.json").first()
    assert got["video_id"] == "v1" and got["split"] is None and "original_path" not in got.asDict()


def test_pretty_printed_documents(spark, tmp_path):
    for i in range(3):
        put(tmp_path / f"v{i}" / "metadata.json", json.dumps({"video_id": f"v{i}", "label": "Safe", "likes": "3K", "stats": {"likes": "3"}}, indent=2))
    assert [r["stats"] for r in readers.read_crawled_bronze(spark, f"{tmp_path}/*/*.json").collect()] == [{"likes": "3"}] * 3
    assert {r["label"] for r in readers.read_labeled_bronze(spark, f"{tmp_path}/*/*.json").collect()} == {"Safe"}
    keyed = readers.read_keyed_metadata(spark, str(tmp_path), "likes string")
    assert keyed.count() == 3 and {(r["video_id"], r["likes"]) for r in keyed.collect()} == {(f"v{i}", "3K") for i in range(3)}


def test_one_document_a_line(spark, tmp_path):
    put(tmp_path / "v1" / "metadata.json", '{"likes": "1"}\n\n{"likes": "2"}\n{"likes"')
    got = readers.read_keyed_metadata(spark, str(tmp_path), "likes string", multiline=False)
    assert got.count() == 2 and {r["likes"] for r in got.collect()} == {"1", "2"}


def test_keyed_reader_takes_the_folder_and_skips_broken_files(spark, tmp_path):
    put(tmp_path / "v 1+é" / "metadata.json", {"likes": "3K"})
    put(tmp_path / "v2" / "metadata.json", "{broken")
    got = readers.read_keyed_metadata(spark, str(tmp_path), "likes string").collect()
    assert [(r["video_id"], r["likes"]) for r in got] == [("v 1+é", "3K")]


def test_tolerant_lines(spark, tmp_path):
    lines = ['{"video_id":"a","timestamp":"2024-01-01T10:00:00.5","n":"x"}', " \t", "oops", '{"video_id":"z",', '{"video_id":"b","timestamp":"x"}', '{"video_id":"c"}']
    put(tmp_path / "log.jsonl", "\n".join(lines))
    schema = "video_id string, timestamp string, n int"
    got = readers.read_jsonl_tolerant(spark, str(tmp_path), schema, default_ts="2000-01-01")
    assert {r["video_id"]: str(r["t"]) for r in got.select("video_id", F.col("ingested_at").cast("string").alias("t")).collect()} == {
        "a": "2024-01-01 10:00:00.5", "b": "2000-01-01 00:00:00", "c": "2000-01-01 00:00:00"}
    assert readers.read_jsonl_tolerant(spark, str(tmp_path), schema).filter("ingested_at is null").count() == 0


def test_list_files(spark, tmp_path):
    put(tmp_path / "bronze" / "a" / "video.mp4", "12345")
    got = listings.list_files(spark, str(tmp_path)).first()
    assert got["path"].endswith("bronze/a/video.mp4") and got["size"] == 5


def test_gold_refuses_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "video_id string, video_emb array<float>, audio_emb array<float>, "
                                      "text_emb array<float>, metadata_numeric array<float>, label int")
    with pytest.raises(ValueError):
        writers.write_gold(empty, str(tmp_path / "gold"))


def test_batch_etl_half_missing_and_rerun(spark, tmp_path):
    put(tmp_path / "labeled" / "v1" / "metadata.json", {"video_id": "v1", "label": "Safe", "split": "train"})
    bronze = {"labeled": f"{tmp_path}/labeled/*/*.json", "crawled": f"{tmp_path}/missing/*/*.json"}
    for _ in range(2):
        made = jobs.batch_etl(spark, bronze, str(tmp_path / "lake"), "s://b/bronze/", "s://b/silver/")
        assert list(made) == ["training_set"]
    got = spark.read.parquet(made["training_set"]).collect()
    assert len(got) == 1 and got[0]["audio_feat_path"] == "s://b/silver/v1/audio_embedding.npy"
    assert got[0]["bronze_video_path"] == "s://b/bronze/v1/video.mp4"


POST = "video_id string, likes string, comments int, shares string, bookmarks string, views string, date string, comment_texts array<string>"


def test_numeric_vector(spark):
    rows = [("a", "1K", 10, "5", None, "2K", "8-9", ["I hate this 😂", "", "why?"]), ("b", None, None, "N/A", "x", "0", "2-30", None)]
    df = numeric_vector(spark.createDataFrame(rows, POST))
    got = {r["video_id"]: dict(zip(NUMERIC_FEATURES, r["numeric_raw"])) for r in df.collect()}
    a, b = got["a"], got["b"]
    assert a["likes_log"] == pytest.approx(math.log1p(1000)) and a["like_rate"] == 0.5
    assert a["engagement_rate"] == pytest.approx(1015 / 2000) and (a["has_views"], a["has_bookmarks"]) == (1.0, 0.0)
    assert a["age_days"] == 118.0 and a["n_comments"] == 3.0 and a["frac_has_question"] == pytest.approx(1 / 3)
    assert a["frac_has_laugh_emoji"] == 0.0 and a["n_toxic_comments"] == 1.0 and a["frac_toxic_comments"] == 0.5
    assert all(b[n] == 0.0 for n in NUMERIC_FEATURES if n != "has_views") and b["has_views"] == 1.0
    raw = numeric_vector(spark.createDataFrame(rows, POST), emoji_stats_on="raw").filter("video_id = 'a'").first()
    assert raw["frac_has_laugh_emoji"] == pytest.approx(1 / 3)


def test_metadata_features(spark):
    rows = [("a", "1K", 10, "5", None, "2K", "8-9", ["x y"], "hello #tag", ["#a"]), ("b", "2", 1, "1", "1", "9", None, [], None, None)]
    posts = spark.createDataFrame(rows, POST + ", description string, tags array<string>")
    got = {r["video_id"]: r for r in jobs.metadata_features(posts, 8).collect()}
    column = NUMERIC_FEATURES.index("likes_log")
    assert got["a"]["numeric_scaled"][column] == pytest.approx(1.0) and got["b"]["numeric_scaled"][column] == pytest.approx(-1.0)
    assert got["b"]["desc_emb"] == [0.0] * 8 == got["b"]["comments_emb"] and any(got["a"]["tags_emb"])


def test_metadata_features_keeps_every_row(spark):
    """Posts without a key stay, and a repeated key pairs each post's numbers with its own texts."""
    rows = [(key, str(10 ** i), 1, "1", "1", "9", None, ["x"], text, None)
            for i, (key, text) in enumerate([(None, "one"), (None, ""), ("a", "one"), ("a", ""), ("a", "one"), ("b", "")])]
    posts = spark.createDataFrame(rows, POST + ", description string, tags array<string>")
    column = NUMERIC_FEATURES.index("likes_log")
    got = jobs.metadata_features(posts, 8).collect()
    found = sorted((round(math.expm1(r["numeric_raw"][column])), r["video_id"], any(r["desc_emb"])) for r in got)
    assert found == [(10 ** i, r[0], r[8] == "one") for i, r in enumerate(rows)]


SILVER = "video_id string, video_emb array<float>, audio_emb array<float>, numeric_scaled array<float>, comments_emb array<float>"


def layers(spark, names, value):
    return spark.createDataFrame([(n, [value], [value], [value] * 25, [value]) for n in names], SILVER)


def test_full_features_builds_only_what_is_missing(spark):
    asked = []

    def build(items):
        asked.extend(sorted(r["video_id"] for r in items.collect()))
        return layers(spark, ["b"], 2.0).unionByName(
            spark.createDataFrame([("c", None, [1.0], [1.0] * 25, [1.0])], SILVER))

    items = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "video_id string")
    got = {r["video_id"]: r["video_emb"] for r in jobs.full_features(items, layers(spark, ["a", "z"], 1.0), build).collect()}
    assert got == {"a": [1.0], "b": [2.0]} and asked == ["b", "c"]


def test_incremental_over_runs(spark, tmp_path):
    """Copies, known ids, a batch of failures only, silent audio, and a failed id that comes again."""
    from clipsift.streaming import events

    layers(spark, ["old"], 1.0).write.parquet(str(tmp_path / "silver"))
    fail = {"bad"}

    def build(items):
        one = F.array(F.lit(1.0).cast("float"))
        video = F.when(~F.col("video_id").isin(*fail), one) if fail else one
        return items.select("video_id", video.alias("video_emb"), F.when(F.col("video_id") != "mute", one).alias("audio_emb"),
                            F.array_repeat(F.lit(1.0).cast("float"), 25).alias("numeric_scaled"), one.alias("comments_emb"))

    root = str(tmp_path / "out")
    for i, names in enumerate((["old", "a", "a"], ["bad"], ["a", "b", "mute"], ["bad", "a"])):
        if i == 3:
            fail.clear()
        put(tmp_path / "in" / f"{i}.txt", "\n".join(json.dumps({"video_id": n}) for n in names))
        stream = events.parse_events(events.event_source(spark, path=str(tmp_path / "in")))
        jobs.incremental(stream, str(tmp_path / "silver"), build, root, str(tmp_path / "ck"), audio_width=2)
    done = events.parse_events(spark.read.text(f"{root}/events").select("value"))
    assert sorted(r["video_id"] for r in done.collect()) == ["a", "b", "bad", "mute"]
    gold = {r["video_id"]: r["audio_emb"] for r in spark.read.parquet(f"{root}/gold").collect()}
    assert gold == {"a": [1.0], "b": [1.0], "bad": [1.0], "mute": [0.0, 0.0]}
    assert [r["video_id"] for r in spark.read.parquet(f"{root}/failed").collect()] == ["bad"]


def gold_table(spark, labels):
    one = F.array(F.lit(1.0).cast("float"))
    rows = spark.createDataFrame(labels, "video_id string, label long")
    return rows.select("video_id", *[one.alias(c) for c in ("video_emb", "audio_emb", "text_emb", "metadata_numeric")], "label")


def read_labels(spark, path):
    return {r["video_id"]: r["label"] for r in spark.read.parquet(path).collect()}


def test_label_refresh_in_place(spark, tmp_path):
    path = str(tmp_path / "gold")
    writers.write_gold(gold_table(spark, [("a", 0), ("b", 1)]), path)
    task = '{"id":1,"data":{"video":"s://x/bronze/a/video.mp4"},"annotations":[{"result":[{"value":{"choices":["NOT SAFE"]}}]}]}'
    tasks = spark.createDataFrame([(1, task), (2, task)], "ordinal long, task string")
    got = jobs.label_refresh(spark.read.parquet(path), tasks, "task", "ordinal", path).first()
    after = read_labels(spark, path)
    assert (got["n"], got["updated_count"]) == (2, 1) and after["b"] == 1 and after["a"] != 0
    files = {p.name for p in (tmp_path / "gold").iterdir()}
    assert jobs.label_refresh(spark.read.parquet(path), tasks, "task", "ordinal", path).first()["updated_count"] == 0
    assert files == {p.name for p in (tmp_path / "gold").iterdir()}  # nothing changed, nothing written
    assert [p.name for p in tmp_path.iterdir()] == ["gold"]


def test_failing_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "gold")
    writers.write_gold(gold_table(spark, [("a", 0)]), path)
    with pytest.raises(Exception):
        broken = spark.read.parquet(path).withColumn("label", F.raise_error(F.lit("no")).cast("long"))
        writers.write_layer(broken, path)
    with pytest.raises(ValueError):
        writers.write_gold(spark.read.parquet(path).limit(0), path)
    assert read_labels(spark, path) == {"a": 0} and [p.name for p in tmp_path.iterdir()] == ["gold"]


def test_schema_errors_are_not_swallowed(spark, tmp_path):
    from pyspark.errors import AnalysisException

    spark.createDataFrame([("a",)], "video_id string").write.parquet(str(tmp_path / "labeled"))
    ids = spark.createDataFrame([("a",)], "wrong string")
    with pytest.raises(AnalysisException):
        jobs.gold_sets(spark, str(tmp_path / "labeled"), str(tmp_path / "none"), str(tmp_path / "gold"), "s://f/", ids)


def test_full_features_saves_what_it_built(spark, tmp_path):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "video_id string")
    silver = str(tmp_path / "silver")
    layers(spark, ["a"], 1.0).write.parquet(silver)

    def build(wanted):
        return layers(spark, ["b"], 2.0).unionByName(spark.createDataFrame([("c", None, [1.0], [1.0] * 25, [1.0])], SILVER))

    gold = jobs.full_features(items, spark.read.parquet(silver), build, save=silver)
    assert sorted(r["video_id"] for r in spark.read.parquet(silver).collect()) == ["a", "b"]
    assert [r["video_id"] for r in jobs.failed_items(items, gold).collect()] == ["c"]


def test_latency_report_of_the_latest_rows(spark):
    rows = [(str(i), float(i), f"2024-01-01 00:00:{i:02d}") for i in range(10)]
    df = spark.createDataFrame(rows, "video_id string, processing_time double, t string").select(
        "video_id", "processing_time", F.to_timestamp_ntz("t").alias("ingested_at"),
        (F.unix_timestamp(F.to_timestamp("t")) - 1).cast("double").alias("timestamp"))
    got = {(r["metric"], r["stat"]): r["value"] for r in jobs.latency_report(df, limit=4).collect()}
    assert got[("inference", "count")] == 4.0 and got[("inference", "min")] == 6.0 and got[("e2e", "p50")] == 1.0
    assert got[("throughput", "seconds")] == 3.0 and got[("overhead", "overhead_ms")] == pytest.approx(1000 - 7.5)


def test_dashboard_sections(spark):
    df = spark.sql("SELECT '1' AS video_id, 'bad' AS label, TIMESTAMP_NTZ '2024-01-01 00:01:00' AS ingested_at "
                   "UNION ALL SELECT '2', NULL, TIMESTAMP_NTZ '2024-01-01 00:11:00'")
    got = [tuple(r) for r in jobs.dashboard(df, "bad", "http://c/{}/v", trend_n=2000).collect()]
    assert ("labels", "Unknown", 1.0, None) in got and ("risk", "bad", 2.0, "50.0%") in got
    assert ("recent", "2", None, "http://c/2/v") in got and ("trend", "2024-01-01 00:05:00", 0.0, None) in got
