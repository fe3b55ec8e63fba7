"""Joins, filters, projections, annotations."""

import pytest
from pyspark.sql import functions as F

from clipsift.operators import filters, joins, projections, sets
from clipsift.sources import annotations, listings


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_update_counts_only_changes(spark):
    df = frame(spark, [("a", 0), ("b", 2), ("c", 1), ("d", None)], "video_id string, label int")
    new = frame(spark, [("a", 0), ("b", 0), ("d", 2), ("x", 1)], "video_id string, label int")
    got = {r["video_id"]: (r["label"], r["changed"]) for r in joins.update_labels(df, new).collect()}
    assert got == {"a": (0, False), "b": (0, True), "c": (1, False), "d": (2, True)}


def test_verification(spark):
    df = frame(spark, [("a", 0), ("b", 2)], "video_id string, label int")
    manual = frame(spark, [("a", 0), ("b", 1)], "video_id string, label int")
    verified = joins.verify_labels(df, manual)
    assert {r["video_id"]: (r["status"], r["verified_label"]) for r in verified.collect()} == {
        "a": ("match", 0), "b": ("mismatch", 1)}
    assert tuple(joins.verification_summary(verified).first()) == (1, 1, 0, True)
    some = joins.verify_labels(df, manual.filter("video_id = 'a'"))
    assert tuple(joins.verification_summary(some).first()) == (1, 0, 1, False)


def test_assemble_drops_incomplete_items(spark):
    video = frame(spark, [("a", [1.0]), ("b", [2.0]), ("c", None)], "video_id string, video_emb array<float>")
    audio = frame(spark, [("a", [3.0]), ("c", [3.0])], "video_id string, audio_emb array<float>")
    numbers = [float(i) for i in range(25)]
    meta = frame(spark, [(k, numbers, [4.0]) for k in "abc"],
                 "video_id string, numeric_scaled array<float>, comments_emb array<float>")
    got = joins.assemble_features(video, audio, meta).collect()
    assert len(got) == 1 and got[0]["video_id"] == "a" and got[0]["label"] == -1
    assert got[0]["metadata_numeric"] == [x for x in numbers if x not in (16.0, 21.0, 23.0)]


def test_resolve_label_order(spark):
    items = frame(spark, [(k,) for k in "abcd"], "video_id string")
    gold = frame(spark, [("a", "3")], "video_id string, label string")
    silver = frame(spark, [("a", '"Safe"'), ("b", "null")], "video_id string, label string")
    bronze = frame(spark, [("a", "adult", None), ("b", "", "adult"), ("c", "", "")],
                   "video_id string, label string, label_raw string")
    got = {r["video_id"]: (r["stored_label"], r["row_label"])
           for r in joins.resolve_label(items, gold, silver, bronze).collect()}
    assert got == {"a": (3, 0), "b": (1, 1), "c": (2, 2), "d": (None, -1)}


def test_resume_split_keeps_one_row_per_item(spark):
    items = frame(spark, [("a",), ("b",)], "video_id string")
    done = frame(spark, [("a",), ("a",)], "video_id string")
    assert {r["video_id"]: r["reused"] for r in joins.resume_split(items, done, "video_id").collect()} == {
        "a": True, "b": False}


def test_filters(spark):
    df = frame(spark, [("a", 1), (None, 2)], "label string, t int")
    assert filters.filter_label(df).count() == 2 and filters.filter_label(df, "a").count() == 1
    assert filters.filter_time(df, "t", 1).count() == 2 and filters.filter_time(df, "t", 1, 1).count() == 1
    assert filters.filter_ids(df, "t", []).count() == 2 and filters.filter_ids(df, "t", [2]).count() == 1
    ok, failed = filters.route(df, F.col("label") == "a")
    assert (ok.count(), failed.count()) == (1, 1)


def test_complete_ids(spark):
    a, b, c = (frame(spark, [(x,) for x in s], "id string") for s in ("abcd", "bcda", "bb"))
    assert [r["id"] for r in filters.complete_ids("id", a, b, c).collect()] == ["b"]


def test_union_fills_missing_columns(spark):
    got = sets.union_sources(frame(spark, [(1, "x")], "a int, b string"), frame(spark, [(2,)], "a int")).collect()
    assert sorted((r["a"], r["b"]) for r in got) == [(1, "x"), (2, None)]


TASKS = [
    '{"id":1,"data":{"video":"s://b/bronze/v1/video.mp4"},"annotations":[{"result":[{"value":{"choices":["SAFE"]}}]}]}',
    '{"id":2,"data":{"video":"s://b/bronze/v1/video.mp4"},"annotations":[{"result":[{"value":{"choices":["NOT SAFE"]}}]}]}',
    '{"id":3,"data":{"video":"s://b/bronze/v2/video.mp4"},"annotations":[]}',
    '{"id":4,"data":{"video":"s://b/bronze/v3/video.mp4"}}',
    '{"id":5,"data":{"video":"s://b/bronze/v4/video.mp4"},"annotations":[{"result":[]}]}',
    '{"id":6,"data":{"video":"v5.mp4"},"annotations":[{"result":[{"value":{"choices":["SAFE"]}}]}]}',
    '{"id":7,"data":{"video":"s://b/bronze/v6/video.mp4"},"annotations":[{"result":[{"value":{"choices":["MAYBE"]}}]}]}',
    "broken",
]


def test_annotations(spark):
    df = frame(spark, list(enumerate(TASKS)), "n long, task string")
    by_id = {r["video_id"]: r["label"] for r in annotations.parse_annotations(df, "task", "n").collect()}
    assert by_id == {"v1": 2}
    by_path = {r["path"]: r["choice"] for r in annotations.parse_annotations_by_path(df, "task", "n").collect()}
    assert by_path == {"s://b/bronze/v1/video.mp4": "NOT SAFE", "v5.mp4": "SAFE", "s://b/bronze/v6/video.mp4": "MAYBE"}


def test_manifest(spark):
    paths = ["train/Adult Content/My Clip.MP4", "val/Safe/deep/x.mov", "train/Safe/notes.txt", "other/Safe/x.mp4", "train/x.mp4"]
    got = sorted(tuple(r) for r in listings.directory_manifest(frame(spark, [(p,) for p in paths], "path string")).collect())
    assert got == [
        ("train_adult_content_My_Clip", "train", "Adult Content", paths[0]),
        ("val_safe_x", "val", "Safe", paths[1]),
    ]


def test_extract_stats_from_map_or_columns(spark):
    df = frame(spark, [({"likes": "12", "comments": "3K"}, "9"), (None, "7"), ({"likes": "307K"}, None)],
               "stats map<string,string>, shares string")
    got = [tuple(r) for r in projections.extract_stats(df).select("likes", "comments_count", "shares").collect()]
    assert got == [(12, "3K", "9"), (None, None, "7"), (None, None, None)]


def test_unify_keeps_comment_trees(spark):
    df = frame(spark, [("https://s/@u/video/9?x", "N/A", [("hi",)])],
               "url string, likes string, comments_tree array<struct<text:string>>")
    got = projections.unify_metadata(df).first()
    assert (got["video_id"], got["likes"]) == ("9", None)
    assert got["comments_tree"][0]["text"] == "hi" and got["comments_tree"][0]["replies"] is None


def test_canonical_urls(spark):
    df = frame(spark, [("/@a/video/1?x",), ("https://s/@a/video/1",), ("/about",), (None,)], "h string")
    assert [r["url"] for r in projections.canonical_urls(df, "h", "https://s").collect()] == ["https://s/@a/video/1"]


@pytest.mark.parametrize("n", [1, 3])
def test_running_index(spark, n):
    df = frame(spark, [("train", "safe", f"p{i}") for i in range(n)], "split string, slug string, path string")
    got = sorted(r["video_id"] for r in projections.running_index_id(df, ("split", "slug"), ["path"]).collect())
    assert got == [f"train_safe_{i:06d}" for i in range(1, n + 1)]


def test_repeated_ids_on_the_right_give_one_row(spark):
    items = spark.createDataFrame([("a", 0), ("b", 1)], "video_id string, label int")
    given = spark.createDataFrame([("a", 2, 1), ("a", 3, 5), ("a", 1, 4)], "video_id string, label int, at int")
    updated = joins.update_labels(items, given, ordinal="at")
    assert {r["video_id"]: (r["label"], r["changed"]) for r in updated.collect()} == {"a": (3, True), "b": (1, False)}
    assert updated.count() == 2 and joins.update_labels(items, given).count() == 2
    verified = {r["video_id"]: r["verified_label"] for r in joins.verify_labels(items, given, ordinal="at").collect()}
    assert verified == {"a": 3, "b": 1}
    twice = spark.createDataFrame([("a", 1), ("a", 1)], "video_id string, choice int")
    assert joins.annotator_overlap(twice, twice, "video_id").count() == 1
