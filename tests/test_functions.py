"""Column functions on hand-made values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from clipsift.functions import comments, counts, dates, ids, labels, text, vectors
from clipsift.operators.joins import bronze_label, json_label


def apply(spark, fn, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_parse_count(spark):
    cases = {
        "307K": 307000.0, "4.5M": 4.5e6, "1b": 1e9, "3537": 3537.0, " N/A ": None, "": None,
        "abc": None, "K": None, "1d": None, "1 K": 1000.0, "1.2KK": None, "\u00a0 7 ": 7.0,
        "-3": -3.0, "1e3": 1000.0, ".5m": 5e5, "5.": 5.0, "1,000": None, "nan": None, None: None,
    }
    assert apply(spark, counts.parse_count, cases) == list(cases.values())


def test_count_of_lists_and_numbers(spark):
    df = spark.createDataFrame([([1, 2], 12), (None, None)], "l array<int>, n int")
    got = df.select(counts.count_of(F.col("l"), "array<int>"), counts.count_of(F.col("n"), "int")).collect()
    assert [tuple(r) for r in got] == [(2.0, 12.0), (None, None)]


def test_safe_log1p(spark):
    got = apply(spark, counts.safe_log1p, [None, -1.0, 0.0, math.e - 1], "double")
    assert got[:3] == [0.0, 0.0, 0.0] and got[3] == pytest.approx(1.0)


def test_ratio(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 1.0, 0.0), (3, 1.0, -2.0), (4, 1.0, 4.0), (5, None, 4.0)],
                               "i int, a double, b double")
    got = df.select("i", counts.ratio(F.col("a"), F.col("b")).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in got] == [0.0, 0.0, 0.0, 0.25, 0.0]


def test_parse_mm_dd(spark):
    cases = {"8-9": (8, 9), "08/09": (8, 9), "1.2": (1, 2), "13-1": None, "1-2-3": None,
             "a-b": None, "": None, " 12-31 ": (12, 31), "0-5": None, None: None}
    got = apply(spark, dates.parse_mm_dd, cases)
    assert [tuple(g) if g else None for g in got] == list(cases.values())


def test_date_features(spark):
    got = apply(spark, lambda c: dates.date_features(c, dt.date(2025, 12, 5), 2025),
                ["8-9", "2-30", "12-31", None])
    assert got[0]["age_days"] == 118.0 and got[0]["has_date"] == 1.0
    assert got[0]["month_sin"] == pytest.approx(math.sin(2 * math.pi * 8 / 12))
    assert tuple(got[1]) == (0.0, 0.0, 0.0, 0.0) == tuple(got[3])
    assert got[2]["age_days"] == 0.0 and got[2]["has_date"] == 1.0


def test_emojis(spark):
    cases = {"a😂b": "a <EMOJI_LAUGH> b", "☹️": " <EMOJI_SAD> ", "😱": " <EMOJI_SCARE> ",
             "plain": "plain", "☹": "☹", "🚗 x": "🚗 x"}
    assert apply(spark, text.map_emojis, cases) == list(cases.values())


def test_every_emoji_is_mapped(spark):
    for token, signs in text.EMOJI_TOKENS.items():
        assert apply(spark, text.map_emojis, signs) == [f" {token} "] * len(signs)


def test_text_cleaning(spark):
    assert apply(spark, text.strip_hashtags, ["hi #fun #x y", "none", "#é\u00a0b"]) == ["hi   y", "none", "\u00a0b"]
    assert apply(spark, text.normalize_whitespace, [" a \n b ", "a\u00a0\u2003b"]) == ["a b", "a b"]
    assert apply(spark, text.normalize_text, [None, "  ", " a😂 "]) == ["", "", "a <EMOJI_LAUGH>"]
    shout = lambda c: text.normalize_text(c, F.upper)
    assert apply(spark, shout, ["a b"]) == ["A B"]


def test_normalize_text_is_idempotent(spark):
    values = ["a😂 \n b", " ☹️☹️ ", "x"]
    once = apply(spark, text.normalize_text, values)
    assert apply(spark, text.normalize_text, once) == once


def test_tag_text_and_join(spark):
    assert apply(spark, text.tag_text, [["#a", "##b", "c"]], "array<string>") == ["a b c"]
    assert apply(spark, text.join_comments, [[" a ", "", "b😂"]], "array<string>") == ["a [SEP]  [SEP] b <EMOJI_LAUGH>"]


def test_truncate_counts_code_points(spark):
    assert apply(spark, lambda c: text.truncate(c, 3), ["😂abc", "ab"]) == ["😂ab", "ab"]


def test_map_label(spark):
    cases = {" Safe ": 0, "Adult Content": 1, "self-harm": 3, "not safe": 2, "zzz": 2, "": 2, None: None}
    assert apply(spark, labels.map_label, cases) == list(cases.values())


def test_label_remaps(spark):
    values = [-1, 0, 1, 2, 3]
    assert apply(spark, labels.finetune_label, values, "int") == [0, 0, 0, 1, 0]
    assert apply(spark, labels.binary_label, values, "int") == [0, 0, 1, 1, 1]


def test_json_label(spark):
    cases = {"0": 0, "3": 3, '"Adult"': 1, '"1"': 2, "null": None, None: None, "true": 1, '""': 2}
    assert apply(spark, json_label, cases) == list(cases.values())


def test_bronze_label_quirks(spark):
    rows = [(0, "", "Adult"), (1, "", ""), (2, "", None), (3, "Safe", "Adult"), (4, None, "safe")]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = df.select("i", bronze_label(F.col("a"), F.col("b")).alias("x"),
                    bronze_label(F.col("a"), F.col("b"), False).alias("y")).orderBy("i").collect()
    assert [(r["x"], r["y"]) for r in got] == [(1, 1), (2, None), (None, None), (0, 0), (0, 0)]


def test_kappa_band(spark):
    cases = {-0.1: "poor", 0.0: "slight", 0.2: "slight", 0.21: "fair", 0.6: "moderate",
             0.8: "substantial", 0.81: "almost perfect", None: None}
    assert apply(spark, labels.kappa_band, cases, "double") == list(cases.values())


def test_ids(spark):
    urls = ["https://s/@a/video/12?x=1", "https://s/video/12/video/13", "none?q"]
    assert apply(spark, ids.id_from_url, urls) == ["12", "13", "none"]
    paths = ["s://b/bronze/v1/video.mp4", "bronze/v1/video.mp4", "a/b"]
    assert apply(spark, ids.segment_id, paths) == ["v1", None, None]
    assert apply(spark, ids.layer_id, paths) == ["v1", "v1", None]
    files = ["a/b/Clip One.MP4", "x.tar.gz", ".mp4", "none"]
    assert apply(spark, ids.extension, files) == [".mp4", ".gz", "", ""]
    assert apply(spark, ids.stem, files) == ["Clip One", "x.tar", ".mp4", "none"]


def test_numbered_id_keeps_long_numbers(spark):
    got = apply(spark, lambda c: ids.numbered_id(F.lit("train"), F.lit("safe"), c), [1, 12345678], "long")
    assert got == ["train_safe_000001", "train_safe_12345678"]


def test_vectors(spark):
    probs = apply(spark, vectors.softmax, [[1.0, 1.0], [1000.0, 0.0]], "array<double>")
    assert probs[0] == pytest.approx([0.5, 0.5]) and probs[1] == pytest.approx([1.0, 0.0])
    assert apply(spark, lambda c: vectors.pad(c, 3), [[1.0], [1.0, 2.0, 3.0, 4.0]], "array<float>") == [
        [1.0, 0.0, 0.0], [1.0, 2.0, 3.0, 4.0]]
    assert apply(spark, lambda c: vectors.zero_fill(c, 2), [None, [1.0, 2.0]], "array<float>") == [[0.0, 0.0], [1.0, 2.0]]
    assert apply(spark, lambda c: vectors.select_dims(c, (0, 2)), [[1.0, 2.0, 3.0, 4.0]], "array<double>") == [[2.0, 4.0]]
    top = apply(spark, lambda c: vectors.top_class(c, ("Safe", "Harmful")), [[0.2, 0.8], [0.1, 0.2, 0.7]], "array<double>")
    assert [tuple(t) for t in top] == [(1, 0.8, "Harmful"), (2, 0.7, "Unknown")]
    both = apply(spark, vectors.collapse_multiclass, [[0.6, 0.4], [0.3, 0.7]], "array<double>")
    assert [b["pred"] for b in both] == [0, 1] and both[0]["prob"] == pytest.approx(0.4)
    assert apply(spark, lambda c: vectors.prob_map(c, ("Safe",)), [[0.9, 0.1]], "array<double>") == [{"Safe": 0.9, "1": 0.1}]


TREE = "array<struct<text:string,replies:array<struct<text:string>>>>"


def test_flatten_comments(spark):
    tree = [("a", [("b",), ("",)]), ("", [("c",)]), ("d", None)]
    assert apply(spark, comments.flatten_comments, [tree, []], TREE) == [["a", "b", "c", "d"], []]


def test_comment_stats(spark):
    got = apply(spark, comments.comment_stats, [[], ["hi 😂", "a b c?"]], "array<string>")
    assert tuple(got[0]) == (0.0,) * 5
    assert tuple(got[1]) == (2.0, 5.0, 2.5, 0.5, 0.5)


def test_comment_flags(spark):
    rule = comments.has_word(("hate",))
    got = apply(spark, lambda c: comments.comment_flags(c, rule, "x"),
                [["I HATE it", "", "whatever", "éhate"], ["  "]], "array<string>")
    assert got[0]["n_x_comments"] == 1.0 and got[0]["frac_x_comments"] == pytest.approx(1 / 3)
    assert tuple(got[1]) == (0.0, 0.0)
