"""Comment features from rows against the array functions, and posts with very many comments."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from clipsift.functions import text
from clipsift.functions.comments import flatten_comments
from clipsift.operators import comments
from clipsift.operators.features import numeric_vector
from clipsift.operators.joins import NUMERIC_FEATURES
from clipsift.plans import jobs

POST = "video_id string, likes string, comments int, shares string, bookmarks string, views string, date string"
SAID = {"a": ["I hate this 😂", "why?", " so  so ", "😢"], "b": ["please agree"], "c": [], None: ["lost"]}


def tables(spark):
    keys = ["a", "b", "c", "a", None]
    posts = spark.createDataFrame([(k, str(10 ** i), 1, "2", "3", "4K", "8-9") for i, k in enumerate(keys)], POST)
    rows = [(k, i, t) for k, own in SAID.items() for i, t in enumerate(own)]
    return posts, spark.createDataFrame(rows, "video_id string, pos long, text string").repartition(3)


def arrays(posts):
    pairs = [F.when(F.col("video_id") == k, F.array(*map(F.lit, v)).cast("array<string>")) for k, v in SAID.items() if k]
    return posts.withColumn("comment_texts", F.coalesce(*pairs))


def test_vector_from_rows_and_arrays(spark):
    posts, rows = tables(spark)
    for mode in ("normalized", "raw"):
        from_rows = numeric_vector(posts, emoji_stats_on=mode, comments=rows).collect()
        from_arrays = numeric_vector(arrays(posts), emoji_stats_on=mode).collect()
        assert len(from_rows) == 5
        shown = [sorted((r["likes"], r["video_id"], *(round(r[n], 9) for n in NUMERIC_FEATURES)) for r in x) for x in (from_rows, from_arrays)]
        assert shown[0] == shown[1]


def test_metadata_features_from_rows_and_arrays(spark):
    posts, rows = tables(spark)
    more = {"description": F.lit("d e"), "tags": F.array(F.lit("#t"))}
    one = jobs.metadata_features(posts.withColumns(more), 64, comments=rows).collect()
    two = jobs.metadata_features(arrays(posts).withColumns(more), 64).collect()

    def shown(found):
        return sorted((str(r["video_id"]), [round(x, 6) for x in r["numeric_raw"]], r["comments_emb"], r["desc_emb"], r["tags_emb"]) for r in found)

    assert shown(one) == shown(two) and len(one) == 5


def test_joined_text_in_pieces(spark):
    own = {k: [f" {k}{i}  x" if i % 5 else "  " for i in range(n)] for k, n in (("hot", 500), ("b", 1), ("c", 7))}
    rows = spark.createDataFrame([(k, i, t) for k, v in own.items() for i, t in enumerate(v)], "k string, pos long, text string").repartition(5)
    clean = {k: [" ".join(t.split()) for t in v] for k, v in own.items()}
    for span in (1, 16, 4096):
        got = {r.k: r.joined for r in comments.joined_text_by(rows, "k", span=span).collect()}
        assert got == {k: text.SEPARATOR.join(v) for k, v in clean.items()}
        got = {r.k: r.said for r in comments.joined_text_by(rows, "k", sep=" ", out="said", blanks=False, span=span).collect()}
        assert got == {k: " ".join(t for t in v if t) for k, v in clean.items() if any(v)}
    assert comments.joined_text_by(rows.limit(0), "k").collect() == []


def test_flattened_rows_follow_the_tree(spark):
    rows = [("v", i, 1 if i % 7 in (0, 3) else 2, f"t{i}") for i in range(200)] + [("w", 5, 1, "r"), (None, 0, 1, "n")]
    nodes = comments.build_comment_tree(spark.createDataFrame(rows, "video_id string, pos long, level int, text string"))
    trees = comments.nest_comment_tree(nodes).select("video_id", F.posexplode(flatten_comments(F.col("comments_tree"))).alias("idx", "text"))
    got = comments.flatten_comment_rows(nodes, span=16)
    assert sorted(map(str, got.collect())) == sorted(map(str, trees.withColumn("idx", F.col("idx").cast("long")).collect()))


def test_hot_post(spark):
    """300,000 comments of one post: aggregated where they are, never collected."""
    rows = spark.range(300_000, numPartitions=8).select(
        F.lit("hot").alias("video_id"), F.col("id").alias("pos"), F.lit(1).alias("level"),
        F.when(F.col("id") % 4 == 0, "I hate it?").otherwise("fine words").alias("text"),
    )
    post = spark.createDataFrame([("hot", "1", 1, "1", "1", "1", None)], POST)
    found = numeric_vector(post, comments=comments.build_comment_tree(rows)).first()
    assert found["n_comments"] == 300_000 and found["frac_toxic_comments"] == 0.25 == found["frac_has_question"]


def test_numbers_collect_no_comments(spark, sf_dir):
    plan = entry.queries()["q_numeric_vector"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
