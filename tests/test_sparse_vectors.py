"""Text vectors that stay sparse in a table, against the arrays of floats."""

import pytest
from pyspark.sql import functions as F

from clipsift.operators import models
from clipsift.plans import jobs
from clipsift.plans.queries.composite import digests
from clipsift.session import scratch_path
from clipsift.sources import readers

POST = "video_id string, likes string, comments int, shares string, bookmarks string, views string, date string, description string, tags array<string>, comment_texts array<string>"
TEXTS = [("one two one", ["#x", "y"], ["so", "what"]), ("", None, None), (None, ["#x", "y"], ["so", "what"]), ("  ", [], ["what so"]), ("one", ["z"], [])]


def posts(spark):
    rows = [(f"v{i}" if i else None, str(10 ** i), 1, "2", "3", "4K", "8-9", *t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, POST).repartition(2)


def test_sparse_and_dense_vectors_hold_the_same_floats(spark):
    texts = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TEXTS)], "i int, t string")
    kept = models.encode_text(texts, "t", 64, sparse=True).select("i", models.dense(F.col("emb")).alias("emb"))
    assert {r["i"]: r["emb"] for r in kept.collect()} == {r["i"]: r["emb"] for r in models.encode_text(texts, "t", 64).collect()}
    with pytest.raises(ValueError):
        models.encode_text(texts, "t", 64, encoder=len, sparse=True)


def test_stored_features_hold_words_and_not_zeros(spark):
    names = ("desc_emb", "tags_emb", "comments_emb")
    path = scratch_path(spark, "silver")
    jobs.metadata_features(posts(spark), 4096, sparse=True).write.parquet(path)
    arrays = {r["numeric_raw"][0]: r for r in jobs.metadata_features(posts(spark), 4096).collect()}
    stored = spark.read.parquet(path).withColumns({n: models.dense(F.col(n)) for n in names}).collect()
    assert len(stored) == len(arrays) == 5
    assert all(r == arrays[r["numeric_raw"][0]] for r in stored)
    sizes = readers.read_vectors(spark, path).agg(*[F.sum(F.size(f"{n}.values")).alias(n) for n in names]).first()
    assert sizes.asDict() == {"desc_emb": 3, "tags_emb": 5, "comments_emb": 8}  # [SEP] is a word


def test_digests_tell_which_vectors_are_alike(spark):
    path = scratch_path(spark, "silver")
    jobs.metadata_features(posts(spark), 4096, sparse=True).write.parquet(path)
    got = {r["raw_likes_log"]: r for r in digests(spark, path).collect()}
    found = [got[k] for k in sorted(got)]
    assert [r["video_id"] for r in found] == [None, "v1", "v2", "v3", "v4"]
    assert [r["desc_norm"] for r in found] == [1.0, 0.0, 0.0, 0.0, 1.0] and [r["comments_norm"] for r in found] == [1.0, 0.0, 1.0, 1.0, 0.0]
    assert [r["alike_comments"] for r in found] == [2, 2, 2, 1, 2]
    assert [r["first_alike_tags"] for r in found] == ["v2", "v1", "v2", "v1", "v4"]
