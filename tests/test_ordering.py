"""Ranking, sampling and comment trees against brute force, with one key holding a third of the rows."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clipsift.operators import comments, ordering, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 31 == 0 else f"k{rng.randrange(40)}")
        rows.append((key, rng.randrange(500), i, rng.randrange(5)))
    return rows, spark.createDataFrame(rows, "k string, t int, id int, w long").repartition(5)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("bucket", [None, "floor(t / 10)"])
def test_running_totals(spark, skewed, bucket, threshold):
    rows, df = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    expr = F.expr(bucket) if bucket else None
    got = ordering.running_totals(
        df, ["k"], ["t", "id"], {"w_sum": F.col("w"), "n": F.lit(1).cast("long")}, totals={"n": "all"}, bucket=expr
    ).collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    expected = {}
    for key, members in groups.items():
        total = 0
        for n, (_, t, i, w) in enumerate(sorted(members, key=lambda r: (r[1], r[2])), 1):
            total += w
            expected[i] = (key, total, n, len(members))
    assert {r["id"]: (r["k"], r["w_sum"], r["n"], r["all"]) for r in got} == expected
    assert len(got) == len(rows)


def test_rows_without_order_value_are_kept(spark):
    df = spark.createDataFrame([("a", None), ("a", 3), ("a", 25), (None, None)], "k string, t int")
    got = ordering.numbered(df, ["k"], ["t"], bucket=F.floor(F.col("t") / 10)).collect()
    assert sorted(((r["k"] or "", r["t"] or 0, r["rn"]) for r in got)) == [("", 0, 1), ("a", 0, 1), ("a", 3, 2), ("a", 25, 3)]


def test_numbered_without_keys_descending(skewed):
    rows, df = skewed
    got = ordering.numbered(df, [], [F.col("t").desc(), "id"]).collect()
    ranked = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert {r["id"]: r["rn"] for r in got} == {r[2]: n for n, r in enumerate(ranked, 1)}


@pytest.mark.parametrize("limit", ["1000", "2"])
def test_first_per_key(spark, skewed, limit):
    rows, df = skewed
    spark.conf.set(ordering.LIMIT_KEY, limit)
    try:
        got = ordering.first_per_key(df, ["k"], ["t", "id"], 4).collect()
    finally:
        spark.conf.unset(ordering.LIMIT_KEY)
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    expected = {
        r[2]: n for g in groups.values() for n, r in enumerate(sorted(g, key=lambda r: (r[1], r[2]))[:4], 1)
    }
    assert {r["id"]: r["rn"] for r in got} == expected


@pytest.mark.parametrize("ratio", [0.0, 0.3, 0.8, 0.9, 1.0])
@pytest.mark.parametrize("digits", [1, 5])
def test_split_is_exact(spark, ratio, digits):
    ids = list(range(101))
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)
    got = {r["id"]: r["split"] for r in sampling.split(df, ratio, "id", seed=7, digits=digits).collect()}
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}:7".encode()).hexdigest(), i))
    train = set(order[: int(len(ids) * ratio)])
    assert got == {i: "train" if i in train else "val" for i in ids}


@pytest.mark.parametrize("k", [1, 2, 4, 16, 500])
def test_uniform_sample(skewed, k):
    rows, df = skewed
    got = defaultdict(dict)
    for r in sampling.uniform_sample(df, ["k"], ["t", "id"], k, bucket=F.floor(F.col("t") / 7)).collect():
        got[r["k"]][r["sample_no"]] = r["id"]
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    for key, members in groups.items():
        members.sort(key=lambda r: (r[1], r[2]))
        n = len(members)
        want = [members[(i * (n - 1)) // (k - 1) if k > 1 else 0][2] for i in range(k)]
        assert [got[key][i] for i in range(k)] == want


def test_uniform_sample_literals(spark):
    def picked(n, k):
        df = spark.range(n).withColumn("g", F.lit(1))
        rows = sampling.uniform_sample(df, ["g"], ["id"], k).orderBy("sample_no").collect()
        return [r["id"] for r in rows]

    assert picked(10, 4) == [0, 3, 6, 9]
    assert picked(2, 4) == [0, 0, 0, 1]
    assert picked(1, 3) == [0, 0, 0]


def test_first_k_rejects_short_keys(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "g string, t int")
    got = sampling.first_k(df, ["g"], ["t"], 3).collect()
    assert sorted((r["g"], r["t"], r["frame_no"]) for r in got) == [("a", 0, 1), ("a", 1, 2), ("a", 2, 3)]


def test_chunk(spark):
    df = spark.range(10).repartition(3)
    got = {r["id"]: r["batch"] for r in ordering.chunk(df, 3, ["id"], start=1, max_rows=8).collect()}
    assert got == {3: 1, 4: 1, 5: 1, 6: 2, 7: 2}


def test_dedup_and_duplicates(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("a", 2), ("a", 9), (None, 5), (None, 4)], "v string, pos int")
    first = {r["v"]: r["pos"] for r in ordering.dedup_first(df, "v", "pos").collect()}
    assert first == {"a": 2, "b": 1, None: 4}
    extra = {r["v"]: r["n_extra"] for r in ordering.duplicate_report(df, "v").collect()}
    assert extra == {"a": 2, None: 1}


@pytest.mark.parametrize("n", [0, 2])
def test_cap_per_source(spark, n):
    rows = [("s1", "a", 1), ("s1", "a", 2), ("s1", "b", 3), ("s1", "c", 4), ("s2", "a", 5), ("s2", "d", 6), ("s2", "e", 7)]
    df = spark.createDataFrame(rows, "source string, ident string, pos int")
    seen = spark.createDataFrame([("b",)], "ident string")
    got = {r["ident"]: (r["source"], r["rank_in_source"]) for r in
           ordering.cap_per_source(df, "source", "ident", "pos", n, seen).collect()}
    want = {"a": ("s1", 1), "d": ("s2", 2)}
    if n == 0:
        want |= {"c": ("s1", 3), "e": ("s2", 3)}
    assert got == want


def brute_tree(nodes, max_total, max_replies):
    tree, total = [], 0
    for _, level, body in sorted(nodes):
        body = body.strip()
        if total >= max_total:
            break
        if not body:
            continue
        if level == 1:
            tree.append((body, []))
            total += 1
        elif tree and len(tree[-1][1]) < max_replies:
            tree[-1][1].append(body)
            total += 1
    return tree


@pytest.mark.parametrize("max_total,max_replies,span", [(3, 1, 2), (10, 2, 5), (200, 15, 64), (7, 0, 3)])
def test_comment_tree(spark, max_total, max_replies, span):
    rng = random.Random(max_total)
    rows, nodes = [], defaultdict(list)
    for key, size in (("hot", 120), ("a", 30), ("b", 1), ("c", 12)):
        for pos in range(size):
            node = (pos, 1 if rng.random() < 0.3 else 2, rng.choice(["x", " ", "yy ", "z"]) + str(pos % 3) * (pos % 2))
            nodes[key].append(node)
            rows.append((key, *node))
    rows += [("only_replies", 0, 2, "r")]
    df = spark.createDataFrame(rows, "video_id string, pos long, level int, text string").repartition(4)
    kept = comments.build_comment_tree(df, max_total=max_total, max_replies=max_replies, span=span)
    trees = comments.nest_comment_tree(kept).collect()
    got = {r["video_id"]: [(c["text"], [x["text"] for x in c["replies"]]) for c in r["comments_tree"]] for r in trees}
    want = {k: brute_tree(v, max_total, max_replies) for k, v in nodes.items()}
    assert got == {k: v for k, v in want.items() if v}


def test_comment_tree_literal(spark):
    rows = [("v", i, lv, t) for i, (lv, t) in enumerate([(2, "lost"), (1, "r1"), (2, "x"), (2, "y"), (1, "r2")])]
    df = spark.createDataFrame(rows, "video_id string, pos long, level int, text string")
    kept = comments.build_comment_tree(df, max_total=3, max_replies=1)
    tree = comments.nest_comment_tree(kept).first()["comments_tree"]
    assert [(c["text"], [r["text"] for r in c["replies"]]) for c in tree] == [("r1", ["x"]), ("r2", [])]


def test_row_and_array_statistics_agree(spark, skewed):
    from clipsift.functions.comments import STAT_FIELDS, comment_stats

    rows = [("a", "hi 😂"), ("a", "a b c?"), ("b", ""), ("b", "?😂 x")]
    df = spark.createDataFrame(rows, "k string, text string")
    by_row = {r["k"]: tuple(r[f] for f in STAT_FIELDS) for r in comments.comment_stats_by(df, "k").collect()}
    arrays = df.groupBy("k").agg(F.collect_list("text").alias("c")).select("k", comment_stats(F.col("c")).alias("s"))
    assert by_row == {r["k"]: tuple(r["s"]) for r in arrays.collect()}


def test_tree_without_limits_keeps_every_comment(spark):
    rows = [("v", i, 1 if i % 40 == 0 else 2, f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "video_id string, pos long, level int, text string")
    kept = comments.build_comment_tree(df, span=64)
    assert kept.count() == 1000
    tree = comments.nest_comment_tree(kept).first()["comments_tree"]
    assert [len(c["replies"]) for c in tree] == [39] * 25
    capped = comments.build_comment_tree(df, max_total=200, max_replies=15, span=64)
    assert capped.count() == 200
