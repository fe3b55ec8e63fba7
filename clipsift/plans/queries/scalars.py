"""Column functions: counts, dates, texts, labels, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipsift.functions import comments, counts, dates, ids, labels, text, vectors
from clipsift.operators import aggregates, comments as trees, features, scaling
from clipsift.operators.joins import NUMERIC_FEATURES
from clipsift.operators.metrics import cohen_kappa
from clipsift.plans import sqltext as S
from clipsift.plans import standins as V
from clipsift.plans.registry import query
from clipsift.tables import load

COUNTS = ("likes", "comments", "shares", "bookmarks", "views")
_counted = ", ".join(f"{S.count(c)} AS {c}" for c in COUNTS)


def _r(c, digits=6):
    return F.round(c, digits)


def near(c, digits=6):
    """Nearest value with that many decimals, in plain arithmetic (cheaper than ``round``)."""
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(10.0**digits)
    return F.floor(c * scale + F.lit(0.5)) / scale


@query(f"SELECT video_id, {_counted} FROM {V.POSTS.sql}")
def q_parse_count(spark, sf):
    df = V.POSTS.df(spark, sf)
    return df.select("video_id", *[counts.parse_count(F.col(c)).alias(c) for c in COUNTS])


@query(
    f"SELECT c_custkey, ROUND({S.log1p('c_acctbal')}, 6) AS log_bal, "
    f"ROUND({S.log1p('CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END')}, 6) AS log_gap "
    "FROM customer"
)
def q_safe_log1p(spark, sf):
    gap = F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal"))
    return load(spark, sf, "customer").select(
        "c_custkey",
        _r(counts.safe_log1p(F.col("c_acctbal"))).alias("log_bal"),
        _r(counts.safe_log1p(gap)).alias("log_gap"),
    )


def _engagement_sql(prefix: str = "") -> dict[str, str]:
    out = {f"{k}_log": S.log1p(k) for k in COUNTS}
    out |= {f"{k[:-1]}_rate": S.ratio(k, "views") for k in COUNTS[:4]}
    total = " + ".join(f"coalesce({k}, 0e0)" for k in COUNTS[:4])
    out["engagement_rate"] = S.ratio(f"({total})", "views")
    out["has_views"] = "CASE WHEN views IS NULL THEN 0e0 ELSE 1e0 END"
    out["has_bookmarks"] = "CASE WHEN bookmarks IS NULL THEN 0e0 ELSE 1e0 END"
    return out


_engaged = ", ".join(f"{S.near(e, 6)} AS {n}" for n, e in _engagement_sql().items())


@query(f"SELECT video_id, {_engaged} FROM (SELECT video_id, {_counted} FROM {V.POSTS.sql})")
def q_engagement_rates(spark, sf):
    df = V.POSTS.df(spark, sf)
    parsed = df.select("video_id", *[counts.parse_count(F.col(c)).alias(c) for c in COUNTS])
    found = counts.engagement_features({c: F.col(c) for c in COUNTS})
    return parsed.select("video_id", *[near(c).alias(n) for n, c in found.items()])


_valid, _month, _day = S.month_day("date")


@query(
    f"SELECT video_id, CASE WHEN {_valid} THEN {_month} END AS month, "
    f"CASE WHEN {_valid} THEN {_day} END AS day FROM {V.POSTS.sql}"
)
def q_parse_mm_dd(spark, sf):
    md = dates.parse_mm_dd(F.col("date"))
    return V.POSTS.df(spark, sf).select(
        "video_id", md["month"].alias("month"), md["day"].alias("day")
    )


def _date_sql(d: str = "d", m: str = "m") -> dict[str, str]:
    known = f"CASE WHEN {d} IS NULL THEN 0e0 ELSE "
    return {
        "age_days": known + f"greatest(date_diff('day', {d}, DATE '2025-12-05'), 0)::DOUBLE END",
        "month_sin": known + f"sin(2 * pi() * {m} / 12) END",
        "month_cos": known + f"cos(2 * pi() * {m} / 12) END",
        "has_date": known + "1e0 END",
    }


_dated = ", ".join(f"{S.near(e, 6)} AS {n}" for n, e in _date_sql().items())


@query(
    f"SELECT video_id, {_dated} FROM (SELECT video_id, {S.date_of('date', 2025)} AS d, "
    f"{_month} AS m FROM {V.POSTS.sql})"
)
def q_date_features(spark, sf):
    parsed = V.POSTS.df(spark, sf).select("video_id", dates.parse_mm_dd(F.col("date")).alias("md"))
    found = dates.date_features_of(F.col("md"), features.REFERENCE_DATE, features.ASSUMED_YEAR)
    return parsed.withColumn("d", found).select(
        "video_id", *[near(f"d.{n}").alias(n) for n in dates.DATE_FIELDS]
    )


def _captions(spark, sf):
    return V.CAPTIONS.df(spark, sf)


@query(f"SELECT doc_id, {S.emojis('text')} AS text FROM {V.CAPTIONS.sql}")
def q_map_emojis(spark, sf):
    return _captions(spark, sf).select("doc_id", text.map_emojis(F.col("text")).alias("text"))


@query(rf"SELECT doc_id, regexp_replace(text, '#\S+', '', 'g') AS text FROM {V.CAPTIONS.sql}")
def q_strip_hashtags(spark, sf):
    return _captions(spark, sf).select("doc_id", text.strip_hashtags(F.col("text")).alias("text"))


@query(f"SELECT doc_id, {S.blanks('text')} AS text FROM {V.CAPTIONS.sql}")
def q_normalize_ws(spark, sf):
    clean = text.normalize_whitespace(F.col("text"))
    return _captions(spark, sf).select("doc_id", clean.alias("text"))


@query(f"SELECT doc_id, {S.clean('text')} AS text FROM {V.CAPTIONS.sql}")
def q_normalize_text(spark, sf):
    return _captions(spark, sf).select("doc_id", text.normalize_text(F.col("text")).alias("text"))


@query(
    "SELECT doc_id, array_to_string(list_transform(string_split(tags, ' '), "
    f"lambda t: ltrim(t, '#')), ' ') AS tag_text FROM {V.CAPTIONS.sql}"
)
def q_tag_text(spark, sf):
    return _captions(spark, sf).select(
        "doc_id", text.tag_text(F.split("tags", " ")).alias("tag_text")
    )


_shown = f"(SELECT video_id, pos, level, trim(text) AS text FROM {V.COMMENTS.sql} WHERE trim(text) <> '')"


def tree_sql(max_replies: int | None = None, max_total: int | None = None) -> str:
    """Accepted comment nodes, step by step."""
    few = "" if max_replies is None else f"WHERE level = 1 OR r <= {max_replies}"
    first = "" if max_total is None else f"WHERE t <= {max_total}"
    return f"""(
      WITH shown AS {_shown},
      rooted AS (SELECT *, sum(CASE WHEN level = 1 THEN 1 ELSE 0 END)
                   OVER (PARTITION BY video_id ORDER BY pos) AS root_no FROM shown),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY video_id, root_no, level
                   ORDER BY pos) AS r FROM rooted WHERE root_no > 0),
      kept AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY pos) AS t
                 FROM ranked {few})
      SELECT video_id, pos, CAST(root_no AS BIGINT) AS root_no, level, text FROM kept {first})"""


@query(
    f"SELECT video_id, string_agg({S.clean('text')}, ' [SEP] ' ORDER BY pos) AS joined "
    f"FROM {tree_sql()} GROUP BY video_id"
)
def q_join_comments(spark, sf):
    return trees.joined_text_by(trees.build_comment_tree(V.COMMENTS.df(spark, sf)), "video_id")


@query("SELECT doc_id, substring(text, 1, 600) AS text FROM documents")
def q_truncate_text(spark, sf):
    return load(spark, sf, "documents").select("doc_id", text.truncate(F.col("text")).alias("text"))


def _label_case(x: str = "label") -> str:
    t = f"lower(trim({x}))"
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {t} = 'safe' THEN 0 "
        f"WHEN {t} IN ('adult', 'adult content', 'adult-content') THEN 1 "
        f"WHEN {t} IN ('suicide', 'self-harm', 'self harm', 'suicidal') THEN 3 ELSE 2 END"
    )


@query(f"SELECT p_partkey, {_label_case()} AS label_id FROM {V.LABEL_TEXTS.sql}")
def q_map_label(spark, sf):
    return V.LABEL_TEXTS.df(spark, sf).select(
        "p_partkey", labels.map_label(F.col("label")).alias("label_id")
    )


@query(
    "SELECT vec_id, label, CASE WHEN label = 2 THEN 1 ELSE 0 END AS finetune, "
    "CASE WHEN label > 0 THEN 1 ELSE 0 END AS binary_label FROM embeddings"
)
def q_label_remaps(spark, sf):
    label = F.col("label")
    return load(spark, sf, "embeddings").select(
        "vec_id", "label",
        labels.finetune_label(label).alias("finetune"),
        labels.binary_label(label).alias("binary_label"),
    )


def _soft_sql(n: int = 4) -> str:
    raised = [f"exp(embedding[{i}]::DOUBLE - m)" for i in range(1, n + 1)]
    shares = ", ".join(f"{e} / ({' + '.join(raised)}) AS p{i}" for i, e in enumerate(raised))
    return (
        f"(SELECT vec_id, {shares} FROM (SELECT vec_id, embedding, "
        f"list_max(embedding[1:{n}])::DOUBLE AS m FROM embeddings))"
    )


def _probs(spark, sf, n=4):
    df = load(spark, sf, "embeddings")
    return df.select("vec_id", vectors.softmax(F.slice("embedding", 1, n)).alias("probs"))


_argmax = (
    "CASE greatest(p0, p1, p2, p3) WHEN p0 THEN 0 WHEN p1 THEN 1 WHEN p2 THEN 2 ELSE 3 END"
)


@query(
    "SELECT vec_id, ROUND(p0, 6) AS p0, ROUND(p1, 6) AS p1, ROUND(p2, 6) AS p2, "
    f"ROUND(p3, 6) AS p3 FROM {_soft_sql()}"
)
def q_softmax(spark, sf):
    return _probs(spark, sf).select(
        "vec_id", *[_r(F.col("probs")[i]).alias(f"p{i}") for i in range(4)]
    )


@query(
    "SELECT vec_id, ROUND(1 - p0, 6) AS prob, "
    f"CASE WHEN ({_argmax}) <> 0 THEN 1 ELSE 0 END AS pred FROM {_soft_sql()}"
)
def q_collapse_multiclass(spark, sf):
    both = vectors.collapse_multiclass(F.col("probs"))
    return _probs(spark, sf).withColumn("b", both).select(
        "vec_id", _r("b.prob").alias("prob"), F.col("b.pred").alias("pred")
    )


@query(
    "SELECT vec_id, unnest(['Safe', 'Harmful', '2', '3']) AS name, "
    f"ROUND(unnest([p0, p1, p2, p3]), 6) AS prob FROM {_soft_sql()}"
)
def q_prob_map(spark, sf):
    mapped = vectors.prob_map(F.col("probs"), labels.SERVING_NAMES)
    return _probs(spark, sf).select("vec_id", F.explode(mapped).alias("name", "prob")).select(
        "vec_id", "name", _r("prob").alias("prob")
    )


@query(
    f"SELECT vec_id, {_argmax} AS label_id, ROUND(greatest(p0, p1, p2, p3), 6) AS confidence, "
    f"CASE {_argmax} WHEN 0 THEN 'Safe' WHEN 1 THEN 'Harmful' ELSE 'Unknown' END AS label "
    f"FROM {_soft_sql()}"
)
def q_top_class(spark, sf):
    top = vectors.top_class(F.col("probs"), labels.SERVING_NAMES)
    return _probs(spark, sf).withColumn("t", top).select(
        "vec_id", "t.label_id", _r("t.confidence").alias("confidence"), "t.label"
    )


SCALED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(avg({c}), 4) AS mean, ROUND(CASE WHEN stddev_pop({c}) > 0 "
        f"THEN stddev_pop({c}) ELSE 1 END, 4) AS std FROM lineitem"
        for c in SCALED
    )
)
def q_scaler_fit(spark, sf):
    fitted = scaling.fit_scaler(load(spark, sf, "lineitem"), SCALED).long()
    return fitted.select("feature", _r("mean", 4).alias("mean"), _r("std", 4).alias("std"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(f"{S.near(f'({c} - m_{c}) / s_{c}', 4)} AS {c}" for c in SCALED)
    + " FROM lineitem, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)
    + " FROM lineitem)"
)
def q_scale_transform(spark, sf):
    df = load(spark, sf, "lineitem")
    scaled = scaling.fit_scaler(df, SCALED).transform(df)
    return scaled.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[near(c, 4).alias(c) for c in SCALED]
    )


@query(
    "SELECT vec_id, CAST(len(k) AS INTEGER) AS width, ROUND(list_sum(k), 4) AS total, "
    "ROUND(k[17]::DOUBLE, 6) AS seventeenth FROM (SELECT vec_id, "
    "list_concat(list_concat(embedding[1:16], embedding[18:21]), "
    "list_concat(embedding[23:23], embedding[25:25]))::DOUBLE[] AS k FROM embeddings)"
)
def q_vector_select(spark, sf):
    first = F.slice("embedding", 1, 25)
    kept = vectors.as_doubles(vectors.select_dims(first, (16, 21, 23)))
    return load(spark, sf, "embeddings").withColumn("k", kept).select(
        "vec_id", F.size("k").alias("width"), _r(vectors.total(F.col("k")), 4).alias("total"),
        _r(F.get("k", F.lit(16))).alias("seventeenth"),
    )


@query(
    "SELECT vec_id, unnest(range(80)) AS i, ROUND(unnest(list_concat(list_concat("
    "embedding[1:32], embedding[33:64]), embedding[1:16]))::DOUBLE, 6) AS x FROM embeddings"
)
def q_fused_vector(spark, sf):
    fused = vectors.fuse(
        F.slice("embedding", 1, 32), F.slice("embedding", 33, 32), F.slice("embedding", 1, 16)
    )
    return load(spark, sf, "embeddings").select("vec_id", F.posexplode(fused).alias("i", "x")).select(
        "vec_id", F.col("i").cast("long").alias("i"), _r(F.col("x").cast("double")).alias("x")
    )


@query(
    "SELECT vec_id, unnest(range(22)) AS i, ROUND(unnest(list_resize(embedding[1:6], 22, 0))::DOUBLE, 6) AS x "
    "FROM embeddings"
)
def q_pad_vector(spark, sf):
    padded = vectors.pad(F.slice("embedding", 1, 6), 22)
    return load(spark, sf, "embeddings").select("vec_id", F.posexplode(padded).alias("i", "x")).select(
        "vec_id", F.col("i").cast("long").alias("i"), _r(F.col("x").cast("double")).alias("x")
    )


@query(
    "SELECT doc_id, CAST(coalesce(len(embedding), 64) AS INTEGER) AS width, "
    "ROUND(coalesce(list_sum(embedding::DOUBLE[]), 0), 4) AS total, embedding IS NULL AS filled "
    "FROM documents LEFT JOIN embeddings ON doc_id = vec_id"
)
def q_zero_fill_embedding(spark, sf):
    emb = load(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id")
    joined = load(spark, sf, "documents").select("doc_id").join(emb, "doc_id", "left")
    full = vectors.zero_fill(F.col("embedding"), 64)
    return joined.select(
        "doc_id",
        F.size(full).alias("width"),
        _r(vectors.total(vectors.as_doubles(full)), 4).alias("total"),
        F.col("embedding").isNull().alias("filled"),
    )


@query(
    "SELECT label, i, ROUND(sum(x * m) / greatest(sum(m), 1e-5), 6) AS x FROM (SELECT label, "
    "CASE WHEN vec_id % 3 = 0 OR label = 9 THEN 0e0 ELSE 1e0 END AS m, unnest(range(64)) AS i, "
    "unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY label, i"
)
def q_mean_pool(spark, sf):
    masked = (F.col("vec_id") % 3 == 0) | (F.col("label") == 9)
    df = load(spark, sf, "embeddings").withColumn("m", F.when(masked, 0.0).otherwise(1.0))
    pooled = aggregates.mean_pool(df, "label", "embedding", "m")
    return pooled.select("label", F.posexplode("embedding").alias("i", "x")).select(
        "label", F.col("i").cast("long").alias("i"), (_r("x") + 0.0).alias("x")
    )


@query(
    "SELECT video_id, ROUND(greatest(epoch_us(ingested_at) / 1e6 - timestamp, 0.001), 5) AS e2e, "
    f"processing_time AS inference FROM {V.PREDICTIONS.sql}"
)
def q_e2e_latency(spark, sf):
    timed = aggregates.with_latency(V.PREDICTIONS.df(spark, sf))
    return timed.select(
        "video_id", _r("e2e_latency_sec", 5).alias("e2e"),
        F.col("inference_latency_ms").alias("inference"),
    )


KAPPA_SQL = """
  WITH y AS (SELECT source, quality AS a, 1 - toxic AS b FROM labels JOIN documents USING (doc_id)),
  n AS (SELECT source, count(*)::DOUBLE AS n, avg(CASE WHEN a = b THEN 1e0 ELSE 0e0 END) AS po
        FROM y GROUP BY source),
  r AS (SELECT source, a AS k, count(*) AS c FROM y GROUP BY source, a),
  s AS (SELECT source, b AS k, count(*) AS c FROM y GROUP BY source, b),
  e AS (SELECT source, sum(r.c * s.c)::DOUBLE AS rs FROM r JOIN s USING (source, k) GROUP BY source),
  k AS (SELECT source, po, coalesce(rs, 0) / (n * n) AS pe FROM n LEFT JOIN e USING (source)),
  f AS (SELECT source, CASE WHEN pe <> 1 THEN (po - pe) / (1 - pe) END AS kappa FROM k)
  SELECT source, ROUND(kappa, 6) AS kappa,
    CASE WHEN kappa IS NULL THEN NULL WHEN kappa < 0 THEN 'poor' WHEN kappa <= 0.2 THEN 'slight'
      WHEN kappa <= 0.4 THEN 'fair' WHEN kappa <= 0.6 THEN 'moderate'
      WHEN kappa <= 0.8 THEN 'substantial' ELSE 'almost perfect' END AS band
  FROM f"""


@query(KAPPA_SQL)
def q_kappa_band(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "source")
    y = load(spark, sf, "labels").join(docs, "doc_id").select(
        "source", F.col("quality").alias("y1"), (1 - F.col("toxic")).alias("y2")
    )
    kappa = cohen_kappa(y, keys=["source"])
    return kappa.select(
        "source", _r("kappa").alias("kappa"), labels.kappa_band(F.col("kappa")).alias("band")
    )


TOXIC = ("the", "que", "und")
CONSTRUCTIVE = ("est", "der", "sch")

_c = S.clean("text")
_stats_sql = {
    "n_comments": "count(*)::DOUBLE",
    "avg_len_chars": "avg(length(c))",
    "avg_len_words": f"avg({S.words('c')})",
    "frac_has_laugh_emoji": f"avg(CASE WHEN regexp_matches(c, '{'|'.join(text.LAUGH_EMOJIS)}') THEN 1e0 ELSE 0e0 END)",
    "frac_has_question": "avg(CASE WHEN contains(c, '?') THEN 1e0 ELSE 0e0 END)",
}
_flags_sql = {}
for _name, _words in (("toxic", TOXIC), ("constructive", CONSTRUCTIVE)):
    _hits = f"count(*) FILTER (WHERE trim(c) <> '' AND {S.holds_word('c', _words)})"
    _flags_sql[f"n_{_name}_comments"] = f"{_hits}::DOUBLE"
    _flags_sql[f"frac_{_name}_comments"] = (
        f"coalesce({_hits}::DOUBLE / nullif(count(*) FILTER (WHERE trim(c) <> ''), 0), 0)"
    )


def vector_sql(digits: int | None = 6) -> str:
    """video_id and the 25 features of every post, rounded unless ``digits`` is None."""
    per_video = ", ".join(f"{e} AS {n}" for n, e in {**_stats_sql, **_flags_sql}.items())
    found = {**_engagement_sql(), **_date_sql()}
    found |= {n: f"coalesce({n}, 0e0)" for n in (*_stats_sql, *_flags_sql)}
    cols = ", ".join(
        f"{found[n]} AS {n}" if digits is None else f"{S.near(found[n], digits)} AS {n}"
        for n in NUMERIC_FEATURES
    )
    return (
        f"(SELECT p.video_id, {cols} FROM (SELECT video_id, {_counted}, "
        f"{S.date_of('date', 2025)} AS d, {_month} AS m FROM {V.POSTS.sql}) p "
        f"LEFT JOIN (SELECT video_id, {per_video} FROM (SELECT video_id, {_c} AS c "
        f"FROM {tree_sql()}) GROUP BY video_id) s ON p.video_id = s.video_id)"
    )


def comment_rows(spark, sf):
    """Comments of the posts' trees, as rows."""
    return trees.build_comment_tree(V.COMMENTS.df(spark, sf))


RULES = {"toxic": comments.has_word(TOXIC), "constructive": comments.has_word(CONSTRUCTIVE)}


@query(f"SELECT * FROM {vector_sql()}")
def q_numeric_vector(spark, sf):
    found = features.numeric_vector(V.POSTS.df(spark, sf), comments=comment_rows(spark, sf), **RULES)
    return found.select(
        "video_id", *[near(n).alias(n) for n in NUMERIC_FEATURES]
    )


_no_tags = r"regexp_replace(text, '#\S+', '', 'g')"


@query(
    "SELECT doc_id, trim(concat_ws(' ', nullif(t, ''), nullif(spoken, ''))) AS merged FROM "
    f"(SELECT doc_id, {S.clean(_no_tags)} AS t "
    f"FROM {V.CAPTIONS.sql}) LEFT JOIN (SELECT video_id, string_agg(nullif({_c}, ''), ' ' ORDER BY pos) "
    f"AS spoken FROM {tree_sql()} GROUP BY video_id) ON CAST(doc_id AS STRING) = video_id"
)
def q_merged_text(spark, sf):
    spoken = trees.joined_text_by(comment_rows(spark, sf), "video_id", sep=" ", out="spoken", blanks=False)
    spoken = spoken.select(F.col("video_id").cast("long").alias("doc_id"), "spoken")
    joined = _captions(spark, sf).join(spoken, "doc_id", "left")
    return joined.select("doc_id", text.merged_with(F.col("text"), F.col("spoken")).alias("merged"))


_stat_cols = ", ".join(f"ROUND({e}, 6) AS {n}" for n, e in _stats_sql.items())
_flag_cols = ", ".join(f"ROUND({e}, 6) AS {n}" for n, e in _flags_sql.items())


@query(f"SELECT video_id, {_stat_cols} FROM (SELECT video_id, text AS c FROM {V.COMMENTS.sql}) GROUP BY video_id")
def q_comment_stats(spark, sf):
    stats = trees.comment_stats_by(V.COMMENTS.df(spark, sf), "video_id")
    return stats.select("video_id", *[_r(n).alias(n) for n in comments.STAT_FIELDS])


@query(f"SELECT video_id, {_flag_cols} FROM (SELECT video_id, {_c} AS c FROM {V.COMMENTS.sql}) GROUP BY video_id")
def q_comment_toxicity(spark, sf):
    df = V.COMMENTS.df(spark, sf).withColumn("text", text.normalize_text(F.col("text")))
    flags = trees.comment_flags_by(df, "video_id", RULES)
    return flags.select("video_id", *[_r(n).alias(n) for n in _flags_sql])
