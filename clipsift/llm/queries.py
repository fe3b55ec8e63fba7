"""One query per operator: the operator over its whole table, in the agreed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsift.llm import (
    forest, licenses, neardup, negatives, packing, pieces, quality, quotes, secrets, suffixes, toxicity, trie, wavelet,
)
from clipsift.llm.common import documents, tokenizer_path
from clipsift.llm.registry import LLM_QUERIES, query
from clipsift.tables import load

PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"


_Q = quality


def _line_fails_sql(x: str) -> str:
    bare = f"trim({x}, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))"
    left = {k: f"length(regexp_replace({bare}, '{p}', '', 'g'))" for k, p in
            (("symbol", _Q.SYMBOL), ("letter", _Q.LETTER), ("capital", _Q.CAPITAL))}
    end = _Q.LINE_END.replace("'", "''")
    return f"""(
        (NOT regexp_matches({bare}, '{end}')
         AND len(regexp_extract_all({bare}, '[^\x20\x09-\x0D]+')) >= {_Q.MIN_LINE_WORDS})
        OR len(regexp_extract_all({bare}, '{_Q.SEPARATORS}')) >= {_Q.MIN_SEPARATORS}
        OR regexp_matches({bare}, '{_Q.BOILERPLATE}')
        OR {left["symbol"]} * 10 > length({bare})
        OR ({left["capital"]} >= {_Q.MIN_CAPITALS} AND {left["capital"]} * 10 > {left["letter"]} * 6))"""


QUALITY_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
wn AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY doc_id),
g AS (SELECT *, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4
      FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2, w3, w4) AS n FROM g WHERE w4 IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat
        FROM (SELECT doc_id, i, unnest(range(5)) AS k FROM r WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
full_l AS (SELECT * FROM l WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dl AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup FROM full_l GROUP BY doc_id),
bad AS (SELECT doc_id, count(*) AS n_bad, sum(length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g'))) AS lost
        FROM full_l WHERE {_line_fails_sql("l")} GROUP BY doc_id),
a AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
             coalesce(n_repeat, 0) AS n_repeat_words, coalesce(n_bad, 0) AS n_lines_failed, coalesce(lost, 0) AS lost_chars
      FROM d LEFT JOIN wn USING (doc_id) LEFT JOIN dl USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN bad USING (doc_id)),
b AS (SELECT *, n_words < {_Q.MIN_WORDS} OR 100 * n_repeat_words > {_Q.MAX_REPEAT_PCT} * n_words AS base_failed FROM a)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, CAST(n_lines_failed AS BIGINT) AS n_lines_failed,
       CAST(lost_chars AS BIGINT) AS lost_chars,
       NOT base_failed AND 100 * lost_chars <= {_Q.MAX_LOST_PCT} * word_chars AS kept
FROM b"""


@query(QUALITY_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(documents(spark, sf_dir)).drop("clean_text")


@query()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir), tokenizer_path(PIECE_MODEL))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


@query()
def op4_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns hold no quotes; as mails that quote the turns before them they have to be told apart again."""
    threads = quotes.link_quotes(quotes.as_mail(load(spark, sf_dir, "conversations")))
    return threads.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


@query()
def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = wavelet.write_shards(documents(spark, sf_dir), tokenizer_path(WORD_MODEL), end_id=1)
    return wavelet.read_shards(shards)


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path(WORD_MODEL), end_id=2)


@query()
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.neighbours(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir))


@query()
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), shingle=2)


@query()
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scanned = secrets.redact(docs, secrets.train(secrets.made_findings(spark)))
    return scanned.select(
        "doc_id", F.col("_candidates").alias("n_candidates"), F.col("_secrets").alias("n_secrets"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("redacted_sha256"),
    )


NEGATIVES_SQL = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


@query(NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(load(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, shifted)


_L = licenses
_TEMPLATE_ROWS = ", ".join(
    "({}, '{}', '{}', '{}')".format(i, t.label, t.key, t.text.replace("'", "''")) for i, t in enumerate(_L.TEMPLATES)
)


def _words_sql(text: str) -> str:
    low = f"translate({text}, '{_L.CAPITALS}', '{_L.CAPITALS.lower()}')"
    return f"regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


LICENSES_SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS w0, unnest(range(len(w))) AS pos, w FROM d),
g AS (SELECT doc_id, pos, w0, w[pos + 2] AS w1, w[pos + 3] AS w2, CASE WHEN pos > 0 THEN w[pos] END AS b1,
             CASE WHEN pos > 1 THEN w[pos - 1] END AS b2 FROM p),
base AS (SELECT doc_id, CASE b1 WHEN 'public' THEN 'gpl' ELSE b1 END AS label,
                CASE b1 WHEN 'public' THEN pos - 2 ELSE pos - 1 END AS start
         FROM g WHERE w0 = 'license' AND (b1 IN ('mit', 'apache') OR (b1 = 'public' AND b2 = 'general'))),
based AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                 string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
t(template, label, key, text) AS (VALUES {_TEMPLATE_ROWS}),
tw AS (SELECT template, label, {_words_sql("key")} AS kw, {_words_sql("text")} AS tw FROM t),
tp AS (SELECT template, label, kw, tw, len(tw) AS t_len, unnest(range(len(tw))) AS t_at FROM tw),
tk AS (SELECT template, label, t_len, min(t_at) AS k_at, len(any_value(kw)) AS k_len
       FROM tp WHERE tw[t_at + 1 : t_at + len(kw)] = kw GROUP BY ALL),
hit AS (SELECT DISTINCT doc_id, template, t_at, pos - t_at AS diagonal
        FROM g JOIN tp ON w0 = tw[t_at + 1] AND w1 = tw[t_at + 2] AND w2 = tw[t_at + 3]),
dg AS (SELECT DISTINCT doc_id, template, diagonal FROM hit),
apart AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER o > {_L.GAP}, true) AS a FROM dg
          WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
span AS (SELECT *, sum(a::INT) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM apart),
word AS (SELECT DISTINCT doc_id, template, span, t_at + k AS c FROM hit JOIN span USING (doc_id, template, diagonal), range({_L.GRAM}) r(k)),
cover AS (SELECT doc_id, template, span, count(*) AS n, count(*) FILTER (c >= k_at AND c < k_at + k_len) AS n_key
          FROM word JOIN tk USING (template) GROUP BY ALL),
judged AS (SELECT doc_id, label, n / t_len AS share, 100 * n >= {_L.COVER_PCT} * t_len AND n_key = k_len AS sound
           FROM cover JOIN tk USING (template)),
found AS (SELECT doc_id, max(share) AS share FROM judged GROUP BY doc_id),
named AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT doc_id, label FROM judged WHERE sound UNION ALL SELECT doc_id, label FROM base) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(coalesce(share, 0e0), CASE WHEN n_base > 0 THEN {_L.BASE_SCORE} ELSE 0 END) AS score
FROM d LEFT JOIN based USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query(LICENSES_SQL)
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).drop("spans")


@query()
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(load(spark, sf_dir, "conversations"))


def llm_queries():
    """All queries of the subpackage, in order."""
    return dict(LLM_QUERIES)
