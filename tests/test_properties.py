"""Parsers against plain Python on generated input."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipsift.functions import counts, dates, text

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
NUMBERS = st.one_of(
    st.from_regex(r"\A[ \t]?[-+]?[0-9]{1,4}(\.[0-9]{0,2})?[ ]?[KkMmBbx]{0,2}[ ]?\Z"),
    st.text("0123456789.KMBe+- n/a ", max_size=6),
)
DAYS = st.one_of(st.from_regex(r"\A ?[0-9]{1,2}[-/.][0-9]{1,2}([-/.][0-9])? ?\Z"), st.text("0189-/. a", max_size=6))
TEXTS = st.text("ab #\n\t  😂😱☹️?é", max_size=20)


def spark_values(spark, fn, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def plain_count(value):
    body = value.strip().upper()
    scale = {"K": 1e3, "M": 1e6, "B": 1e9}.get(body[-1:], None)
    body = body[:-1] if scale else body
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)(E[+-]?\d+)?", body.strip()) is None:
        return None
    return float(body) * (scale or 1.0)


@FEW
@given(st.lists(NUMBERS, min_size=1, max_size=80))
def test_parse_count(spark, values):
    assert spark_values(spark, counts.parse_count, values) == [plain_count(v) for v in values]


def plain_day(value):
    parts = re.split(r"[-/.]", value.strip())
    try:
        month, day = (int(p) for p in parts)
    except ValueError:
        return None
    return (month, day) if 1 <= month <= 12 and 1 <= day <= 31 else None


@FEW
@given(st.lists(DAYS, min_size=1, max_size=80))
def test_parse_mm_dd(spark, values):
    got = spark_values(spark, dates.parse_mm_dd, values)
    assert [tuple(g) if g else None for g in got] == [plain_day(v) for v in values]


def plain_clean(value):
    for token, signs in text.EMOJI_TOKENS.items():
        for sign in signs:
            value = value.replace(sign, f" {token} ")
    return re.sub(r"\s+", " ", value).strip()


@FEW
@given(st.lists(TEXTS, min_size=1, max_size=80))
def test_text_cleaning(spark, values):
    assert spark_values(spark, text.normalize_text, values) == [plain_clean(v) for v in values]
    assert spark_values(spark, text.strip_hashtags, values) == [re.sub(r"#\S+", "", v) for v in values]
    assert spark_values(spark, text.word_count, values) == [len(v.split()) for v in values]
