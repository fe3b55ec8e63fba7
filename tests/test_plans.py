"""Physical plans: what is read, what is cut before a shuffle."""

from pyspark.sql import functions as F

from clipsift.functions.comments import comment_stats
from clipsift.operators import aggregates, filters, ordering, scaling
from clipsift.tables import load


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    e = filters.filter_time(load(spark, sf_dir, "events"), "ts", "2024-01-10", "2024-01-12")
    text = plan(aggregates.label_counts(filters.filter_label(e, "click", "event_type"), "event_type"))
    assert "EqualTo(event_type,click)" in text and "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_top_n_is_one_operator(spark, sf_dir):
    text = plan(ordering.recent(load(spark, sf_dir, "events"), 50, "ts", "event_id", columns=["event_id"]))
    assert "TakeOrderedAndProject" in text and "props" not in text


def test_first_per_key_cuts_before_the_shuffle(spark, sf_dir):
    text = plan(ordering.first_per_key(load(spark, sf_dir, "events"), ["user_id"], ["ts"], 20))
    assert text.count("WindowGroupLimit") >= 2


def test_array_statistics_do_not_shuffle(spark):
    df = spark.range(3).select(F.array(F.col("id").cast("string")).alias("c"))
    assert "Exchange" not in plan(df.select(comment_stats(F.col("c"))))


def test_scaler_reads_its_parameters_as_a_subquery(spark, sf_dir):
    df = load(spark, sf_dir, "lineitem")
    text = plan(scaling.fit_scaler(df, ["l_tax", "l_discount"]).transform(df))
    assert "Subquery" in text and "Join" not in text


def test_percentiles_never_gather_a_column(spark, sf_dir):
    text = plan(aggregates.describe(load(spark, sf_dir, "events"), {"v": F.col("value")}))
    assert "percentile(" not in text and "collect_list" not in text


def test_running_totals_shuffle_the_rows_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = load(spark, sf_dir, "events").select("user_id", "event_id")
    df = ordering.numbered(rows, ["user_id"], ["event_id"], bucket=F.floor(F.col("event_id") / 100))
    text = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    row_side = text[text.index("SortMergeJoin"):text.index("_carry_slice#", text.index("Window"))]
    assert row_side.count("Exchange") == 1
