"""Agreement and classification metrics.

Every metric starts from one partial aggregation (cells, classes or distinct scores).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.operators.ordering import running_totals


def _share(a: Column, b: Column) -> Column:
    """a / b with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def agreement(df: DataFrame, y1: str = "y1", y2: str = "y2") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col(y1) == F.col(y2)).cast("double")).alias("accuracy")
    )


def cohen_kappa(
    df: DataFrame, y1: str = "y1", y2: str = "y2", keys: Sequence[str] = ()
) -> DataFrame:
    """Observed and chance agreement and kappa, per ``keys``; null when chance agreement is 1."""
    cells = df.groupBy(*keys, F.col(y1).alias("a"), F.col(y2).alias("b")).agg(
        F.count(F.lit(1)).cast("double").alias("c")
    )
    zero = F.lit(0.0)
    hit = F.when(F.col("a") == F.col("b"), F.col("c")).otherwise(zero)
    sides = cells.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("a").alias("k"), F.col("c").alias("r"), zero.alias("s"), hit.alias("h")),
                F.struct(F.col("b").alias("k"), zero.alias("r"), F.col("c").alias("s"), zero.alias("h")),
            )
        ).alias("m"),
    ).select(*keys, "m.*")
    classes = sides.groupBy(*keys, "k").agg(
        F.sum("r").alias("r"), F.sum("s").alias("s"), F.sum("h").alias("h")
    )
    total = F.sum("r")
    out = classes.groupBy(*keys).agg(
        total.cast("long").alias("n"),
        (F.sum("h") / total).alias("po"),
        (F.sum(F.col("r") * F.col("s")) / (total * total)).alias("pe"),
    )
    return out.withColumn(
        "kappa", F.try_divide(F.col("po") - F.col("pe"), F.lit(1.0) - F.col("pe"))
    )


def confusion(
    df: DataFrame, labels: Sequence, label: str = "label", pred: str = "pred"
) -> DataFrame:
    """Counts for every (label, pred) of the given labels, zero cells included."""
    kind = df.schema[label].dataType.simpleString()
    names = F.array(*[F.lit(v).cast(kind) for v in labels])
    spine = (
        df.sparkSession.range(1)
        .select(F.explode(names).alias(label))
        .select(label, F.explode(names).alias(pred))
    )
    cells = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(cells, [label, pred], "left").select(
        label, pred, F.coalesce("n", F.lit(0)).alias("n")
    )


def binary_metrics(
    df: DataFrame, label: str = "label", pred: str = "pred", keys: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 (0 for an empty denominator)."""
    y, p = F.col(label), F.col(pred)
    cells = df.groupBy(*keys).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        *keys,
        _share(tp + tn, tp + fp + fn + tn).alias("acc"),
        _share(tp, tp + fp).alias("prec"),
        _share(tp, tp + fn).alias("rec"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Support, precision, recall and F1 per class found in labels or predictions."""
    cells = df.groupBy(F.col(label).alias("a"), F.col(pred).alias("b")).agg(
        F.count(F.lit(1)).alias("c")
    )
    hit = F.when(F.col("a") == F.col("b"), F.col("c")).otherwise(F.lit(0).cast("long"))
    none = F.lit(0).cast("long")
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("class"), F.col("c").alias("y"), none.alias("p"), hit.alias("tp")),
                F.struct(F.col("b").alias("class"), none.alias("y"), F.col("c").alias("p"), none.alias("tp")),
            )
        ).alias("m")
    ).select("m.*")
    per = sides.groupBy("class").agg(
        F.sum("y").alias("support"), F.sum("p").alias("predicted"), F.sum("tp").alias("tp")
    )
    return per.select(
        "class",
        "support",
        _share(F.col("tp"), F.col("predicted")).alias("prec"),
        _share(F.col("tp"), F.col("support")).alias("rec"),
        _share(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
    )


def macro_f1(df: DataFrame, label: str = "label", pred: str = "pred", positive: int = 1) -> DataFrame:
    """Unweighted mean F1 over the classes and the recall of ``positive``."""
    per = class_metrics(df, label, pred)
    return per.agg(
        F.avg("f1").alias("macro_f1"),
        F.coalesce(F.max(F.when(F.col("class") == positive, F.col("rec"))), F.lit(0.0)).alias("recall_pos"),
    )


def _score_counts(df: DataFrame, label: str, prob: str, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, F.col(prob).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q")
    )


def roc_auc(
    df: DataFrame, label: str = "label", prob: str = "prob", keys: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve, ties counted half; 0 when only one class is present."""
    scores = _score_counts(df, label, prob, keys)
    ranked = running_totals(scores, keys, ["score"], {"below": F.col("q")})
    wins = F.col("p") * (F.col("below") - F.col("q") + F.col("q") * F.lit(0.5))
    pairs = F.sum("p").cast("double") * F.sum("q").cast("double")
    return ranked.groupBy(*keys).agg(
        F.coalesce(F.try_divide(F.sum(wins.cast("double")), pairs), F.lit(0.0)).alias("auc")
    )


def roc_curve(df: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the origin at infinity."""
    scores = _score_counts(df, label, prob, ())
    ranked = running_totals(
        scores,
        [],
        [F.col("score").desc()],
        {"tp": F.col("p"), "fp": F.col("q")},
        totals={"tp": "pos", "fp": "neg"},
    )
    points = ranked.select(
        F.col("score").alias("threshold"),
        _share(F.col("fp"), F.col("neg")).alias("fpr"),
        _share(F.col("tp"), F.col("pos")).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def metrics_long(wide: DataFrame, model: str = "model") -> DataFrame:
    """One (model, metric, value) row per metric column."""
    names = [c for c in wide.columns if c != model]
    return wide.unpivot([model], names, "metric", "value")


def compare_models(long: DataFrame, base: str, other: str) -> DataFrame:
    """Metrics of two models side by side with the signed difference."""
    side = long.filter(F.col("model").isin(base, other)).groupBy("metric").agg(
        F.max(F.when(F.col("model") == base, F.col("value"))).alias("base"),
        F.max(F.when(F.col("model") == other, F.col("value"))).alias("other"),
    )
    return side.withColumn("diff", F.col("other") - F.col("base"))
