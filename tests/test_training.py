"""Gradients against finite differences, sums over partitions, training and transfer."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clipsift.operators import models, training

DIMS, WIDTH = (5, 4, 6, 3), 8
KIND = "i long, " + ", ".join(f"{c} array<double>" for c in models.INPUTS) + ", label int"


def table(spark, n, seed=1, parts=3):
    rng = np.random.default_rng(seed)
    inputs = [rng.normal(size=(n, d)) for d in DIMS]
    label = (inputs[2][:, 0] > 0).astype(int) * 2 + (inputs[0][:, 1] > 0)
    rows = [(i, *[x[i].tolist() for x in inputs], int(label[i])) for i in range(n)]
    return spark.createDataFrame(rows, KIND).repartition(parts), inputs, label


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(2)
    weights = models.random_weights(DIMS, WIDTH, 3, seed=4)
    inputs, labels = [rng.normal(size=(6, d)) for d in DIMS], rng.integers(0, 3, 6)
    loss, grads = training.loss_and_gradient(weights, inputs, labels, heads=2)
    logits = models.fusion_logits(weights, inputs, 2)
    want = -np.log(np.exp(logits)[np.arange(6), labels] / np.exp(logits).sum(1)).sum()
    assert loss == pytest.approx(want)
    flat, found = training._flat(weights), training._flat(grads)
    for at in rng.choice(len(flat), 150, replace=False):
        moved = []
        for step in (1e-5, -1e-5):
            other = flat.copy()
            other[at] += step
            moved.append(training.loss_and_gradient(training._shaped(other, weights), inputs, labels, heads=2)[0])
        assert found[at] == pytest.approx((moved[0] - moved[1]) / 2e-5, rel=1e-4, abs=1e-5)


def test_sums_do_not_depend_on_partitions(spark):
    df, inputs, label = table(spark, 90)
    weights = models.random_weights(DIMS, WIDTH, 4, seed=5)
    loss, grads = training.loss_and_gradient(weights, inputs, label, heads=2)
    for parts in (1, 7):
        got = training.gradient_sum(df.repartition(parts), weights, heads=2)
        assert got[1] == 90 and got[0] == pytest.approx(loss)
        assert np.allclose(training._flat(got[2]), training._flat(grads))
    odd = df.unionByName(spark.createDataFrame([(900, None, [0.0] * 4, [0.0] * 6, [0.0] * 3, 1), (901, [0.0] * 5, [0.0] * 4, [0.0] * 6, [0.0] * 3, None)], KIND))
    assert training.gradient_sum(odd, weights, heads=2)[1] == 90
    empty = training.gradient_sum(df.limit(0), weights, heads=2)
    assert empty[:2] == (0.0, 0) and not training._flat(empty[2]).any()


def test_training_and_transfer(spark):
    df, _, _ = table(spark, 240)
    start = models.random_weights(DIMS, WIDTH, 4, seed=6)
    train = F.col("i") % 4 != 0
    base, history = training.train_network(
        df, start, "label", train, 24, "i", optimizer=training.AdamW(lr=0.02), slices=2, check_every=8, heads=2
    )
    assert history[-1][1] < 0.8 * np.log(4) and max(f for _, _, f in history) > 0.5
    two = df.withColumn("label", (F.col("label") > 1).cast("int"))
    tuned, after = training.transfer(two, base, "label", train, 6, "i", frozen=("project", "layers", "head.0"),
                                     optimizer=training.AdamW(lr=0.05), check_every=2, heads=2)
    assert tuned["head"][1][0].shape == (WIDTH // 2, 2) and after[-1][1] < after[0][1]
    for name in ("project", "layers"):
        assert np.array_equal(training._flat({"x": base[name]}), training._flat({"x": tuned[name]}))
    assert np.array_equal(base["head"][0][0], tuned["head"][0][0]) and not np.array_equal(base["norm"][0], tuned["norm"][0])


def test_passes_hold_few_rows_whatever_the_batches_hold(spark, monkeypatch):
    batches = [pd.DataFrame({"i": range(1300)}), pd.DataFrame({"i": []}), pd.DataFrame({"i": [7]})]
    found = list(models.row_blocks(iter(batches)))
    assert [len(b) for b in found] == [512, 512, 276, 1]
    assert [i for b in found for i in b["i"]] == [*range(1300), 7]

    df, inputs, label = table(spark, 1100, parts=1)
    weights = models.random_weights(DIMS, WIDTH, 4, seed=4)
    real = training.loss_and_gradient

    def few(weights, inputs, labels, heads):
        assert len(labels) <= 512
        return real(weights, inputs, labels, heads)

    loss, grads = real(weights, inputs, label, heads=2)
    monkeypatch.setattr(training, "loss_and_gradient", few)
    got = training.gradient_sum(df, weights, heads=2)
    assert got[0] == pytest.approx(loss) and got[1] == 1100
    assert training._flat(got[2]) == pytest.approx(training._flat(grads), rel=1e-6, abs=1e-9)
    scored = models.score_multimodal(df, weights, "i", heads=2).orderBy("i").collect()
    want = models.fusion_logits(weights, inputs, 2)
    assert np.allclose([r["logits"] for r in scored], want)
