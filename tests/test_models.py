"""Encoders, classifiers, the fusion network and training."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipsift.functions.comments import has_word
from clipsift.operators import models


def one_sample(weights, video, audio, text, numeric, heads):
    """The network for one item, head by head with plain loops."""
    def lin(p, x):
        return np.array([sum(x[i] * p[0][i][j] for i in range(len(x))) + p[1][j] for j in range(len(p[1]))])

    def gelu(x):
        return np.array([0.5 * v * (1 + math.erf(v / math.sqrt(2))) for v in x])

    def norm(p, x):
        mean = sum(x) / len(x)
        var = sum((v - mean) ** 2 for v in x) / len(x)
        return np.array([(v - mean) / math.sqrt(var + 1e-5) * p[0][i] + p[1][i] for i, v in enumerate(x)])

    v, a, t, m = (norm(sc, gelu(lin(l, x))) for (l, sc), x in zip(weights["project"], (video, audio, text, numeric)))
    tokens, memory = [t, m], [v, a]
    size = len(t) // heads
    for layer in weights["layers"]:
        fresh = []
        for token in tokens:
            q = lin(layer["q"], token)
            keys, values = [lin(layer["k"], x) for x in memory], [lin(layer["v"], x) for x in memory]
            mixed = np.zeros(len(t))
            for h in range(heads):
                part = slice(h * size, (h + 1) * size)
                grades = [math.exp(q[part] @ k[part] / math.sqrt(size)) for k in keys]
                for g, value in zip(grades, values):
                    mixed[part] += g / sum(grades) * value[part]
            token = norm(layer["norm1"], token + lin(layer["o"], mixed))
            fresh.append(norm(layer["norm2"], token + lin(layer["down"], gelu(lin(layer["up"], token)))))
        tokens = fresh
    pooled = sum(norm(weights["norm"], x) for x in tokens) / 2
    return lin(weights["head"][1], gelu(lin(weights["head"][0], pooled)))


def test_fusion_network(spark):
    rng = np.random.default_rng(3)
    dims, width = (6, 5, 4, 3), 16
    weights = models.random_weights(dims, width, 4, seed=1)
    inputs = [rng.normal(size=(7, d)).astype("float32") for d in dims]
    rows = [(i, *[x[i].tolist() for x in inputs]) for i in range(7)]
    names = ("video_emb", "audio_emb", "text_emb", "metadata_numeric")
    df = spark.createDataFrame(rows, "video_id int, " + ", ".join(f"{n} array<float>" for n in names)).repartition(3)
    got = {r["video_id"]: r for r in models.score_multimodal(df, weights).collect()}
    for i in range(7):
        want = one_sample(weights, *[x[i].astype(float) for x in inputs], heads=models.HEADS)
        assert got[i]["logits"] == pytest.approx(want, abs=1e-9)
        assert sum(got[i]["probs"]) == pytest.approx(1.0)


def test_fusion_shape():
    weights = models.random_weights((768, 768, 768, 22), 64, 4)
    batch = [np.ones((2, d)) for d in (768, 768, 768, 22)]
    assert models.fusion_logits(weights, batch).shape == (2, 4)


def test_default_encoder(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, " "), (2, None), (3, "B  a a")], "i int, t string")
    got = {r["i"]: r["emb"] for r in models.encode_text(df, "t", 16).collect()}
    assert got[1] == [0.0] * 16 == got[2]
    assert got[0] == got[3] and sum(x * x for x in got[0]) == pytest.approx(1.0)
    assert sorted(x for x in got[0] if x) == pytest.approx([1 / math.sqrt(5), 2 / math.sqrt(5)])


def test_plugged_encoder_skips_blank_texts(spark):
    df = spark.createDataFrame([(0, "abc"), (1, "  "), (2, None)], "i int, t string")
    encoder = lambda texts: np.array([[len(t), 1.0] for t in texts])
    got = {r["i"]: r["emb"] for r in models.encode_text(df, "t", 2, encoder=encoder).collect()}
    assert got == {0: [3.0, 1.0], 1: [0.0, 0.0], 2: [0.0, 0.0]}


def test_classifiers(spark):
    long = "x " * 5000 + "hate"
    df = spark.createDataFrame([(0, long), (1, " "), (2, None), (3, "fine")], "i int, t string")
    rule = {r["i"]: r["pred"] for r in models.classify(df, "t", has_word(("hate",))).collect()}
    plugged = {r["i"]: r["pred"] for r in models.classify(df, "t", predict=lambda ts: ["hate" in t for t in ts]).collect()}
    assert rule == plugged == {0: 1, 1: 0, 2: 0, 3: 0}


def test_training(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 3))
    label = (x[:, 0] > 0).astype(int) * 2 + (x[:, 1] > 0)
    rows = [(i, x[i].tolist(), int(label[i])) for i in range(240)]
    df = spark.createDataFrame(rows, "i int, f array<double>, label int")
    in_train = F.col("i") % 4 != 0
    model, scores = models.train_classifier(df, "f", "label", in_train, grid=(0.0, 5.0))
    found = dict(scores)
    assert found["lr0"] > 0.85 and found["lr0"] >= found["lr5"]
    pred = models.predict(model, df, "f", ["i", "label"])
    assert pred.columns == ["i", "label", "pred", "probs"] and pred.count() == 240


def test_perceptron(spark):
    df = spark.createDataFrame([(i, [float(i % 2), 1.0], i % 2) for i in range(40)], "i int, f array<double>, label int")
    _, scores = models.train_classifier(df, "f", "label", F.col("i") < 30, layers=[2, 4, 2])
    assert scores == [("mlp", 1.0)]


def test_error_function():
    x = np.linspace(-6, 6, 2001)
    assert np.abs(models._erf(x) - [math.erf(v) for v in x]).max() < 1e-9
