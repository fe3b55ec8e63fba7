"""Encoders, classifiers, the fusion scorer and training on feature tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.functions.counts import strip
from clipsift.functions.vectors import softmax
from clipsift.operators.metrics import macro_f1
from clipsift.session import durable
from clipsift.sources.modelstore import plain_model

Encoder = Callable[[list[str]], np.ndarray]

MAX_TOKENS = 32_768  # of a batch that a plugged model gets, all texts padded to the longest


def words_in(text: str) -> int:
    """A text's size for a model that does not say otherwise."""
    return len(text.split())


def token_batches(sizes: np.ndarray, max_tokens: int) -> Iterator[np.ndarray]:
    """Places of texts by falling size, in batches that padded to their longest keep to ``max_tokens``.

    A text beyond it is alone in its batch. Texts of like size share one, so little is padding.
    """
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, int(max_tokens) // max(1, int(sizes[order[at]])))
        yield order[at : at + n]
        at += n


def _in_batches(texts: pd.Series, size: Callable[[str], int], max_tokens: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(places, texts) of the texts that are not empty, batch by batch."""
    shown = np.flatnonzero(texts.str.len().to_numpy() > 0)
    sizes = np.array([size(t) for t in texts.iloc[shown]], dtype=np.int64)
    for own in token_batches(sizes, max_tokens):
        yield shown[own], texts.iloc[shown[own]].tolist()


def dense(vector: Column) -> Column:
    """A vector column as an array of floats."""
    return vector_to_array(vector, "float32")


def encode_text(
    df: DataFrame, col: str, dim: int, out: str = "emb", encoder: Encoder | None = None,
    max_tokens: int = MAX_TOKENS, size: Callable[[str], int] = words_in, sparse: bool = False,
) -> DataFrame:
    """Add a vector of ``dim`` floats per text; blank or missing text -> zeros.

    Default: hashed word counts with unit length, in the JVM. An ``encoder`` (list of texts ->
    matrix) runs in Python instead, on texts of like ``size`` that padded to the longest hold at most
    ``max_tokens``; whole texts, in the table's order again afterwards.

    With ``sparse`` the word counts stay a sparse vector, which ``dense`` turns into the same floats. A
    table holds a text's words then, where a writer would take each of ``dim`` floats, mostly zeros, by itself.
    """
    text = strip(F.coalesce(F.col(col), F.lit("")))
    if encoder is None:
        words = F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda t: t != "")
        work = df.withColumn("_words", words)
        work = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim).transform(work)
        work = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(work)
        unit = F.col("_unit")
        return work.withColumn(out, unit if sparse else dense(unit)).drop("_words", "_tf", "_unit")
    if sparse:
        raise ValueError("an encoder's vectors are dense")

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            rows = np.zeros((len(texts), dim), dtype=np.float32)
            for places, some in _in_batches(texts, size, max_tokens):
                rows[places] = encoder(some)
            yield pd.Series(list(rows))

    return df.withColumn(out, run(text))


def classify(
    df: DataFrame,
    col: str,
    classifier: Callable[[Column], Column] | None = None,
    predict: Callable[[list[str]], Sequence[int]] | None = None,
    out: str = "pred",
    max_tokens: int = MAX_TOKENS,
    size: Callable[[str], int] = words_in,
) -> DataFrame:
    """Add a 0/1 class per whole text; blank -> 0.

    ``classifier`` maps a column to a column; ``predict`` (list of texts -> classes) runs in
    batches as in ``encode_text``.
    """
    text = strip(F.coalesce(F.col(col), F.lit("")))
    if classifier is not None:
        return df.withColumn(out, F.when(text == "", F.lit(0)).otherwise(classifier(text)).cast("int"))

    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            result = np.zeros(len(texts), dtype=np.int32)
            for places, some in _in_batches(texts, size, max_tokens):
                result[places] = np.asarray(predict(some), dtype=np.int32)
            yield pd.Series(result)

    return df.withColumn(out, run(text))


# Shape of the fusion network.
INPUTS = ("video_emb", "audio_emb", "text_emb", "metadata_numeric")
HEADS = 8
LAYERS = 2
FFN_FACTOR = 4
NORM_EPS = 1e-5
MAX_WEIGHT_BYTES = 1 << 30
BLOCK_ROWS = 512  # rows in one pass of the network, which holds some 100 KB a row

# The error function at steps of 1/128 up to 6, where it is 1 but for 1e-16, and its slope there.
_STEP = 128
_GRID = np.arange(6 * _STEP + 2) / _STEP
_ERF = np.array([math.erf(v) for v in _GRID])
_SLOPE = 2 / math.sqrt(math.pi) * np.exp(-_GRID * _GRID) / _STEP


def _erf(x: np.ndarray) -> np.ndarray:
    """The error function by cubic pieces through the table; its error is below 1e-9."""
    size = np.minimum(np.abs(x), 6.0) * _STEP
    i = size.astype(np.int64)
    t = size - i
    a, b, m, n = _ERF[i], _ERF[i + 1], _SLOPE[i], _SLOPE[i + 1]
    rise = b - a
    y = a + t * (m + t * (3 * rise - 2 * m - n + t * (m + n - 2 * rise)))
    return np.copysign(y, x)


def _gelu(x: np.ndarray) -> np.ndarray:
    return 0.5 * x * (1.0 + _erf(x * math.sqrt(0.5)))


def random_weights(dims: Sequence[int], width: int, classes: int, seed: int = 0) -> dict:
    """Seeded weights of the fusion network for inputs (video, audio, text, numeric)."""
    rng = np.random.default_rng(seed)

    def linear(n_in: int, n_out: int):
        return rng.normal(0.0, n_in**-0.5, (n_in, n_out)), rng.normal(0.0, 0.02, n_out)

    def norm():
        return np.ones(width), np.zeros(width)

    return {
        "project": [(linear(d, width), norm()) for d in dims],
        "layers": [
            {
                **{n: linear(width, width) for n in ("q", "k", "v", "o")},
                "up": linear(width, FFN_FACTOR * width),
                "down": linear(FFN_FACTOR * width, width),
                "norm1": norm(),
                "norm2": norm(),
            }
            for _ in range(LAYERS)
        ],
        "norm": norm(),
        "head": [linear(width, width // 2), linear(width // 2, classes)],
    }


def _arrays(part) -> Iterator[np.ndarray]:
    if isinstance(part, np.ndarray):
        yield part
    else:
        for inner in part.values() if isinstance(part, dict) else part:
            yield from _arrays(inner)


def _rebuilt(part, arrays: Iterator[np.ndarray]):
    if isinstance(part, np.ndarray):
        return next(arrays)
    if isinstance(part, dict):
        return {name: _rebuilt(inner, arrays) for name, inner in part.items()}
    return type(part)(_rebuilt(inner, arrays) for inner in part)


def fusion_logits(weights: dict, inputs: Sequence[np.ndarray], heads: int = HEADS) -> np.ndarray:
    """Logits of a whole batch: text and numeric tokens attend to video and audio tokens."""
    def linear(p, x):
        return x @ p[0] + p[1]

    def norm(p, x):
        centred = x - x.mean(-1, keepdims=True)
        return centred / np.sqrt((centred**2).mean(-1, keepdims=True) + NORM_EPS) * p[0] + p[1]

    video, audio, text, numeric = (
        norm(scale, _gelu(linear(lin, x))) for (lin, scale), x in zip(weights["project"], inputs)
    )
    x, memory = np.stack([text, numeric], 1), np.stack([video, audio], 1)
    n, width = len(text), text.shape[-1]
    for layer in weights["layers"]:
        q, k, v = (
            linear(layer[name], side).reshape(n, 2, heads, width // heads)
            for name, side in (("q", x), ("k", memory), ("v", memory))
        )
        grade = np.einsum("nqhd,nkhd->nhqk", q, k) / math.sqrt(width // heads)
        grade = np.exp(grade - grade.max(-1, keepdims=True))
        share = grade / grade.sum(-1, keepdims=True)
        mixed = np.einsum("nhqk,nkhd->nqhd", share, v).reshape(n, 2, width)
        x = norm(layer["norm1"], x + linear(layer["o"], mixed))
        x = norm(layer["norm2"], x + linear(layer["down"], _gelu(linear(layer["up"], x))))
    pooled = norm(weights["norm"], x).mean(1)
    return linear(weights["head"][1], _gelu(linear(weights["head"][0], pooled)))


def row_blocks(batches: Iterator[pd.DataFrame], rows: int = BLOCK_ROWS) -> Iterator[pd.DataFrame]:
    """Few rows at a time, so that a pass needs the same memory whatever the Arrow batches hold."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def score_multimodal(
    df: DataFrame,
    weights: dict,
    key: str = "video_id",
    inputs: Sequence[str] = INPUTS,
    *keep: str,
    heads: int = HEADS,
) -> DataFrame:
    """(key, kept columns, logits, probs) by the fusion network, in passes of ``BLOCK_ROWS`` rows.

    The weights have a fixed size set by the network, not by the data; beyond
    ``MAX_WEIGHT_BYTES`` they are refused.
    """
    size = sum(a.nbytes for a in _arrays(weights))
    if size > MAX_WEIGHT_BYTES:
        raise ValueError(f"{size} bytes of weights are too many to send to every task")
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in row_blocks(batches):
            arrays = [np.stack(batch[c].to_numpy()).astype(float) for c in inputs]
            yield pd.DataFrame(
                {**{c: batch[c] for c in (key, *keep)}, "logits": list(fusion_logits(sent.value, arrays, heads))}
            )

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in (key, *keep))
    scored = df.select(key, *keep, *inputs).mapInPandas(run, f"{kinds}, logits array<double>")
    return scored.withColumn("probs", softmax(F.col("logits")))


def train_classifier(
    df: DataFrame,
    features: str,
    label: str,
    train: Column,
    layers: Sequence[int] | None = None,
    grid: Sequence[float] = (0.0, 0.01, 0.1),
    seed: int = 42,
):
    """Fit candidates on the rows where ``train`` holds, keep the best macro F1 on the others.

    Logistic regression over the regularisation ``grid``, or a perceptron with hidden
    ``layers``. The rows are written once, as every candidate reads them. Returns (model, validation metrics as a list of (candidate, macro_f1)).
    """
    rows = durable(
        df.select(
            F.col(features).cast("array<double>").alias("_f"),
            F.col(label).cast("double").alias("label"),
            train.alias("_train"),
        ),
        "training",
    ).select(array_to_vector("_f").alias("features"), "label", "_train")
    fit_on, check_on = rows.filter("_train"), rows.filter(~F.col("_train"))
    if layers:
        candidates = [("mlp", MultilayerPerceptronClassifier(layers=list(layers), seed=seed))]
    else:
        candidates = [(f"lr{r:g}", LogisticRegression(regParam=float(r))) for r in grid]
    best, scores = None, []
    for name, estimator in candidates:
        model = plain_model(estimator.fit(fit_on), df.sparkSession)
        found = model.transform(check_on).select("label", F.col("prediction").alias("pred"))
        score = macro_f1(found).first()["macro_f1"] or 0.0
        scores.append((name, score))
        if best is None or score > best[0]:
            best = (score, model)
    return best[1], scores


def predict(model, df: DataFrame, features: str, keep: Sequence[str]) -> DataFrame:
    """(kept columns, pred, probs) of a fitted classifier."""
    rows = df.select(
        *keep, array_to_vector(F.col(features).cast("array<double>")).alias("features")
    )
    return model.transform(rows).select(
        *keep, F.col("prediction").cast("int").alias("pred"), vector_to_array("probability").alias("probs")
    )
