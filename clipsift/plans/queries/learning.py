"""Encoders, classifiers, scoring and training."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from clipsift.functions.comments import has_word
from clipsift.functions.labels import binary_label
from clipsift.functions.vectors import as_doubles, collapse_multiclass, dot, total
from clipsift.operators import metrics, models, sampling, training
from clipsift.operators.scaling import fit_scaler
from clipsift.plans import sqltext as S
from clipsift.plans import standins as V
from clipsift.plans.queries.scalars import TOXIC
from clipsift.plans.registry import query
from clipsift.session import scratch_path
from clipsift.sources.modelstore import ModelStore
from clipsift.tables import load


@query(
    "SELECT doc_id, 64 AS width, CASE WHEN trim(text) = '' THEN 0e0 ELSE 1e0 END AS norm "
    f"FROM {V.CAPTIONS.sql}"
)
def q_encode_text(spark, sf):
    encoded = models.encode_text(V.CAPTIONS.df(spark, sf), "text", 64)
    squares = F.transform(as_doubles(F.col("emb")), lambda x: x * x)
    return encoded.select(
        "doc_id", F.size("emb").alias("width"), F.round(F.sqrt(total(squares)), 4).alias("norm")
    )


_flag = f"CASE WHEN trim(text) <> '' AND {S.holds_word('text', TOXIC)} THEN 1 ELSE 0 END"


@query(f"SELECT video_id, pos, {_flag} AS pred FROM {V.COMMENTS.sql}")
def q_classify_comments(spark, sf):
    flagged = models.classify(V.COMMENTS.df(spark, sf), "text", has_word(TOXIC))
    return flagged.select("video_id", "pos", "pred")


WIDTH = 64
INPUT_DIMS = (32, 32, 64, 22)


def fusion_inputs(spark, sf):
    return load(spark, sf, "embeddings").select(
        F.col("vec_id"),
        (F.col("label") % 4).cast("int").alias("label"),
        F.slice("embedding", 1, 32).alias("video_emb"),
        F.slice("embedding", 33, 32).alias("audio_emb"),
        F.col("embedding").alias("text_emb"),
        F.slice("embedding", 11, 22).alias("metadata_numeric"),
    )


@query()
def q_score_multimodal(spark, sf):
    weights = models.random_weights(INPUT_DIMS, WIDTH, 4)
    scored = models.score_multimodal(fusion_inputs(spark, sf), weights, key="vec_id")
    both = collapse_multiclass(F.col("probs"))
    return scored.withColumn("b", both).select(
        "vec_id", F.round("b.prob", 6).alias("prob"), F.col("b.pred").alias("pred"),
        *[F.round(F.get("logits", F.lit(i)), 6).alias(f"logit{i}") for i in range(4)],
    )


def training_rows(spark, sf):
    """Embeddings with a four-class target read off the vectors, and a seeded split."""
    grade = dot(F.slice("embedding", 1, 4), (4.0, -3.0, 2.0, -1.0))
    rows = load(spark, sf, "embeddings").select(
        "vec_id", as_doubles(F.col("embedding")).alias("features"), grade.alias("g")
    )
    label = F.when(F.col("g") < -0.5, 0).when(F.col("g") < 0, 1).when(F.col("g") < 0.5, 2).otherwise(3)
    split = sampling.split(rows.withColumn("label", label), 0.8, "vec_id")
    return split.drop("g")


@query()
def q_train_classifier(spark, sf):
    rows = training_rows(spark, sf)
    in_train = F.col("split") == "train"
    model, _ = models.train_classifier(rows, "features", "label", in_train, grid=(0.0, 0.1))
    found = models.predict(model, rows.filter(~in_train), "features", ["vec_id", "label"])
    return metrics.class_metrics(found)


def network_rows(spark, sf):
    """The network's inputs with the target of ``training_rows``."""
    target = training_rows(spark, sf).select("vec_id", "label", (F.col("split") == "train").alias("in_train"))
    return fusion_inputs(spark, sf).drop("label").join(target, "vec_id")


@query(
    "SELECT c AS class, count(*) / 4e0 - count(*) FILTER (label % 4 = c) AS gradient, "
    "round(count(*) * ln(4), 6) AS loss FROM embeddings, (VALUES (0), (1), (2), (3)) t(c) GROUP BY c"
)
def q_gradient_sum(spark, sf):
    """With an empty last layer every class has probability 1/4, so the last bias' gradient is a count."""
    weights = models.random_weights(INPUT_DIMS, WIDTH, 4)
    weights["head"][1] = tuple(np.zeros_like(a) for a in weights["head"][1])
    loss, _, grads = training.gradient_sum(fusion_inputs(spark, sf), weights)
    rows = [(c, round(float(g), 9), round(loss, 6)) for c, g in enumerate(grads["head"][1][1])]
    return spark.createDataFrame(rows, "class int, gradient double, loss double")


@query()
def q_train_network(spark, sf):
    """Macro F1 and loss of the network while it learns."""
    weights = models.random_weights(INPUT_DIMS, WIDTH, 4)
    _, history = training.train_network(
        network_rows(spark, sf), weights, "label", F.col("in_train"), 6, "vec_id", optimizer=training.AdamW(lr=3e-3), check_every=3
    )
    return spark.createDataFrame(history, "step int, loss double, macro_f1 double")


@query()
def q_transfer(spark, sf):
    """A four-class network, published and loaded again, goes on with a new head of two classes."""
    rows, store = network_rows(spark, sf), ModelStore(spark, scratch_path(spark, "models"))
    base, _ = training.train_network(
        rows, models.random_weights(INPUT_DIMS, WIDTH, 4), "label", F.col("in_train"), 3, "vec_id", check_every=3
    )
    store.publish(base)
    two = rows.withColumn("label", binary_label(F.col("label")))
    tuned, _ = training.transfer(
        two, store.load(), "label", F.col("in_train"), 4, "vec_id", frozen=("project",), optimizer=training.AdamW(lr=3e-3), check_every=2
    )
    scored = models.score_multimodal(two.filter("NOT in_train"), tuned, "vec_id", models.INPUTS, "label")
    return metrics.class_metrics(scored.select("label", (F.array_position("probs", F.array_max("probs")) - 1).cast("int").alias("pred")))


@query(
    "SELECT doc_id, CASE WHEN m.s > 0 THEN round((n_chars - m.a) / m.s, 6) ELSE 0 END AS z FROM documents, "
    "(SELECT avg(n_chars) AS a, stddev_pop(n_chars) AS s FROM documents) m"
)
def q_model_store(spark, sf):
    """A scaler that was published, replaced by a wrong one, and brought back."""
    store, docs = ModelStore(spark, scratch_path(spark, "models")), load(spark, sf, "documents").select("doc_id", "n_chars")
    right = store.publish(fit_scaler(docs, ["n_chars"]))
    store.publish(fit_scaler(docs.filter("doc_id < 10"), ["n_chars"]))
    store.promote(right)
    return store.load().transform(docs, "_z").select("doc_id", F.round("n_chars_z", 6).alias("z"))
