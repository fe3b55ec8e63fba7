"""Batches that plugged models get: bounded in padded tokens, results in the table's order."""

import numpy as np
import pytest

from clipsift.operators import models


@pytest.mark.parametrize("budget", [1, 7, 100])
def test_token_batches(budget):
    sizes = np.random.default_rng(budget).integers(0, 40, 300)
    batches = list(models.token_batches(sizes, budget))
    assert sorted(np.concatenate(batches).tolist()) == list(range(300))
    assert all(len(b) == 1 or len(b) * sizes[b].max() <= budget for b in batches)
    # As full as the longest text allows, so only the last may hold less.
    assert all((len(b) + 1) * max(1, sizes[b].max()) > budget for b in batches[:-1])
    assert list(models.token_batches(np.zeros(0, dtype=np.int64), budget)) == []


TEXTS = [None, "", "  ", "a b", "c", "huge " * 5000, *(" ".join(["w"] * (i % 30 + 1)) for i in range(400))]


def test_plugged_models_see_bounded_batches(spark):
    budget = 64

    def check(texts):
        longest = max(len(t.split()) for t in texts)
        if len(texts) > 1 and len(texts) * longest > budget:
            raise AssertionError(f"{len(texts)} texts of up to {longest} words")

    def encoder(texts):
        check(texts)
        return np.array([[len(t.split()), len(t)] for t in texts], dtype=np.float32)

    def predict(texts):
        check(texts)
        return [len(t.split()) % 2 for t in texts]

    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)
    out = models.encode_text(df, "text", 2, "emb", encoder, max_tokens=budget)
    out = models.classify(out, "text", predict=predict, max_tokens=budget)
    for r in out.collect():
        text = (TEXTS[r.id] or "").strip()
        n = len(text.split())
        assert (r.emb, r.pred) == ([float(n), float(len(text))], n % 2)
