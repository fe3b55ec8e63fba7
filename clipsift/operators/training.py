"""Training of the fusion network by gradient sums over the partitions of a table.

Each step sends the weights to the tasks, which add up the gradients of blocks of their rows; the
sums are added in two rounds of a few tasks, and the driver makes one optimiser step. Rows never
leave their tasks, and the driver holds a few copies of the weights.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.operators.metrics import macro_f1
from clipsift.operators.models import HEADS, INPUTS, MAX_WEIGHT_BYTES, NORM_EPS, _arrays, _erf, _rebuilt, row_blocks, score_multimodal
from clipsift.session import durable

# Tasks that add up the gradients, round by round.
ROUNDS = (64, 8)
SUMS = "loss double, n long, gradient binary"

Back = Callable[[np.ndarray], np.ndarray]


def _linear(p, g, x: np.ndarray) -> tuple[np.ndarray, Back]:
    def back(dy: np.ndarray) -> np.ndarray:
        flat = dy.reshape(-1, dy.shape[-1])
        g[0][...] += x.reshape(-1, x.shape[-1]).T @ flat
        g[1][...] += flat.sum(axis=0)
        return dy @ p[0].T

    return x @ p[0] + p[1], back


def _norm(p, g, x: np.ndarray) -> tuple[np.ndarray, Back]:
    centred = x - x.mean(-1, keepdims=True)
    scale = 1 / np.sqrt((centred**2).mean(-1, keepdims=True) + NORM_EPS)
    unit = centred * scale

    def back(dy: np.ndarray) -> np.ndarray:
        g[0][...] += (dy * unit).reshape(-1, x.shape[-1]).sum(axis=0)
        g[1][...] += dy.reshape(-1, x.shape[-1]).sum(axis=0)
        du = dy * p[0]
        return scale * (du - du.mean(-1, keepdims=True) - unit * (du * unit).mean(-1, keepdims=True))

    return unit * p[0] + p[1], back


def _gelu(x: np.ndarray) -> tuple[np.ndarray, Back]:
    share = 0.5 * (1 + _erf(x * math.sqrt(0.5)))
    slope = share + x * np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    return x * share, lambda dy: dy * slope


def _attend(p, g, x: np.ndarray, memory: np.ndarray, heads: int) -> tuple[np.ndarray, Callable]:
    """Queries of ``x`` over ``memory``; going back gives the gradients of both."""
    n, width = len(x), x.shape[-1]
    split = lambda a: a.reshape(n, 2, heads, width // heads)
    (q, back_q), (k, back_k), (v, back_v) = (
        _linear(p[c], g[c], side) for c, side in (("q", x), ("k", memory), ("v", memory))
    )
    q, k, v = split(q), split(k), split(v)
    root = math.sqrt(width // heads)
    grade = np.einsum("nqhd,nkhd->nhqk", q, k) / root
    grade = np.exp(grade - grade.max(-1, keepdims=True))
    share = grade / grade.sum(-1, keepdims=True)
    out, back_o = _linear(p["o"], g["o"], np.einsum("nhqk,nkhd->nqhd", share, v).reshape(n, 2, width))

    def back(dy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = split(back_o(dy))
        d_share = np.einsum("nqhd,nkhd->nhqk", mixed, v)
        d_grade = share * (d_share - (d_share * share).sum(-1, keepdims=True)) / root
        whole = lambda a: a.reshape(n, 2, width)
        dx = back_q(whole(np.einsum("nhqk,nkhd->nqhd", d_grade, k)))
        dm = back_k(whole(np.einsum("nhqk,nqhd->nkhd", d_grade, q)))
        return dx, dm + back_v(whole(np.einsum("nhqk,nqhd->nkhd", share, mixed)))

    return out, back


def loss_and_gradient(weights: dict, inputs: Sequence[np.ndarray], labels: np.ndarray, heads: int = HEADS) -> tuple[float, dict]:
    """Sum of the cross-entropies of a batch, and its gradient in the shape of the weights."""
    grads = _rebuilt(weights, iter([np.zeros_like(a, dtype=float) for a in _arrays(weights)]))
    sides = []
    for (lin, scale), (g_lin, g_scale), x in zip(weights["project"], grads["project"], inputs):
        y, back_lin = _linear(lin, g_lin, x)
        y, back_gelu = _gelu(y)
        y, back_norm = _norm(scale, g_scale, y)
        sides.append((y, lambda d, a=back_lin, b=back_gelu, c=back_norm: a(b(c(d)))))
    video, audio, text, numeric = (y for y, _ in sides)
    x, memory = np.stack([text, numeric], 1), np.stack([video, audio], 1)
    backs = []
    for p, g in zip(weights["layers"], grads["layers"]):
        seen, back_a = _attend(p, g, x, memory, heads)
        x, back_1 = _norm(p["norm1"], g["norm1"], x + seen)
        up, back_up = _linear(p["up"], g["up"], x)
        up, back_gelu = _gelu(up)
        down, back_down = _linear(p["down"], g["down"], up)
        x, back_2 = _norm(p["norm2"], g["norm2"], x + down)
        backs.append((back_a, back_1, back_up, back_gelu, back_down, back_2))
    last, back_last = _norm(weights["norm"], grads["norm"], x)
    hidden, back_h0 = _linear(weights["head"][0], grads["head"][0], last.mean(1))
    hidden, back_hg = _gelu(hidden)
    logits, back_h1 = _linear(weights["head"][1], grads["head"][1], hidden)

    high = logits - logits.max(1, keepdims=True)
    probs = np.exp(high)
    total = probs.sum(1, keepdims=True)
    rows = np.arange(len(labels))
    loss = float((np.log(total[:, 0]) - high[rows, labels]).sum())
    d = probs / total
    d[rows, labels] -= 1
    d = back_h0(back_hg(back_h1(d)))
    dx = back_last(np.repeat(d[:, None, :] / 2, 2, axis=1))
    dm = np.zeros_like(memory)
    for back_a, back_1, back_up, back_gelu, back_down, back_2 in reversed(backs):
        dy = back_2(dx)
        dy = dy + back_up(back_gelu(back_down(dy)))
        dy = back_1(dy)
        from_x, from_m = back_a(dy)
        dx, dm = dy + from_x, dm + from_m
    for (_, back), part in zip(sides, (dm[:, 0], dm[:, 1], dx[:, 0], dx[:, 1])):
        back(part)
    return loss, grads


def _flat(weights: dict) -> np.ndarray:
    return np.concatenate([np.asarray(a, dtype=float).ravel() for a in _arrays(weights)])


def _shaped(flat: np.ndarray, like: dict) -> dict:
    parts, at = [], 0
    for a in _arrays(like):
        parts.append(flat[at : at + a.size].reshape(a.shape))
        at += a.size
    return _rebuilt(like, iter(parts))


def gradient_sum(
    df: DataFrame, weights: dict, label: str = "label", inputs: Sequence[str] = INPUTS, heads: int = HEADS
) -> tuple[float, int, dict]:
    """(loss, rows, gradient) summed over the whole table; rows with a null input or label are left out.

    An empty table gives zeros. The weights are refused beyond ``MAX_WEIGHT_BYTES``.
    """
    flat = _flat(weights)
    if flat.nbytes > MAX_WEIGHT_BYTES:
        raise ValueError(f"{flat.nbytes} bytes of weights are too many to send to every task")
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loss, n, total = 0.0, 0, np.zeros(len(flat))
        for batch in row_blocks(batches):
            arrays = [np.stack(batch[c].to_numpy()).astype(float) for c in inputs]
            own, grads = loss_and_gradient(sent.value, arrays, batch[label].to_numpy(np.int64), heads)
            loss, n = loss + own, n + len(batch)
            total += _flat(grads)
        if n:
            yield pd.DataFrame({"loss": [loss], "n": [n], "gradient": [total.tobytes()]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loss, n, total = 0.0, 0, np.zeros(len(flat))
        for batch in batches:
            for row in batch.itertuples():
                loss, n = loss + row.loss, n + row.n
                total += np.frombuffer(row.gradient)
        if n:
            yield pd.DataFrame({"loss": [loss], "n": [n], "gradient": [total.tobytes()]})

    whole = df.select(*inputs, label).dropna()
    sums = whole.mapInPandas(partial, SUMS)
    for tasks in ROUNDS:
        sums = sums.repartition(tasks).mapInPandas(added, SUMS)
    loss, n, total = 0.0, 0, np.zeros(len(flat))
    for row in sums.collect():  # ROUNDS[-1] rows at most
        loss, n = loss + row["loss"], n + row["n"]
        total = total + np.frombuffer(row["gradient"])
    sent.unpersist()
    return loss, n, _shaped(total, weights)


def new_head(weights: dict, classes: int, seed: int = 0) -> dict:
    """The network with a fresh last layer of so many classes; all other weights are the old ones."""
    rng = np.random.default_rng(seed)
    n_in = weights["head"][1][0].shape[0]
    last = (rng.normal(0.0, n_in**-0.5, (n_in, classes)), rng.normal(0.0, 0.02, classes))
    return {**weights, "head": [weights["head"][0], last]}


def _trained(weights: dict, frozen: Sequence[str]) -> np.ndarray:
    """1 for weights that a step may change, 0 for those of frozen parts (``head.0`` names a part of a part)."""
    def mark(part, name: str, free: bool):
        free = free and name not in frozen
        if isinstance(part, np.ndarray):
            return np.full(part.shape, float(free))
        inner = part.items() if isinstance(part, dict) else enumerate(part)
        made = {k: mark(v, f"{name}.{k}" if name else str(k), free) for k, v in inner}
        return made if isinstance(part, dict) else type(part)(made.values())

    return _flat(mark(weights, "", True))


@dataclass
class AdamW:
    """Adaptive steps with decoupled weight decay."""

    lr: float = 1e-3
    decay: float = 1e-2
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    t: int = 0
    moments: list = field(default_factory=lambda: [0.0, 0.0])

    def step(self, w: np.ndarray, g: np.ndarray, free: np.ndarray) -> np.ndarray:
        self.t += 1
        self.moments = [self.beta1 * self.moments[0] + (1 - self.beta1) * g, self.beta2 * self.moments[1] + (1 - self.beta2) * g * g]
        mean, square = self.moments[0] / (1 - self.beta1**self.t), self.moments[1] / (1 - self.beta2**self.t)
        return w - free * self.lr * (mean / (np.sqrt(square) + self.eps) + self.decay * w)


def train_network(
    df: DataFrame, weights: dict, label: str, train: Column, steps: int, key: str, inputs: Sequence[str] = INPUTS,
    optimizer: AdamW | None = None, frozen: Sequence[str] = (), slices: int = 1, check_every: int = 5, heads: int = HEADS,
) -> tuple[dict, list[tuple[int, float, float]]]:
    """Train on the rows where ``train`` holds; keep the weights with the best macro F1 on the others.

    Each step uses one of ``slices`` hash slices of the training rows, in turn, so that so many steps
    see every row once. Parts in ``frozen`` stay as they are. Returns (weights, history of (step, mean
    loss, macro F1)). The rows are written once, as every step reads them.
    """
    rows = durable(df.select(key, *inputs, label, train.alias("_train")), "training")
    fit_on, held_out = rows.filter("_train"), rows.filter("NOT coalesce(_train, false)").dropna(subset=[label, *inputs])
    optimizer, free, history, best = optimizer or AdamW(), _trained(weights, frozen), [], (-1.0, weights)
    for step in range(1, steps + 1):
        own = fit_on if slices == 1 else fit_on.filter(F.pmod(F.xxhash64(key), F.lit(slices)) == (step - 1) % slices)
        loss, n, grads = gradient_sum(own, weights, label, inputs, heads)
        if n:
            weights = _shaped(optimizer.step(_flat(weights), _flat(grads) / n, free), weights)
        if step % check_every == 0 or step == steps:
            scored = score_multimodal(held_out, weights, key, inputs, label, heads=heads)
            found = scored.select(F.col(label).alias("label"), (F.array_position("probs", F.array_max("probs")) - 1).alias("pred"))
            score = macro_f1(found).first()["macro_f1"] or 0.0
            history.append((step, loss / max(n, 1), score))
            if score > best[0]:
                best = (score, weights)
    return best[1], history


def transfer(
    df: DataFrame, base: dict, label: str, train: Column, steps: int, key: str, classes: int = 2,
    frozen: Sequence[str] = (), seed: int = 0, **options,
) -> tuple[dict, list[tuple[int, float, float]]]:
    """Warm start: the base network with a new last layer, trained further."""
    return train_network(df, new_head(base, classes, seed), label, train, steps, key, frozen=frozen, **options)
