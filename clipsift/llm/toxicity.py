"""Toxicity by a subsequence-kernel support vector machine over windows of sentences.

The kernel counts the runs of four characters that two windows of text have in order, each gap paid
for by a decay, so an insult with inserted or missing characters stays close to its plain form; a
space is a character like any other. Labels are of whole documents. Which of their windows are
examples is told by short strings that go with the label beyond chance: windows of toxic documents
that hold one are bad, windows of clean documents that hold none are harmless, beginning with some
by chance and going on, in rounds, with those that the last machine took for the worst. Landmark
windows make a Nyström map, in which a linear machine is trained. As the kernel's features can be
written out, the landmarks and their weights collapse into one weight per feature, and every window
of a text is scored by sums over its own features. A text's score is calibrated on its worst window
and the number of places with a bad one.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.llm.common import give_back, lean, text_of, word_encoder
from clipsift.session import durable

MAX_TOXIC, MAX_CLEAN = 3000, 6000  # labelled documents learned from, at most
WINDOW = 12  # characters scored as one
STRINGS = (5, 8)  # lengths of the strings that mark examples
LEAST = 4  # toxic documents a string must be in
MAX_BAD, MAX_HARD = 4000, 4000  # bad windows, and hard ones a round, that the machine is trained on
BY_CHANCE, PER_TEXT = 2, 4  # windows of a clean document: some for a start, the worst in each round
LANDMARKS = 500
ROWS = 2000  # windows whose kernel values are held at once
ROUNDS = 3  # of training
ORDER, DECAY, SPAN = 4, 0.65, 6  # characters counted, weight of a position spanned, positions spanned
CODES = 32
FEATURES = CODES**ORDER
SPACE, DIGIT = 28, 27
FLOOR = -3.0  # values below count as this
REJECT = 0.3
CHUNK = 1 << 17  # characters handled at once; bounds a task's memory, whatever a text's length

# Letters set apart by spaces or marks, and words with marks inside.
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[\W_]{1,3}[^\W\d_](?![^\W_])){2,}")
_MARKED = re.compile(r"(?<![^\W_])[^\W_]++(?:(?:[^\w\s]|_)++[^\W_]++)++")
_INNER = re.compile(r"[\W_]+")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _codes() -> np.ndarray:
    """Letters without accents, digits and space have codes of their own, other characters share three."""
    table = 29 + np.arange(1 << 16) % 3
    for c in range(1 << 16):
        if 0xD800 <= c < 0xE000:
            continue
        if chr(c).isspace():
            table[c] = SPACE
            continue
        bare = unicodedata.normalize("NFKD", chr(c).lower())[0]
        if "a" <= bare <= "z":
            table[c] = ord(bare) - ord("a") + 1
        elif bare.isdigit():
            table[c] = DIGIT
    return table.astype(np.int32)


_CODE = _codes()
_PATTERNS = [(0, *inner, last) for last in range(ORDER - 1, SPAN) for inner in combinations(range(1, last), ORDER - 2)]
_NORM = sum((WINDOW - p[-1]) * DECAY ** (2 * p[-1]) for p in _PATTERNS) ** 0.5


def squeezed(text: str) -> str:
    """The text, then what its spaced letters and its words with marks inside spell without them."""
    extra = [_INNER.sub("", m[0]) for m in _SPACED.finditer(text)]
    extra += [_INNER.sub("", m[0]) for m in _MARKED.finditer(text)]
    return " ".join([text, *extra]) if extra else text


def encoded(text: str) -> np.ndarray:
    """Codes of a text between spaces, runs of white space as one, long enough for a window."""
    raw = np.frombuffer(squeezed(text).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _CODE[raw & 0xFFFF]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE)
    codes = codes[keep]
    out = np.full(max(len(codes) + 2, WINDOW), SPACE, dtype=np.int32)
    out[1 : len(codes) + 1] = codes
    return out


def _at(codes: np.ndarray, pattern: tuple[int, ...]) -> np.ndarray:
    """The features of a pattern of places, by the first place, as indices."""
    n = codes.shape[-1] - pattern[-1]
    index = codes[..., :n]
    for place in pattern[1:]:
        index = index * CODES + codes[..., place : n + place]
    return index


def window_values(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Inner product of the features of every window with the weights, by the window's first place."""
    out = []
    for first in range(0, max(1, len(codes) - WINDOW + 1), CHUNK):
        part = codes[first : first + CHUNK + WINDOW - 1]
        total = np.zeros(len(part) - WINDOW + 1)
        for last in range(ORDER - 1, SPAN):
            own = sum(weights[_at(part, p)] for p in _PATTERNS if p[-1] == last)
            sums = np.concatenate([[0.0], np.cumsum(own, dtype=np.float64)])
            n = WINDOW - last
            total += DECAY**last * (sums[n : n + len(total)] - sums[: len(total)])
        out.append(total / _NORM)
    return np.concatenate(out)


def features(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The written-out features of windows (a row each): indices, and the value at each place."""
    found = [(_at(windows, p), DECAY ** p[-1]) for p in _PATTERNS]
    index = np.concatenate([i for i, _ in found], axis=1)
    return index, np.concatenate([np.full(i.shape[1], w) for i, w in found]) / _NORM


def strings(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every string of the lengths ``STRINGS`` as a number, and where it begins."""
    keys, places = [], []
    for length in STRINGS:
        n = len(codes) - length + 1
        key = np.full(n, length, dtype=np.int64)
        for i in range(length):
            key = key * CODES + codes[i : n + i]
        keys.append(key)
        places.append(np.arange(n))
    return np.concatenate(keys), np.concatenate(places)


def _member(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), dtype=bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


def kernel(windows: np.ndarray, marks: np.ndarray, step: int = 50) -> np.ndarray:
    """Kernel values of windows (rows) and landmarks (columns)."""
    index, value = features(windows)
    out = np.empty((len(windows), len(marks)))
    for first in range(0, len(marks), step):
        own, _ = features(marks[first : first + step])
        used, at = np.unique(own, return_inverse=True)
        table = np.zeros((len(used) + 1, len(own)))
        np.add.at(table, (at.reshape(own.shape), np.arange(len(own))[:, None]), value)
        row = np.full(FEATURES, len(used), dtype=np.int32)
        row[used] = np.arange(len(used))
        part = np.zeros((len(windows), len(own)))
        for column, v in zip(index.T, value):
            part += v * table[row[column]]
        out[:, first : first + step] = part
    return out


def worst_windows(values: np.ndarray, n: int) -> list[int]:
    """Places of the highest values that do not overlap, best first."""
    values, out = values.copy(), []
    for _ in range(n):
        at = int(values.argmax())
        if values[at] == -np.inf:
            break
        out.append(at)
        values[max(0, at - WINDOW + 1) : at + WINDOW] = -np.inf
    return out


@dataclass
class Model:
    """Weights of features, bias of the machine, and the calibration of a text's score."""

    weights: np.ndarray
    bias: float
    scale: np.ndarray  # constant, worst window, bad places, length

    def text_features(self, texts: list[str]) -> np.ndarray:
        """Of each text: worst window's value, logarithms of the number of places with a bad one and of the length."""
        out = np.empty((len(texts), 3))
        codes = [encoded(t) for t in texts]
        out[:, 2] = np.log([len(c) for c in codes])
        first = 0
        while first < len(codes):
            # Texts that make up a chunk are read as one; windows that cross their ends are left out.
            last, size = first + 1, len(codes[first])
            while last < len(codes) and size + len(codes[last]) <= CHUNK:
                size += len(codes[last])
                last += 1
            begin = np.concatenate([[0], np.cumsum([len(c) for c in codes[first:last]])])
            values = window_values(np.concatenate(codes[first:last]), self.weights) + self.bias
            for end in begin[1:-1]:
                values[end - WINDOW + 1 : end] = -np.inf
            begin = begin[:-1]
            bad = values > 0
            bad[1:] &= ~bad[:-1]
            out[first:last, 0] = np.maximum(np.maximum.reduceat(values, begin), FLOOR)
            out[first:last, 1] = np.log1p(np.add.reduceat(bad, begin, dtype=np.int64))
            first = last
        return out

    def text_scores(self, found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] + found @ self.scale[1:], -30, 30)))


def _machine(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; the last column and weight are the bias.

    Sums are taken over blocks of rows, so that no second copy of ``x`` is made.
    """
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(30):
        gradient, hessian = ridge * w, np.diag(ridge)
        for first in range(0, len(x), ROWS):
            part, sign = x[first : first + ROWS].astype(np.float64), y[first : first + ROWS]
            margin = 1 - sign * (part @ w)
            active = margin > 0
            part = part[active]
            gradient = gradient - part.T @ (sign[active] * margin[active])
            hessian += part.T @ part
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _calibration(found: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a light ridge, by damped Newton steps."""
    x = np.concatenate([np.ones((len(found), 1)), found], axis=1)
    w = np.zeros(x.shape[1])
    ridge = np.array([1e-3] + [1e-2] * found.shape[1]) * max(1.0, weight.sum() / 1000)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w = w - step / max(1.0, np.abs(step).max())
    return w


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """Learn from at most ``max_toxic`` and ``max_clean`` labelled documents, chosen by hash.

    Only rows that are not held out are looked at. With labels of one kind only, every score is
    the same.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marks.filter("toxic = 1").orderBy(*by_hash).limit(max_toxic).unionByName(
        marks.filter("toxic = 0").orderBy(*by_hash).limit(max_clean)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).join(
        F.broadcast(chosen), "doc_id"  # max_toxic + max_clean rows of two numbers
    ).select("text", "toxic").distinct()
    model = _fit(durable(texts, "labelled"), sizes)
    give_back()  # the driver goes on to other stages
    return model


def _marking_strings(texts: DataFrame, pos: int, neg: int) -> np.ndarray:
    """Strings that go with the label beyond chance, sorted.

    Those of at least ``LEAST`` toxic documents of the sample are counted in the clean ones too.
    """
    def counted(label: int, among: Broadcast | None) -> DataFrame:
        def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [np.unique(strings(encoded(t))[0]) for t in batch.column("text").to_pylist()]
                if among is not None:
                    found = [x[_member(among.value, x)] for x in found]
                if found:
                    key, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

        rows = texts.filter(F.col("toxic") == label).select("text").mapInArrow(lean(seen), "key long, n long")
        return rows.groupBy("key").agg(F.sum("n").alias("n"))

    bad = counted(1, None).filter(F.col("n") >= LEAST).toArrow()  # strings of bounded texts, each in LEAST of them
    key, p = (bad.column(c).to_numpy() for c in ("key", "n"))
    by = np.argsort(key)
    key, p = key[by], p[by].astype(np.float64)
    q = np.zeros(len(key))
    clean = counted(0, texts.sparkSession.sparkContext.broadcast(key)).toArrow()
    q[np.searchsorted(key, clean.column("key").to_numpy())] = clean.column("n").to_numpy()

    def part(x: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return 2 * x * np.log(np.maximum(x, 1e-9) / np.maximum(expected, 1e-9))

    share, both = pos / (pos + neg), p + q
    strength = part(p, both * share) + part(q, both * (1 - share)) + part(pos - p, (pos + neg - both) * share) + part(
        neg - q, (pos + neg - both) * (1 - share)
    )
    beyond = strength > 2 * np.log(max(2, 10 * len(key)))  # what the best of so many reaches by chance
    return key[beyond & (p / np.maximum(both, 1) > min(0.9, share + 0.6 * (1 - share)))]


def _windows(texts: DataFrame, marks: np.ndarray, model: Model | None) -> DataFrame:
    """(toxic, value, window): the bad windows of toxic texts and some of clean ones, or clean ones' worst."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast((marks, model))  # a weight per feature: 4 MB

    def chosen(codes: np.ndarray, label: int) -> Iterator[tuple[float, int]]:
        marks, own = shared.value
        rng = np.random.default_rng(int(codes[: 4 * WINDOW].sum()) * 31 + len(codes))
        if own is not None:
            values = window_values(codes, own.weights) + own.bias
            yield from ((float(values[at]), at) for at in worst_windows(values, PER_TEXT))
            return
        if not label:
            yield from ((0.0, int(at)) for at in rng.integers(0, len(codes) - WINDOW + 1, BY_CHANCE))
            return
        key, place = strings(codes)
        last = -WINDOW
        for at in np.unique(place[_member(marks, key)]).tolist():
            if at - last >= WINDOW:
                last = at
                yield 0.0, min(max(0, at - int(rng.integers(0, WINDOW - STRINGS[0]))), len(codes) - WINDOW)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                codes = encoded(text)
                for value, at in chosen(codes, label):
                    window = codes[at : at + WINDOW]
                    if label or not _member(shared.value[0], strings(window)[0]).any():
                        rows.append((label, value, window.astype(np.uint8).tobytes()))
            columns = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.float64(), pa.binary()))],
                names=["toxic", "value", "window"],
            )

    return texts.mapInArrow(lean(read), "toxic int, value double, window binary").distinct()


def _taken(windows: DataFrame, order: list[Column], n: int) -> list[bytes]:
    return [r.window for r in windows.groupBy("window").agg(F.max("value").alias("value")).orderBy(*order, "window").limit(n).collect()]


def _fit(texts: DataFrame, sizes: dict[int, int]) -> Model:
    n = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    empty = Model(np.zeros(FEATURES, dtype=np.float32), 0.0, np.array([0.0 if pos else -3.0, 0.0, 0.0, 0.0]))
    if not pos or not neg:
        return empty
    marks = _marking_strings(texts, pos, neg)
    by_hash = [F.xxhash64("window")]
    first = durable(_windows(texts, marks, None), "windows")
    bad = _taken(first.filter("toxic = 1"), by_hash, MAX_BAD)
    harmless = dict.fromkeys(_taken(first.filter("toxic = 0"), by_hash, 2 * MAX_HARD))
    if not bad or not harmless:
        return empty
    clean, hard = texts.filter("toxic = 0"), list(harmless)
    model = _machine_of(bad, hard, hard)
    for _ in range(ROUNDS - 1):
        hard = _taken(_windows(clean, marks, model), [F.desc("value")], MAX_HARD)
        harmless.update(dict.fromkeys(hard))
        model = _machine_of(bad, list(harmless), hard)

    seen = _features(texts, model, ["toxic"]).toPandas()  # one short row per document of the sample
    label = seen["toxic"].to_numpy(float)
    own_weight = np.where(label > 0, sizes.get(1, pos) / pos, sizes.get(0, neg) / neg)
    model.scale = _calibration(seen[["worst", "bad", "size"]].to_numpy(float), label, own_weight)
    return model


def _machine_of(bad: list[bytes], harmless: list[bytes], hard: list[bytes]) -> Model:
    """Train on windows of both kinds; landmarks are spread over the bad, the hardest and all others."""
    def spread(windows: list[bytes], n: int) -> list[bytes]:
        return [windows[i] for i in np.unique(np.linspace(0, len(windows) - 1, min(n, len(windows))).astype(int))]

    half = LANDMARKS // 2
    chosen = list(dict.fromkeys(spread(bad, half) + spread(hard, half // 2) + spread(harmless, half // 2)))

    def codes(windows: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(windows), dtype=np.uint8).reshape(len(windows), WINDOW).astype(np.int32)

    marks, x = codes(chosen), codes(bad + harmless)
    y = np.array([1.0] * len(bad) + [-1.0] * len(harmless))
    among = kernel(marks, marks)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # the Nyström map
    mapped = np.ones((len(x), root.shape[1] + 1), dtype=np.float32)
    for first in range(0, len(x), ROWS):
        mapped[first : first + ROWS, :-1] = kernel(x[first : first + ROWS], marks) @ root
    w = _machine(mapped, y, penalty=0.05)
    weights = np.zeros(FEATURES)
    index, value = features(marks)
    np.add.at(weights, index, (root @ w[:-1])[:, None] * value)
    return Model(weights.astype(np.float32), float(w[-1]), np.array([0.0, 1.0, 1.0, 0.0]))


def _features(texts: DataFrame, model: Model, carried: list[str]) -> DataFrame:
    """Columns to carry, and each text's features and score."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = shared.value.text_features(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in carried], *map(pa.array, found.T), pa.array(shared.value.text_scores(found))],
                    names=[*carried, "worst", "bad", "size", "score"],
                )

    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in carried)
    return texts.select(*carried, "text").mapInArrow(lean(read), f"{kinds}, worst double, bad double, size double, score double")


def score_documents(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """Score every whole text: doc_id, held_out, score (0 to 1), predicted (1 from ``reject`` on).

    A null text counts as empty and has the score of a text without bad windows. Each row is scored
    by itself; null doc_ids are not held out; an empty table gives no rows; other columns are not
    read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    scored = _features(source, model, ["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= reject).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """The documents, with all columns, whose score stays below ``reject``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        word_encoder.cache_clear()  # as in ``lean``
        try:
            for texts in parts:
                own = [texts[i : i + 256].tolist() for i in range(0, len(texts), 256)]
                found = [shared.value.text_scores(shared.value.text_features(t)) for t in own]
                yield pd.Series(np.concatenate(found) if found else np.zeros(0))
        finally:
            give_back()

    return docs.filter(score(text_of(docs)) < reject)
