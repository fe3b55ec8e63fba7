"""Hard negatives by threshold joins over an inverted index with norm bounds.

An anchor's positives are its best rows of the same label; the hard negatives of a positive are the
best rows of other labels whose score lies in a window below the positive's. Both are found by
joins that give every row scoring at least a threshold. Rows lie in blocks of bounded size, each
with an inverted index of its dimensions; the rest of a row's dimensions is left out of the index
where its norm alone cannot lift any anchor of the batch to its threshold. Partial scores add up
posting by posting, rows that no anchor can still want by the remaining norms go, and what is left
is scored exactly. Thresholds start from what one block holds and are lowered until every window
is full or reaches its lower end, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsift.session import durable

POSITIVES, NEGATIVES = 5, 3
LOW_PCT, HIGH_PCT = 50, 95  # of the positive's score
LEAST_BLOCK, MOST_BLOCK = 512, 32_768  # rows of a block
STEP = 8  # dimensions whose postings are added at once
ASKED = 256  # anchors of a batch
LOWEST, HIGHEST = -(2**63), 2**63 - 1


class BlockIndex:
    """Postings of one block's rows: dimensions by falling weight, and the norm of what follows each step."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        real = x.astype(np.float64)
        self.order = np.argsort(-(real**2).sum(axis=0), kind="stable")
        self.real = real[:, self.order]
        self.rest = _rest_norms(self.real)

    def above(self, rows: np.ndarray, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of every pair of an anchor and one of ``rows`` with score >= least[anchor]."""
        a = anchors.astype(np.float64)[:, self.order]
        a_rest = _rest_norms(a)
        steps = a_rest.shape[1] - 1
        wanted = least.astype(np.float64)
        wanted -= 1e-9 * np.abs(wanted) + 1e-6 + 1e-9 * a_rest[:, 0] * (self.rest[rows, 0].max() if len(rows) else 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(wanted <= 0, -np.inf, np.where(a_rest[:, 0] > 0, wanted / a_rest[:, 0], np.inf))
        lowest = share.min()
        # Steps of a row that the index holds: as long as what follows could reach a threshold.
        held = (self.rest[rows, :-1] >= lowest).sum(axis=1)
        by = np.argsort(-held, kind="stable")
        rows, held = rows[by], held[by]
        n = int((held > 0).sum()) if lowest > 0 else len(rows)
        rows, held = rows[:n], held[:n]
        partial = np.zeros((len(a), len(rows)))
        for s in range(steps):
            c = int(np.searchsorted(-held, -s, side="left"))  # rows with more than s steps
            if not c:
                break
            part = slice(s * STEP, (s + 1) * STEP)
            partial[:, :c] += a[:, part] @ self.real[rows[:c], part].T
            if s % 2 or s == steps - 1:
                at = np.minimum(held, s + 1)
                hopeful = (partial + a_rest[:, at] * self.rest[rows, at] >= wanted[:, None]).any(axis=0)
                if not hopeful.all():
                    rows, held, partial = rows[hopeful], held[hopeful], partial[:, hopeful]
        at = np.minimum(held, steps)
        anchor, place = np.nonzero(partial + a_rest[:, at] * self.rest[rows, at] >= wanted[:, None])
        row = rows[place]
        score = np.empty(len(row), dtype=np.int64)
        for i in range(0, len(row), 65_536):
            part = slice(i, i + 65_536)
            score[part] = np.einsum("ij,ij->i", anchors[anchor[part]], self.x[row[part]])
        fine = score >= least[anchor]
        return anchor[fine], row[fine], score[fine]


def _rest_norms(x: np.ndarray) -> np.ndarray:
    """Norm of each row from every step's first dimension on, and 0 at the end."""
    steps = -(-x.shape[1] // STEP)
    squares = np.add.reduceat(x * x, np.arange(0, x.shape[1], STEP), axis=1)
    out = np.zeros((len(x), steps + 1))
    out[:, :-1] = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _answers(index: BlockIndex, batch: pa.RecordBatch, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of a block in each window of the anchors of a batch."""
    labels, a = batch.column("label").to_numpy(), _matrix(batch.column("v"))
    low, high, names = (batch.column(c).to_pylist() for c in ("low", "high", "keys"))
    least = np.array([min(x) for x in low], dtype=np.int64)
    groups = [np.flatnonzero(labels == x) for x in np.unique(labels)] if same else [np.arange(len(labels))]
    q, keys, ids, scores = [], [], [], []
    for own in groups:
        rows = np.flatnonzero(index.labels == labels[own[0]]) if same else np.arange(len(index.ids))
        anchor, row, score = index.above(rows, a[own], least[own])
        if not same:
            other = index.labels[row] != labels[own][anchor]
            anchor, row, score = anchor[other], row[other], score[other]
        ends = np.searchsorted(anchor, np.arange(len(own) + 1))
        for i, (x, y) in enumerate(zip(ends[:-1], ends[1:])):
            for lo, hi, key in zip(low[own[i]], high[own[i]], names[own[i]]):
                at = x + np.flatnonzero((score[x:y] >= lo) & (score[x:y] <= hi))
                at = at[np.lexsort((index.ids[row[at]], -score[at]))[:k]]
                q += [int(own[i])] * len(at)
                keys += [key] * len(at)
                ids.append(index.ids[row[at]])
                scores.append(score[at])
    if q:
        yield pa.RecordBatch.from_arrays(
            [batch.column("q").take(pa.array(q, pa.int64())), pa.array(keys, pa.int64()), pa.array(np.concatenate(ids)),
             pa.array(np.concatenate(scores))], names=["q", "key", "id", "score"],
        )


def _threshold_join(asks: DataFrame, rows: DataFrame, blocks: Column, k: int, same: bool) -> DataFrame:
    """(q, key, id, score): of the rows in each window (key, low, high) of an ask, the ``k`` best.

    ``blocks`` are the blocks of rows that an ask meets. A task holds one block and streams asks.
    """
    none = F.array().cast("array<long>")
    meet = rows.select(
        "block", F.lit(0).alias("asks"), F.lit("").alias("q"), "id", "label", "v",
        none.alias("keys"), none.alias("low"), none.alias("high"),
    ).unionByName(asks.select(
        F.explode(blocks).alias("block"), F.lit(1).alias("asks"), "q", F.lit(0).cast("long").alias("id"), "label", "v",
        "keys", "low", "high",
    ))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, index = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            block, asks_ = (batch.column(c).to_numpy() for c in ("block", "asks"))
            cuts = (np.flatnonzero((block[1:] != block[:-1]) | (asks_[1:] != asks_[:-1])) + 1).tolist()
            for x, y in zip([0, *cuts], [*cuts, len(block)]):
                if block[x] != current:
                    current, held, index = block[x], [], None
                part = batch.slice(x, y - x)
                if not asks_[x]:
                    held.append((part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("v"))))
                    continue
                if index is None:
                    if not held:
                        continue
                    index = BlockIndex(*map(np.concatenate, zip(*held)))
                for at in range(0, part.num_rows, ASKED):
                    yield from _answers(index, part.slice(at, ASKED), k, same)

    ordered = meet.repartition("block").sortWithinPartitions("block", "asks")
    found = ordered.mapInArrow(search, "q string, key long, id long, score long")
    best = Window.partitionBy("q", "key").orderBy(F.desc("score"), "id")
    return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k)


def _filled(windows: DataFrame, classes: DataFrame, rows: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """(q, key, id, score, r): the ``k`` best rows in each window (q, key, floor, high), over all blocks.

    The first block shows where to start: from its middle answer, then from its last, if it fills
    the window, which all rows then do too, then from the window's lower end.
    """
    def asks(open_: DataFrame) -> DataFrame:
        one = F.sort_array(F.collect_list(F.struct("key", "t", "high")))  # a few windows an anchor
        packed = open_.groupBy("q").agg(one.alias("w"))
        return packed.join(classes, "q").select(
            "q", "label", "v", F.col("w.key").alias("keys"), F.col("w.t").alias("low"), F.col("w.high").alias("high")
        )

    first = durable(_threshold_join(
        asks(windows.withColumn("t", F.col("floor"))), rows.filter("block = 0"), F.array(F.lit(0)), k, same
    ), "first-block")
    if blocks == 1:
        return first
    seen = first.groupBy("q", "key").agg(
        F.max(F.when(F.col("r") == (k + 1) // 2, F.col("score"))).alias("middle"),
        F.max(F.when(F.col("r") == k, F.col("score"))).alias("last"),
    )
    left = windows.join(seen, ["q", "key"], "left").withColumn("t", F.coalesce("middle", "floor"))
    left = durable(left, "windows")
    done: DataFrame | None = None
    while True:
        found = durable(_threshold_join(asks(left), rows, F.sequence(F.lit(0), F.lit(blocks - 1)), k, same), "found")
        counted = left.join(found.groupBy("q", "key").agg(F.count(F.lit(1)).alias("n")), ["q", "key"], "left")
        full = (F.coalesce("n", F.lit(0)) >= k) | (F.col("t") == F.col("floor"))
        counted = durable(counted.withColumn("full", full), "windows")
        ready = found.join(counted.filter("full").select("q", "key"), ["q", "key"], "left_semi")
        done = ready if done is None else done.unionByName(ready)
        lower = F.when(F.col("last") < F.col("t"), F.col("last")).otherwise(F.col("floor"))
        left = counted.filter("NOT full").drop("n", "full").withColumn("t", lower)
        if left.isEmpty():
            return done


def integer_rows(vectors: DataFrame, label: Column, scale: int, vec: str = "embedding") -> DataFrame:
    """(id, label, v) of the rows that take part: components floor(scale * x), repeated rows once."""
    v = F.col(vec).cast("array<double>")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(fine).select(
        F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("v"),
    ).filter("id IS NOT NULL AND label IS NOT NULL").distinct()
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0))


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, scale: int = 256, positives: int = POSITIVES,
    negatives: int = NEGATIVES, low_pct: int = LOW_PCT, high_pct: int = HIGH_PCT, most_block: int = MOST_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``id`` and ``label`` an expression over ``vectors``. Components
    become floor(scale * x), scores are integer inner products (within 63 bits), higher first, ties
    by smaller id. Positives are the first rows of the anchor's label with another id; the negatives
    of a positive are the first rows of other labels with
    low_pct * positive_score <= 100 * negative_score <= high_pct * positive_score.

    Rows take no part if label, vec_id or vector is null, if a component is null or not finite, or
    if the dimension is not the table's most frequent one. A row that repeats whole counts once; rows
    that share an id otherwise are rows of their own. A positive without a negative in its window
    gives no row; an empty table gives none; other columns are not read. Copies of one vector and
    label beyond those that a result can hold are set aside, which changes nothing, so a vector that
    a third of the rows share is searched as a few.
    """
    spark = vectors.sparkSession
    every = durable(integer_rows(vectors, label, scale), "integer-vectors")
    most = max(positives + 1, negatives)
    copies = Window.partitionBy("label", "v").orderBy("id")
    rows = durable(every.withColumn("c", F.row_number().over(copies)).filter(F.col("c") <= most).drop("c"), "searched")
    n = rows.count()
    tasks = 2 * spark.sparkContext.defaultParallelism
    size = min(max(-(-n // tasks), LEAST_BLOCK), most_block)
    blocks = max(1, -(-n // size))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)).cast("int"))

    name = F.md5(F.concat_ws(",", F.col("label").cast("string"), F.col("v").cast("array<string>")))
    anchors = durable(every.filter(is_anchor).select("id", "label", name.alias("q"), "v"), "anchors")
    classes = durable(anchors.select("q", "label", "v").distinct(), "anchor-classes")
    whole = classes.select("q", F.lit(0).cast("long").alias("key"), F.lit(LOWEST).alias("floor"), F.lit(HIGHEST).alias("high"))
    best = _filled(whole, classes, rows, blocks, positives + 1, same=True)
    near = best.select("q", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    paired = anchors.select(F.col("id").alias("anchor_id"), "q").join(near, "q").filter("anchor_id <> positive_id")
    first = Window.partitionBy("anchor_id", "q").orderBy(F.desc("positive_score"), "positive_id")
    paired = durable(paired.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= positives).drop("r"), "positives")

    floor = F.expr(f"({low_pct} * positive_score + 99) DIV 100")
    ceiling = F.expr(f"({high_pct} * positive_score) DIV 100")
    windows = paired.filter("positive_score >= 0").select(
        "q", F.col("positive_score").alias("key"), floor.alias("floor"), ceiling.alias("high")
    ).distinct()
    found = _filled(durable(windows, "windows"), classes, rows, blocks, negatives, same=False)
    return paired.join(
        found.select("q", F.col("key").alias("positive_score"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
                     F.col("r").cast("int").alias("rank")),
        ["q", "positive_score"],
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
