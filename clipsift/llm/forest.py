"""Nearest neighbours by inner product through a forest of random-projection trees.

Equal vectors are searched and found as one. Trees are grown on a bounded sample and sent to the
tasks; every vector is then put into its leaf of every tree. A query walks all trees with one
priority queue, best margin first, until the leaves it has met hold enough vectors. Leaves and the
queries that ask for them meet in blocks of bounded size, where scores are exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsift.session import durable

NEIGHBOURS = 20
TREES = 8
SAMPLE = 65_536  # vectors the trees are grown on, at most
LEAVES = 64  # of a tree, about; more would make every query meet more of them
BREADTH = 0.2  # share of the sample that the leaves a query visits must hold, over all trees
BLOCK = 4096  # vectors of a leaf that meet their queries in one block


class Forest:
    """Trees as flat arrays: a plane a node, children, and for leaves a number and a size."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int = 7):
        self.planes: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[tuple[int, int]] = []
        self.sizes: list[int] = []
        rng = np.random.default_rng(seed)
        self.roots = [self._grow(sample, np.arange(len(sample)), leaf, rng) for _ in range(trees)]
        self.planes = np.array(self.planes, dtype=np.float32).reshape(len(self.sizes), sample.shape[1])
        self.total = len(sample)

    def _node(self, plane: np.ndarray, offset: float, size: int) -> int:
        self.planes.append(plane)
        self.offsets.append(offset)
        self.children.append((-1, -1))
        self.sizes.append(size)
        return len(self.sizes) - 1

    def _grow(self, x: np.ndarray, own: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        if len(own) > leaf:
            for _ in range(4):
                direction = rng.standard_normal(x.shape[1]).astype(np.float32)
                direction /= np.linalg.norm(direction)
                at = x[own] @ direction
                middle = float(np.median(at))
                right = at > middle
                if right.any() and not right.all():
                    node = self._node(direction, middle, 0)
                    self.children[node] = (
                        self._grow(x, own[~right], leaf, rng), self._grow(x, own[right], leaf, rng)
                    )
                    return node
        return self._node(np.zeros(x.shape[1], dtype=np.float32), 0.0, max(1, len(own)))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.empty((len(x), len(self.roots)), dtype=np.int32)
        for t, root in enumerate(self.roots):
            todo = [(root, np.arange(len(x)))]
            while todo:
                node, own = todo.pop()
                left, right = self.children[node]
                if left < 0:
                    out[own, t] = node
                elif len(own):
                    over = x[own] @ self.planes[node] > self.offsets[node]
                    todo += [(left, own[~over]), (right, own[over])]
        return out

    def visit(self, q: np.ndarray, breadth: float, least: int) -> list[int]:
        """Leaves in the order of one queue over all trees, until they hold enough of the sample.

        Vectors of one tree's leaves are distinct, so the queue also goes on until one tree alone
        has shown ``least`` vectors, or all.
        """
        queue = [(-np.inf, root, tree) for tree, root in enumerate(self.roots)]
        wanted, met, out = breadth * self.total * len(self.roots), 0, []
        shown, least = [0] * len(self.roots), min(least, self.total)
        while queue and (met < wanted or max(shown) < least):
            bound, node, tree = heapq.heappop(queue)
            left, right = self.children[node]
            if left < 0:
                out.append(node)
                met += self.sizes[node]
                shown[tree] += self.sizes[node]
                continue
            margin = float(q @ self.planes[node]) - self.offsets[node]
            # The queue is ordered by how far a vector would lie beyond the planes behind it.
            heapq.heappush(queue, (max(bound, margin), left, tree))
            heapq.heappush(queue, (max(bound, -margin), right, tree))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up in the order of the components."""
    out = np.zeros((len(q), len(v)))
    for c in range(q.shape[1]):
        out += q[:, c : c + 1] * v[:, c]
    return out


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """(vec_id, v) of rows that take part; all have the table's most frequent dimension."""
    v = F.col(vec).cast("array<double>")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(fine & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0))


def neighbours(
    vectors: DataFrame, is_query, k: int = NEIGHBOURS, trees: int = TREES, breadth: float = BREADTH,
    sample: int = SAMPLE, leaves: int = LEAVES, block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest found for each query row: query_id, rank, vec_id, score.

    ``is_query`` is a condition on vec_id. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows without a vec_id or of an odd dimension. A repeated row
    counts once; a query never finds its own vec_id; ties go to the smaller vec_id; an empty table
    gives no rows; other columns are not read. The trees are grown on at most ``sample`` distinct
    vectors, chosen by hash; every vector is indexed. ``breadth`` is the share of all (tree,
    vector) places that a query's leaves hold.
    """
    spark = vectors.sparkSession
    rows = durable(usable(vectors).distinct(), "vectors")
    # More than k + 1 copies of one vector cannot all be found.
    copies = Window.partitionBy("v").orderBy("vec_id")
    first = rows.withColumn("c", F.row_number().over(copies)).filter(F.col("c") <= k + 1)
    classes = durable(
        first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("low", F.col("ids")[0]),
        "vector-classes",
    )
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    longest = classes.agg(F.max(norm2)).first()[0]
    if longest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    grown = classes.select("v").orderBy(F.xxhash64("low"), "low").limit(sample).toArrow()
    chosen = _matrix(grown.column("v").combine_chunks())
    leaf = max(16, -(-2 * len(chosen) // leaves) // 2)
    forest = spark.sparkContext.broadcast(Forest(_lifted(chosen, longest), trees, leaf))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = forest.value.leaves(_lifted(_matrix(batch.column("v")), longest))
            for t in range(found.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[:, t]), batch.column("low"), batch.column("v")], names=["leaf", "low", "v"]
                )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                q = _matrix(batch.column("v"))
                # Queries are lifted with 0: nearest by distance is then largest by inner product.
                q = np.concatenate([q * np.sqrt(longest / (q * q).sum(axis=1, keepdims=True)), np.zeros((len(q), 1))], axis=1)
                visited = [forest.value.visit(x, breadth, k + 1) for x in q.astype(np.float32)]
                own = np.repeat(np.arange(len(q)), [len(x) for x in visited])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(visited).astype(np.int32)), batch.column("low").take(pa.array(own)),
                     batch.column("v").take(pa.array(own))], names=["leaf", "low", "v"],
                )

    asking = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "v").join(classes.select("v", "low"), "v")
    asking = durable(asking.select("query_id", "low"), "queries")
    queries = classes.join(asking.select("low").distinct(), "low", "left_semi").select("low", "v")
    kind = "leaf int, low long, v array<double>"
    index = durable(classes.select("low", "v").mapInArrow(place, kind), "leaves")
    sizes = index.groupBy("leaf").count().select("leaf", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    placed = index.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64("low"), F.col("blocks")).cast("int"))
    probes = queries.repartition("low").mapInArrow(ask, kind).join(sizes, "leaf").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    meet = placed.select("leaf", "block", F.lit(0).alias("asks"), "low", "v").unionByName(
        probes.select("leaf", "block", F.lit(1).alias("asks"), "low", "v")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, names, held, stacked = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf_, block_, asks = (batch.column(c).to_numpy() for c in ("leaf", "block", "asks"))
            low, v = batch.column("low").to_numpy(), _matrix(batch.column("v"))
            cuts = np.flatnonzero((leaf_[1:] != leaf_[:-1]) | (block_[1:] != block_[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(low)]):
                own = (leaf_[a], block_[a])
                if own != current:
                    current, names, held, stacked = own, [], [], None
                if not asks[a]:
                    names.append(low[a:b])
                    held.append(v[a:b])
                    continue
                if not held:
                    continue
                if stacked is None:
                    stacked = np.concatenate(names), np.concatenate(held)
                for at in range(a, b, 256):
                    yield _best(low[at : min(at + 256, b)], v[at : min(at + 256, b)], *stacked, k + 1)

    ordered = meet.repartition("leaf", "block").sortWithinPartitions("leaf", "block", "asks")
    scored = ordered.mapInArrow(search, "q long, low long, score double").distinct()
    best = Window.partitionBy("q").orderBy(F.desc("score"), "low")
    # A query loses at most one of its candidates, itself.
    scored = scored.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
    named = scored.join(classes.select("low", "ids"), "low").select("q", "score", F.explode("ids").alias("vec_id"))
    found = asking.join(named, asking["low"] == named["q"]).filter("vec_id <> query_id")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", "vec_id", "score").withColumn("rank", F.row_number().over(ranked)).filter(
        F.col("rank") <= k
    ).select("query_id", "rank", "vec_id", "score")


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors brought to one length by a further component."""
    rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)


def _best(q_low, q, low, v, n) -> pa.RecordBatch:
    """Of a block, the ``n`` best for each query and all that tie with the last of them."""
    scores = _scores(q, v)
    if len(low) > n:
        least = np.partition(scores, len(low) - n, axis=1)[:, len(low) - n]
        row, col = np.nonzero(scores >= least[:, None])
        # Of ties with the last, only the smallest ids can be found.
        order = np.lexsort((low[col], -scores[row, col], row))
        row, col = row[order], col[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        row, col = row[rank < n], col[rank < n]
    else:
        row, col = (x.ravel() for x in np.indices(scores.shape))
    return pa.RecordBatch.from_arrays(
        [pa.array(q_low[row]), pa.array(low[col]), pa.array(scores[row, col])], names=["q", "low", "score"]
    )
