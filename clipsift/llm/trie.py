"""Prefix trie of conversations by union-find over the longest common prefixes of sorted neighbours.

A conversation is the byte string of its turns' digests, cut into stretches of bounded length, so
that one conversation may hold any share of all turns. Distinct stretches are range-partitioned and
sorted; each block of rows takes its neighbours' common prefixes in descending depth, and every
union of two components makes, or widens, a branching node. A block's inner nodes are final. Those
on its two outer spines may go on in other blocks: they alone leave the block, with all that hangs
below them contracted into sums, and are merged by their path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipsift.llm.common import arrow_rows
from clipsift.operators.ordering import numbered, running_totals
from clipsift.session import durable

STRETCH = 256  # turns of one row
BLOCK = 4096  # rows of one forest
UNIT = 24  # bytes of a turn: 16 of its digest, 8 of its number of words
WORD = r"[^\x20\x09-\x0D]+"
GROUP, SHARED = 20, 4  # conversations that share a head, and the remainder that says how much of it
ROOT = "root"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_NODE = (
    "open boolean, level int, prefix string, depth int, low long, n long, kids long, leaves long, saved long, words long,"
    " key string, parent_low long, parent_id binary, id binary, above array<binary>"
)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, k, unit): every turn's place from 1 and its digest with its number of words, as hex text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text")
    )
    placed = numbered(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text"], "k")
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    words = F.lpad(F.hex(F.regexp_count("text", F.lit(WORD)).cast("long")), 16, "0")
    return placed.select("conv_id", "k", F.concat(F.substring(digest, 1, 32), words).alias("unit"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, place, unit) of the rebuilt conversations, and all conv_ids.

    The first h turns come from conversation conv_id - conv_id % 20, the rest are the own ones
    after the first h; h is the remainder of the id's checksum by 4.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    convs = turns.filter("k = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    heads = turns.filter(F.col("k") < SHARED).select(F.col("conv_id").alias("base"), "k", "unit")
    lengths = heads.groupBy("base").agg(F.max("k").alias("n"))
    convs = durable(convs.join(lengths, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken")
    ), "conversations")
    head = convs.join(heads, "base").filter("k <= h").select("conv_id", F.col("k").alias("place"), "unit")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("k > h").select(
        "conv_id", (F.col("k") - F.col("h") + F.col("taken")).alias("place"), "unit"
    )
    return head.unionByName(own), convs.select("conv_id")


def _stretches(places: DataFrame, stretch: int) -> DataFrame:
    """(conv_id, level, prefix, key, chunk, ends): each conversation in stretches of so many turns.

    ``prefix`` names all turns before the stretch, ``key`` all turns to its end: sums of
    fingerprints of the stretches, equal for equal beginnings.
    """
    at = F.col("place") - 1
    parts = places.groupBy("conv_id", F.floor(at / stretch).cast("int").alias("level")).agg(
        F.sort_array(F.collect_list(F.struct((at % stretch).alias("i"), "unit"))).alias("units")
    )
    parts = parts.select(
        "conv_id", "level", F.size("units").alias("size"),
        F.unhex(F.array_join(F.transform("units", lambda u: u["unit"]), "")).alias("chunk"),
    )
    one, two = F.xxhash64("level", "chunk"), F.xxhash64("chunk", F.lit(1), "level")
    low = F.lit(0xFFFFFFFF)
    pieces = {"f0": one.bitwiseAND(low), "f1": F.shiftrightunsigned(one, 32), "f2": two.bitwiseAND(low), "f3": F.shiftrightunsigned(two, 32)}
    parts = durable(parts.withColumns(pieces), "stretches")
    names = list(pieces)
    goes_on = parts.filter("level > 0").select("conv_id", (F.col("level") - 1).alias("level"), F.lit(True).alias("more"))
    parts = parts.join(goes_on, ["conv_id", "level"], "left").withColumn("ends", F.col("more").isNull()).drop("more")
    single = parts.filter("level = 0 AND ends").select(
        "conv_id", "level", F.lit("").alias("prefix"), F.concat_ws(".", *names).alias("key"), "chunk", "ends"
    )
    long_ = running_totals(parts.filter("level > 0 OR NOT ends"), ["conv_id"], ["level"], {f"s{n}": F.col(n) for n in names})
    several = long_.select(
        "conv_id", "level",
        F.when(F.col("level") == 0, "").otherwise(F.concat_ws(".", *[F.col(f"s{n}") - F.col(n) for n in names])).alias("prefix"),
        F.concat_ws(".", *[f"s{n}" for n in names]).alias("key"), "chunk", "ends",
    )
    return durable(single.unionByName(several), "keyed-stretches")


class _Forest:
    """The nodes of one block of sorted distinct stretches."""

    def __init__(self, level, prefix, chunks, n, low, key, leaves_below, saved_below, stretch):
        self.level, self.prefix, self.chunks, self.key, self.stretch = level, prefix, chunks, key, stretch
        self.leaves_below, self.saved_below = leaves_below, saved_below
        m = len(chunks)
        self.top = [len(c) // UNIT for c in chunks]
        words = [np.frombuffer(c, dtype=">u8")[2::3].astype(np.int64) for c in chunks]
        self.words = words
        self.sums = [np.concatenate([[0], np.cumsum(w)]) for w in words]
        self.left, self.right = list(range(m)), list(range(m))
        self.n, self.low = list(n), list(low)
        self.kids, self.leaves, self.saved = [0] * m, [0] * m, [0] * m
        self.row: list[int] = list(range(m))  # the row that ends at the node, or -1
        self.parent, self.parent_depth, self.finished = [-1] * m, [0] * m, []
        self.m = m
        self._unite()

    def _common(self, i: int) -> int:
        if self.level[i] != self.level[i + 1] or self.prefix[i] != self.prefix[i + 1]:
            return 0
        a, b = (np.frombuffer(c, dtype=np.uint64) for c in self.chunks[i : i + 2])
        size = min(len(a), len(b))
        differs = np.flatnonzero(a[:size] != b[:size])
        return int(differs[0] if len(differs) else size) // (UNIT // 8)

    def _unite(self) -> None:
        m = self.m
        common = [self._common(i) for i in range(m - 1)]
        up = list(range(m))  # union-find over rows
        node = list(range(m))  # the component's node, at its root

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for i in sorted(range(m - 1), key=lambda i: -common[i]):
            depth = common[i]
            if not depth:
                break
            x, y = find(i), find(i + 1)
            a, b = node[x], node[y]
            if self.top[a] == depth:  # sorted rows: only the left side can end or branch here already
                self._hang(b, a, depth)
                self.right[a] = self.right[b]
                self.n[a] += self.n[b]
                self.low[a] = min(self.low[a], self.low[b])
            else:
                new = len(self.top)
                self.top.append(depth)
                self.left.append(self.left[a])
                self.right.append(self.right[b])
                self.n.append(self.n[a] + self.n[b])
                self.low.append(min(self.low[a], self.low[b]))
                for part in (self.kids, self.leaves, self.saved, self.parent_depth):
                    part.append(0)
                self.row.append(-1)
                self.parent.append(-1)
                self._hang(a, new, depth)
                self._hang(b, new, depth)
                a = new
            up[y] = x
            node[x] = a
        for i in range(m):
            if up[i] == i:
                self._finish(node[i], 0)

    def outer(self, x: int) -> bool:
        """Whether other blocks may hold more of the node."""
        return self.left[x] == 0 or self.right[x] == self.m - 1

    def _finish(self, x: int, depth: int) -> None:
        """Nothing more joins ``x``; its chain goes up to the given depth."""
        self.parent_depth[x] = depth
        row = self.row[x]
        if row >= 0:
            self.leaves[x] += self.leaves_below[row]
            self.saved[x] += self.saved_below[row]
        if not self.outer(x) and not self.kids[x] and not self.leaves[x]:
            self.leaves[x] = 1
        self.finished.append(x)

    def _hang(self, x: int, parent: int, depth: int) -> None:
        self._finish(x, depth)
        self.parent[x] = parent
        own = 0
        if not self.outer(x):
            sums = self.sums[self.left[x]]
            own = (self.n[x] - 1) * int(sums[self.top[x]] - sums[depth])
            self.kids[parent] += 1
        self.leaves[parent] += self.leaves[x]
        self.saved[parent] += self.saved[x] + own

    def _ids(self, row: int) -> list[bytes]:
        """Names of a row's prefixes."""
        sha = hashlib.sha256(f"{self.level[row]}|{self.prefix[row]}|".encode())
        out = [sha.digest()[:16]]
        for t in range(len(self.words[row])):
            sha.update(self.chunks[row][t * UNIT : (t + 1) * UNIT])
            out.append(sha.copy().digest()[:16])
        return out

    def table(self) -> pa.RecordBatch:
        spine = {0: self._ids(0), self.m - 1: self._ids(self.m - 1)}
        out: list[tuple] = []
        for x in self.finished:
            first, open_ = self.left[x], self.outer(x)
            level, prefix, top, floor = self.level[first], self.prefix[first], self.top[x], self.parent_depth[x]
            ids = spine[0 if first == 0 else self.m - 1] if open_ else None
            above = self.parent[x]
            for t in range(floor + 1, top + 1):
                own = 0 if open_ else (self.n[x] - 1) * int(self.sums[first][top] - self.sums[first][t - 1])
                kids = self.kids[x] if t == top else int(not open_)
                parent_low = parent_id = None
                if t > floor + 1:
                    parent_low, parent_id = (None, ids[t - 1]) if open_ else (self.low[x], None)
                elif floor and self.outer(above):
                    parent_id = spine[0 if self.left[above] == 0 else self.m - 1][floor]
                elif floor:
                    parent_low = self.low[above]
                key = self.key[self.row[x]] if t == top and self.row[x] >= 0 else None
                out.append((
                    open_, level, prefix, level * self.stretch + t, self.low[x], self.n[x], kids, self.leaves[x],
                    self.saved[x] + own, int(self.words[first][t - 1]), key, parent_low, parent_id,
                    ids[t] if open_ else None, ids[1:t] if open_ else None,
                ))
        kinds = [pa.bool_(), pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.binary(), pa.binary(),
                 pa.list_(pa.binary())]
        names = [c.split()[0] for c in _NODE.split(",")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _nodes(classes: DataFrame, stretch: int, block: int) -> DataFrame:
    """All nodes of classes (level, prefix, chunk, key, n, low, leaves_below, saved_below), but the root."""
    columns = ["level", "prefix", "chunk", "n", "low", "key", "leaves_below", "saved_below"]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _Forest(*[batch.column(c).to_pylist() for c in columns], stretch).table()

    order = ["level", "prefix", "chunk"]
    ranged = classes.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    with arrow_rows(classes.sparkSession, block):
        found = durable(ranged.mapInArrow(grow, _NODE), "forests")
    # The outer spines of neighbouring blocks, merged where they are the same path.
    spines = found.filter("open").groupBy("id").agg(
        *[F.first(c).alias(c) for c in ("level", "prefix", "depth", "words", "parent_id", "above")],
        F.min("low").alias("low"), F.max("key").alias("key"), *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")],
    )
    spines = durable(spines, "spines")
    under = spines.filter("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("id")).agg(F.count(F.lit(1)).alias("more"))
    spines = spines.join(under, "id", "left").withColumn("kids", F.col("kids") + F.coalesce("more", F.lit(0))).drop("more")
    own = spines.select(
        F.explode(F.concat("above", F.array("id"))).alias("id"),
        ((F.col("kids") == 0) & (F.col("leaves") == 0)).cast("long").alias("own_leaf"),
        ((F.col("n") - 1) * F.col("words")).alias("own_saved"),
    ).groupBy("id").agg(F.sum("own_leaf").alias("own_leaves"), F.sum("own_saved").alias("own_saved"))
    names = spines.select(F.col("id").alias("parent_id"), F.col("low").alias("above_low"))
    keep = ["level", "prefix", "depth", "low", "n", "kids", "leaves", "saved", "words", "key", "parent_low"]
    merged = spines.join(own, "id").join(names, "parent_id", "left").withColumns({
        "leaves": F.col("leaves") + F.col("own_leaves"), "saved": F.col("saved") + F.col("own_saved"), "parent_low": F.col("above_low"),
    })
    inner = found.filter("NOT open")
    hanging = inner.filter("parent_id IS NOT NULL").join(names, "parent_id").withColumn("parent_low", F.col("above_low"))
    return inner.filter("parent_id IS NULL").select(*keep).unionByName(hanging.select(*keep)).unionByName(merged.select(*keep))


def _classes(parts: DataFrame, weights: DataFrame | None) -> DataFrame:
    """Equal stretches after equal beginnings as one, with what hangs below them at deeper levels."""
    zero = F.lit(0).cast("long")
    if weights is None:
        rows = parts.withColumns({"leaves_below": zero, "saved_below": zero})
    else:
        rows = parts.join(weights, ["conv_id", "level"], "left").withColumns(
            {c: F.coalesce(c, zero) for c in ("leaves_below", "saved_below")}
        )
    return durable(rows.groupBy("level", "prefix", "chunk", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.sum("leaves_below").alias("leaves_below"),
        F.sum("saved_below").alias("saved_below"),
    ), "classes")


def _below(parts: DataFrame, stretch: int, block: int) -> DataFrame | None:
    """(conv_id, level, leaves_below, saved_below) of conversations of several stretches.

    Each node of a deeper level gives its leaf and its saved words to its smallest member, whose
    stretches of the levels before carry them to the nodes there.
    """
    deep = parts.filter("level > 0")
    if deep.isEmpty():
        return None
    nodes = durable(_nodes(_classes(deep, None), stretch, block), "deep-nodes")
    goes_on = nodes.filter("level > 1").select(F.col("prefix").alias("key"), F.lit(True).alias("more")).distinct()
    gives = nodes.join(goes_on, "key", "left").groupBy(F.col("low").alias("conv_id"), "level").agg(
        F.sum(((F.col("kids") == 0) & F.col("more").isNull()).cast("long")).alias("leaf"),
        F.sum((F.col("n") - 1) * F.col("words")).alias("save"),
    )
    every = parts.filter("level > 0 OR NOT ends").select("conv_id", "level").join(gives, ["conv_id", "level"], "left")
    every = every.select("conv_id", "level", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("leaf", "save")])
    sums = running_totals(every, ["conv_id"], [F.desc("level")], {"leaves_to": F.col("leaf"), "saved_to": F.col("save")})
    return durable(sums.select(
        "conv_id", "level", (F.col("leaves_to") - F.col("leaf")).alias("leaves_below"),
        (F.col("saved_to") - F.col("save")).alias("saved_below"),
    ), "below")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ascending, comma-joined conv_ids of each key, as sorted rows stream by."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha = None, None
        for batch in batches:
            keys, shas = [], []
            for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if key != current:
                    if current is not None:
                        keys.append(current)
                        shas.append(sha.hexdigest())
                    current, sha = key, hashlib.sha256(str(conv).encode())
                else:
                    sha.update(f",{conv}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(shas, pa.string())], names=["key", "ends_sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])

    ordered = ends.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(digest, "key string, ends_sha256 string")


def conversation_trie(conversations: DataFrame, stretch: int = STRETCH, block: int = BLOCK) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Turns are ordered by turn (null first), then role and text; rows
    that repeat whole are turns of their own. Null roles and texts are empty; rows without a conv_id
    take no part. An empty table gives no rows; other columns are not read. Turns are told apart by
    128 bits of a digest of role and text.
    """
    places, convs = rebuilt(durable(turns_of(conversations), "turns"))
    parts = _stretches(places, stretch)
    weights = _below(parts, stretch, block)
    nodes = durable(_nodes(_classes(parts, weights), stretch, block), "nodes")

    # The top nodes of a deeper level hang below the last turn of the stretch before.
    tops = nodes.filter(F.col("depth") == F.col("level") * stretch + 1)
    last = nodes.filter((F.col("depth") % stretch == 0) & F.col("key").isNotNull()).select(F.col("key").alias("prefix"), F.col("low").alias("above_low"))
    more = tops.filter("level > 0").groupBy(F.col("prefix").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    linked = nodes.join(last, "prefix", "left").join(more, "key", "left")

    every = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    least = every.select(F.col("conv_id").alias("root_low")).scalar()
    under = tops.filter("level = 0").agg(
        F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("leaves"), F.lit(0)).alias("n_leaves"),
        F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"),
    )
    root = every.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        *[under.select(c).scalar().alias(c) for c in ("n_children", "n_leaves", "saved_tokens")], F.lit(ROOT).alias("key"),
    ).withColumn("n_leaves", F.greatest("n_leaves", F.lit(1)))
    parent: Column = F.coalesce("parent_low", F.when(F.col("level") == 0, least).otherwise(F.col("above_low")))
    rows = linked.select(
        F.col("low").alias("conv_id"), F.col("depth").cast("long").alias("depth"), parent.alias("parent_conv_id"),
        F.col("n").alias("n_convs"), (F.col("kids") + F.coalesce("more", F.lit(0))).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "key",
    ).unionByName(root)
    turnless = convs.join(parts.select("conv_id"), "conv_id", "left_anti").select(F.lit(ROOT).alias("key"), "conv_id")
    digests = durable(_end_digests(parts.filter("ends").select("key", "conv_id").unionByName(turnless)), "ends")
    return rows.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))).drop("key")
