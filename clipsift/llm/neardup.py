"""Near-duplicate groups by MinHash bands, Bayesian pruning and exact verification.

Texts with equal shingle sets form one class, represented once. Classes that share a band meet in
a bucket; first each is compared with its bucket's smallest member, then, where a bucket still
holds several components, the rest of its members with each other, in blocks of bounded size. A
pair's signature batches are compared one after another and it is dropped as soon as a similarity
at the threshold has less than ``MISS`` posterior probability. What is left is verified on full
shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsift.llm.common import BitMap, RollingHash, arrow_rows, lean, mixed, text_buffer, text_of
from clipsift.llm.components import roots
from clipsift.session import durable

SHINGLE = 5  # words
SIMILAR_PCT = 80
BANDS, ROWS = 40, 5  # a pair at 0.8 shares no band with probability 1.2e-7
BATCH = 40  # signature entries compared at a time
MISS = 1e-8
BLOCK = 2048  # members compared with each other in one block; each member goes to a task for every block of its bucket
MAP_BITS = 2048  # of the bit map of a set's hashes
_CHUNK = 1 << 18  # bytes of text handled at once, or one text


@lru_cache(maxsize=4)
def _hash(capacity: int) -> RollingHash:
    return RollingHash(21, capacity)


@lru_cache(maxsize=1)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(22)
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**64, n, dtype=np.uint64)


def _chunks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts fill a chunk."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + _CHUNK, side="right")) - 1
        last = min(max(last, first + 1), len(bounds) - 1)
        yield first, last
        first = last


def _word_ranges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: runs without an ASCII space, inside one text."""
    full = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts, ends = full.copy(), full.copy()
    starts[1:] &= ~full[:-1] | edge[1:-1]
    ends[:-1] &= ~full[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; the whole of shorter texts as one."""
    out: list[np.ndarray] = []
    odd = np.uint64(0xA0761D6478BD642F)
    for first, last in _chunks(bounds):
        own = bounds[first : last + 1] - bounds[first]
        part = data[bounds[first] : bounds[last]]
        part = np.where((part >= 65) & (part <= 90), part + 32, part).astype(np.uint8)
        hasher = _hash(1 << max(19, int(len(part)).bit_length()))
        starts, ends = _word_ranges(part, own)
        words = hasher.of(hasher.prefix(part), starts, ends)
        at = np.searchsorted(starts, own)
        grams = words.copy()
        for step in range(1, size):
            if len(words) > step:
                grams[:-step] = mixed(grams[:-step] * odd + words[step:])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            n = b - a
            if n >= size:
                out.append(np.unique(grams[a : b - size + 1]))
            elif n:
                whole = words[a : a + 1]
                for step in range(1, n):
                    whole = mixed(whole * odd + words[a + step : a + step + 1])
                out.append(mixed(whole + np.uint64(n)))
            else:
                out.append(words[:0])
    return out


def _set_ids(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of each set, sums over its members."""
    one = np.add.reduceat(mixed(flat ^ np.uint64(0x51ED270B4D2A1F37)), starts)
    two = np.add.reduceat(mixed(flat + np.uint64(0x3C6EF372FE94F82B)), starts)
    return one.view(np.int64), two.view(np.int64)


def _signatures(flat: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and one-byte signature entries of each set."""
    scale, shift = _permutations(bands * rows)
    small = np.empty((len(starts), bands * rows), dtype=np.uint8)
    keys = np.empty((len(starts), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(starts), band + 1, dtype=np.uint64)
        for p in range(band * rows, (band + 1) * rows):
            low = np.minimum.reduceat(flat * scale[p] + shift[p], starts)
            low = mixed(low)
            small[:, p] = low & np.uint64(255)
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + low)
        keys[:, band] = key
    return keys.view(np.int64), small


def _maps(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bit map of each set: one bit for the first bits of each member."""
    own = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(flat))))
    bits = np.zeros((len(starts), MAP_BITS), dtype=bool)
    bits[own, (flat >> np.uint64(64 - MAP_BITS.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(bits, axis=1)


def may_reach(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, pct: int) -> np.ndarray:
    """Which pairs of sets can reach the similarity: every bit of one alone is a member that the other lacks."""
    a, b = (np.ascontiguousarray(x).view(np.uint64) for x in (a, b))
    both = np.minimum(
        n_a - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64), n_b - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)
    )
    return 100 * both >= pct * (n_a + n_b - both)


def signatures(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, k (tells its texts apart), n, c1, c2 (size and fingerprints of the shingle set), keys, sig, map."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = shingle_sets(*text_buffer(batch.column("text")), shingle)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                some = np.flatnonzero(n)
                c1, c2 = np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.int64)
                keys = [None] * len(n)
                sigs, maps = [None] * len(n), [None] * len(n)
                if len(some):
                    flat = np.concatenate([sets[i] for i in some])
                    starts = np.concatenate([[0], np.cumsum(n[some])[:-1]])
                    c1[some], c2[some] = _set_ids(flat, starts)
                    own, small = _signatures(flat, starts, bands, rows)
                    for i, k, s, m in zip(some.tolist(), own, small, _maps(flat, starts)):
                        keys[i], sigs[i], maps[i] = k, s.tobytes(), m.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("k"), pa.array(n), pa.array(c1), pa.array(c2),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary()), pa.array(maps, pa.binary())],
                    names=["doc_id", "k", "n", "c1", "c2", "keys", "sig", "map"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    source = source.withColumn("k", F.xxhash64("doc_id", "text"))
    return source.mapInArrow(lean(sign), "doc_id long, k long, n long, c1 long, c2 long, keys array<long>, sig binary, map binary")


@lru_cache(maxsize=8)
def least_matches(entries: int, similar: float, miss: float, batch: int = BATCH) -> tuple[tuple[int, int], ...]:
    """(entries compared, matches needed to go on) after each batch.

    With a uniform prior, m matches among n put the chance that the true match rate reaches s at
    P(Binomial(n + 1, s) <= m). One-byte entries also match by chance, once in 256.
    """
    s = similar + (1 - similar) / 256
    out = []
    for n in range(batch, entries + 1, batch):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
        out.append((n, m))
    return tuple(out)


def likely(a: np.ndarray, b: np.ndarray, similar: float, miss: float = MISS) -> np.ndarray:
    """Pairs of signature rows that pass every batch, by index."""
    left = np.arange(len(a))
    matches, before = np.zeros(len(a), dtype=np.int64), 0
    for n, least in least_matches(a.shape[1], similar, miss):
        matches[left] += (a[left, before:n] == b[left, before:n]).sum(axis=1)
        left = left[matches[left] >= least]
        before = n
    return left


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _spokes(buckets: DataFrame, nodes: DataFrame, similar: float, miss: float) -> DataFrame:
    """Pairs (a, b) of a bucket's smallest member and another that pass the first batch.

    Unlike members go before pairs are made, so a bucket of texts that only share a passage does
    not give each of them a pair for every band.
    """
    hub = nodes.select(
        F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.expr(f"substring(sig, 1, {BATCH})").alias("hub_head")
    )
    met = buckets.filter("node <> hub").select("node", "n", "head", "hub").join(hub, "hub")
    met = met.filter(f"100 * least(n, hub_n) >= {round(100 * similar)} * greatest(n, hub_n)")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                heads = [_matrix(batch.column(c), BATCH) for c in ("head", "hub_head")]
                yield batch.select(["a", "b"]).take(pa.array(likely(*heads, similar, miss)))

    named = met.select(F.col("hub").alias("a"), F.col("node").alias("b"), "head", "hub_head")
    return named.mapInArrow(lean(prune), "a long, b long").distinct()


def _prune(pairs: DataFrame, nodes: DataFrame, width: int, pct: int, miss: float) -> DataFrame:
    """Pairs (a, b) whose sizes, signatures and bit maps allow the similarity."""
    side = nodes.select("node", "n", "sig", "map")
    joined = pairs.join(side.toDF("a", "na", "siga", "mapa"), "a").join(side.toDF("b", "nb", "sigb", "mapb"), "b")
    joined = joined.filter(f"100 * least(na, nb) >= {pct} * greatest(na, nb)")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = likely(_matrix(batch.column("siga"), width), _matrix(batch.column("sigb"), width), pct / 100, miss)
            batch = batch.take(pa.array(keep))
            if batch.num_rows:
                maps = [_matrix(batch.column(c), MAP_BITS // 8) for c in ("mapa", "mapb")]
                sizes = [batch.column(c).to_numpy() for c in ("na", "nb")]
                yield batch.select(["a", "b"]).filter(pa.array(may_reach(*maps, *sizes, pct)))

    return joined.select("a", "b", "na", "nb", "siga", "sigb", "mapa", "mapb").mapInArrow(lean(prune), "a long, b long")


def _blocks(members: DataFrame, width: int, pct: int, miss: float, forest: bool) -> DataFrame:
    """Likely pairs (key, a, b) of one bucket and different components.

    Members are dealt into blocks of about ``BLOCK``; every two blocks of a bucket meet once, so
    no task ever holds a bucket. Sorted rows stream through, one pair of blocks at a time. Two
    members are compared in the first bucket that they share. With ``forest``, a pair is left out
    if the pairs given before it in its two blocks connect its members.
    """

    def pairs(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(rows)
        if table.num_rows < 2:
            return None
        node, comp, n, block = (table.column(c).to_numpy() for c in ("node", "comp", "n", "block"))
        sig, bits = (_matrix(table.column(c).combine_chunks(), w) for c, w in (("sig", width), ("map", MAP_BITS // 8)))
        band = table.column("band")[0].as_py()
        keys = (table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(node), -1))
        across = len(np.unique(block)) > 1 or bool(table.column("i")[0].as_py() != table.column("j")[0].as_py())
        group = np.unique(comp, return_inverse=True)[1]  # components here, and what the given pairs join
        out_a, out_b = [], []
        for x in range(len(node) - 1):
            y = np.arange(x + 1, len(node))
            y = y[group[y] != group[x]]
            if across:
                y = y[block[y] != block[x]]
            y = y[100 * np.minimum(n[x], n[y]) >= pct * np.maximum(n[x], n[y])]
            y = y[~(keys[y, :band] == keys[x, :band]).any(axis=1)]  # met in an earlier band already
            if len(y):
                y = y[likely(np.broadcast_to(sig[x], (len(y), width)), sig[y], pct / 100, miss)]
            if len(y):
                y = y[may_reach(np.broadcast_to(bits[x], (len(y), bits.shape[1])), bits[y], np.full(len(y), n[x]), n[y], pct)]
            if len(y) and forest:
                y = y[np.unique(group[y], return_index=True)[1]]
                group[np.isin(group, group[y])] = group[x]
            if len(y):
                out_a.append(np.full(len(y), node[x]))
                out_b.append(node[y])
        if not out_a:
            return None
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        key = np.full(len(a), table.column("key")[0].as_py(), dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["key", "a", "b"]
        )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            key, i, j = (batch.column(c).to_numpy() for c in ("key", "i", "j"))
            new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(key)]):
                if a == b:
                    continue
                own = (key[a], i[a], j[a])
                if own != current:
                    if held and (found := pairs(held)) is not None:
                        yield found
                    held, current = [], own
                held.append(batch.slice(a, b - a))
        if held and (found := pairs(held)) is not None:
            yield found

    dealt = members.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", "comp", "n", "block", "sig", "map", "band", "keys",
    )
    ordered = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(lean(stream), "key long, a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, pct: int, shingle: int) -> DataFrame:
    """Pairs that reach the similarity on their full sets."""
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = durable(nodes.join(asked, "node").select("node", "n", "c1", "c2", "low", F.xxhash64("low").alias("h")), "asked")
    texts = BitMap(wanted, "h", 23)
    source = docs.select(
        F.xxhash64(F.col("doc_id").cast("long")).alias("h"), text_of(docs).alias("text")
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            whole = whole.filter(pa.array(texts.holds(whole.column("h").to_numpy())))
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = shingle_sets(*text_buffer(batch.column("text")), shingle)
                h = batch.column("h").to_numpy()
                some = [i for i, s in enumerate(found) if len(s)]
                if not some:
                    continue
                flat = np.concatenate([found[i] for i in some])
                n = np.array([len(found[i]) for i in some], dtype=np.int64)
                c1, c2 = _set_ids(flat, np.concatenate([[0], np.cumsum(n)[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (h[some], n, c1, c2)] + [pa.array([found[i].tobytes() for i in some], pa.binary())],
                    names=["h", "n", "c1", "c2", "members"],
                )

    made = source.mapInArrow(lean(sets), "h long, n long, c1 long, c2 long, members binary")
    with arrow_rows(docs.sparkSession, 2000):
        found = durable(made.join(wanted, ["h", "n", "c1", "c2"]).select("node", "members"), "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= pct * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    both = pairs.join(found.toDF("a", "x"), "a").join(found.toDF("b", "y"), "b")
    with arrow_rows(docs.sparkSession, 200):  # sets of long texts are wide rows
        return durable(both.select("a", "b", "x", "y").mapInArrow(lean(check), "a long, b long"), "verified")


def near_duplicates(
    docs: DataFrame, similar_pct: int = SIMILAR_PCT, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """Group documents whose shingle sets reach the similarity, directly or through others.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id is
    component_id). Texts without words, and null ones, have an empty set and stand alone. Rows that
    repeat a doc_id are grouped by their own texts, and classes with the same smallest doc_id count
    as linked. Null doc_ids are grouped like others, but are never a component_id unless a group
    has nothing else, and then all its rows are kept. An empty table gives no rows; other columns
    are not read.
    """
    return _grouped(docs, similar_pct, shingle, bands, rows, miss).drop("k", "root")


def _grouped(docs: DataFrame, similar_pct: int, shingle: int, bands: int, rows: int, miss: float) -> DataFrame:
    """As ``near_duplicates``, with k (tells rows of one doc_id with different texts apart) and the group's root."""
    similar, width = similar_pct / 100, bands * rows
    slim = docs.select("doc_id", "text")
    with arrow_rows(docs.sparkSession, 2000):
        signed = durable(signatures(slim, shingle, bands, rows), "signatures")
    # Rows of one class have equal keys and entries, so any of them will do.
    classes = signed.filter("n > 0").groupBy("n", "c1", "c2").agg(
        F.min("doc_id").alias("low"), F.first("keys").alias("keys"), F.first("sig").alias("sig"),
        F.first("map").alias("map"),
    )
    nodes = durable(classes.withColumn("node", F.coalesce("low", F.xxhash64("n", "c1", "c2"))), "nodes")

    entries = nodes.select("node", "n", F.expr(f"substring(sig, 1, {BATCH})").alias("head"), F.posexplode("keys").alias("band", "key"))
    hubs = entries.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("hub"))
    hubs = durable(hubs.filter("times > 1"), "hubs")
    shared = BitMap(hubs, "key", 24)
    buckets = durable(entries.filter(shared.marked("key")).join(hubs, "key"), "buckets")
    spokes = durable(_spokes(buckets, nodes, similar, miss), "spokes")
    likely_pairs = durable(_prune(spokes, nodes, width, similar_pct, miss), "likely")
    links = _verified(likely_pairs, slim, nodes, similar_pct, shingle)
    found = roots(links)

    # First a forest of the likely pairs of each bucket; where one of its pairs turns out not to be a
    # link, others that it stood for are looked at too.
    again: DataFrame | None = None
    for forest in (True, False):
        placed = buckets.filter("node <> hub").join(found, "node", "left").select(
            "key", "band", "node", "n", F.coalesce("root", "node").alias("comp")
        )
        if again is not None:
            placed = placed.join(again, "key", "left_semi")
        open_keys = placed.groupBy("key").agg(
            F.count(F.lit(1)).alias("members"), F.min("comp").alias("x"), F.max("comp").alias("y")
        ).filter("x <> y").select("key", "members")
        members = placed.join(open_keys, "key").join(nodes.select("node", "sig", "map", "keys"), "node")
        rest = durable(_blocks(members, width, similar_pct, miss, forest), "rest")
        asked = rest.select("a", "b").distinct()
        more = _verified(asked, slim, nodes, similar_pct, shingle)
        if more.limit(1).count():
            found = roots(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
        again = durable(rest.join(more, ["a", "b"], "left_anti").select("key").distinct(), "again")
        if again.isEmpty():
            break

    grouped = nodes.join(found, "node", "left").select("n", "c1", "c2", "low", F.coalesce("root", "node").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    of_class = grouped.join(lowest, "root").select("n", "c1", "c2", "root", "component_id")
    joined = signed.select("doc_id", "k", "n", "c1", "c2").filter("n > 0").join(of_class, ["n", "c1", "c2"])
    alone = signed.filter("n = 0").select(
        "doc_id", "k", "n", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id")
    )
    every = joined.select("doc_id", "k", "n", "root", "component_id").unionByName(alone)
    return every.select(
        "doc_id", "k", "root", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def without_near_duplicates(
    docs: DataFrame, similar_pct: int = SIMILAR_PCT, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """The documents, with all columns, of which each group keeps one.

    That is the one with the smallest doc_id (rows without one come last), of several such texts the
    one with the smallest fingerprint, and once if its row repeats. Texts without words stay. Only rows
    that may go, or repeat, are moved.
    """
    groups = _grouped(docs.select("doc_id", "text"), similar_pct, shingle, bands, rows, miss)
    worded = groups.filter("n_shingles > 0")
    first = worded.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("first"))
    texts = worded.groupBy("doc_id", "k").agg(F.max("root").alias("root"), F.count(F.lit(1)).alias("times"))
    stays = texts.join(first, "root").withColumn(
        "kept", (F.col("k") == F.col("first.k")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    )
    touched = durable(stays.filter("NOT kept OR times > 1").select("doc_id", "k", "kept"), "touched")
    marked = docs.withColumn("_k", F.xxhash64(F.col("doc_id").cast("long"), text_of(docs)))
    marked = marked.withColumn("_maybe", BitMap(touched, "k", 23).marked("_k"))
    maybe = marked.filter("_maybe")
    decided = maybe.join(
        touched.select(F.col("doc_id").alias("_d"), F.col("k").alias("_j"), F.col("kept").alias("_kept")),
        (F.col("_k") == F.col("_j")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_d")), "left",
    )
    free = decided.filter("_kept IS NULL")
    once = decided.filter("_kept").dropDuplicates(["doc_id", "_k"])
    return marked.filter("NOT _maybe").select(*docs.columns).unionByName(
        free.select(*docs.columns)).unionByName(once.select(*docs.columns))
