"""Removal of byte strings that occur again, by prefix doubling on sampled positions.

A string that starts at two places is found by giving positions ranks for what stands behind them:
positions whose rank is unique drop out, the others are ranked anew over more bytes, until they
are unique or reach the threshold length. Ranks are fingerprints, so the rank of a longer string
is made from the text at hand, and only equal ranks have to meet, by sorting.

Ranking every position would move dozens of bytes per byte of text and round. The first rounds
therefore rank anchors: of each window of threshold length the position with the smallest
fingerprint of ``SEED`` bytes, which equal windows share, about one position in seventy.

1. Anchors by their first ``SEED`` bytes. A unique one takes all windows that it stands for out.
2. Anchors by the whole stretch of their windows. Equal stretches repeat as a whole; one of them
   goes on, if its seed has other stretches too.
3. Blocks of ``STEP`` windows, by the bytes that all windows of a block share. A unique one takes
   its windows out; blocks that are equal as a whole repeat as a whole, as above.
4. What is left position by position, by the threshold length.

A stage asks the one before through a bit map of bounded size. What it lets through by chance has
unique ranks later, so it costs a little work and changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsift.llm.common import BitMap, RollingHash, arrow_rows, lean, mixed, text_buffer, text_of
from clipsift.session import durable

THRESHOLD = 200
SEED = 64
STEP = 16  # windows in a block
SEGMENT = 1 << 17  # positions handled at once; bounds a task's memory, whatever a text's length
_PLACE_BITS = 18
_NO_ID = -(2**63)


@lru_cache(maxsize=4)
def _hashes(capacity: int) -> tuple[RollingHash, RollingHash]:
    return RollingHash(11, capacity), RollingHash(12, capacity)


def _sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys: from block ends backwards and forwards."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _segments(data: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """(bytes, first position, positions) of parts that overlap by a window."""
    for first in range(0, len(data), SEGMENT):
        part = data[first : first + SEGMENT + threshold - 1]
        if len(part) >= threshold:
            yield part, first, min(SEGMENT, len(part) - threshold + 1)


def anchors(
    data: np.ndarray, bounds: np.ndarray, threshold: int, seed: int, stretch: bool
) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of the windows that lie inside one text.

    Yields (row, first window, windows, seed rank[, stretch rank, anchor from first window]) a
    segment; ``bounds`` are the starts of the texts in ``data`` and the end of the last.
    """
    one, _ = _hashes(SEGMENT + 2 * threshold)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    for part, first, n in _segments(data, threshold):
        sums = one.prefix(part)
        seeds = one.every(sums, seed)
        keys = (seeds & ~low) | np.arange(len(seeds), dtype=np.uint64)
        place = (_sliding_argmin(keys, threshold - seed + 1)[:n] & low).astype(np.int64)
        cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
        inner = bounds[(bounds >= first) & (bounds <= first + n + threshold)] - first
        ends = np.concatenate([inner, inner - threshold + 1])
        starts = np.unique(np.concatenate([[0], cuts, ends[(ends > 0) & (ends < n)]]))
        stops = np.append(starts[1:], n)
        row = np.searchsorted(bounds, starts + first, side="right") - 1
        inside = starts + first + threshold <= bounds[row + 1]
        starts, stops, row = starts[inside], stops[inside], row[inside]
        found = (row, starts + first - bounds[row], stops - starts, seeds[place[starts]].view(np.int64))
        if stretch:
            found += (one.of(sums, starts, stops + threshold - 1).view(np.int64), place[starts] - starts)
        yield found


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """Ranks of byte ranges, none longer than two windows; ``second`` gives independent ones."""
    longest = int((ends - starts).max(initial=0))
    hasher = _hashes(SEGMENT + longest)[second]
    out = np.empty(len(starts), dtype=np.int64)
    segment = starts // SEGMENT
    for number in np.unique(segment):
        own = segment == number
        first = int(number) * SEGMENT
        sums = hasher.prefix(data[first : first + SEGMENT + longest])
        out[own] = hasher.of(sums, starts[own] - first, ends[own] - first).view(np.int64)
    return out


def blocks(
    data: np.ndarray, at: np.ndarray, n: np.ndarray, anchor: np.ndarray, threshold: int, step: int
) -> tuple[np.ndarray, ...]:
    """Blocks of the stretches that begin at ``at`` and hold ``n`` windows.

    Blocks are counted from the anchor, so equal windows fall into blocks alike. Returns (stretch,
    first window, windows, core rank, whole rank, whether the block has all its windows); the core
    is what every window of the block would hold.
    """
    low, high = -anchor // step, (n - 1 - anchor) // step
    count = high - low + 1
    of = np.repeat(np.arange(len(at)), count)
    number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + low[of]
    begin = (at + anchor)[of] + number * step
    first, last = np.maximum(begin, at[of]), np.minimum(begin + step, (at + n)[of])
    full = last - first == step
    core = fingerprints(data, begin + step - 1, begin + threshold)
    whole = np.zeros(len(of), dtype=np.int64)
    whole[full] = fingerprints(data, begin[full], begin[full] + threshold + step - 1)
    return of, first, last - first, core, whole, full


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts under a key that tells rows of one doc_id with different texts apart."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return source.withColumns({
        "d": F.coalesce("doc_id", F.lit(_NO_ID)), "k": F.xxhash64("doc_id", "text"),
    })


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that what is made of them stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _classes(rows: DataFrame, rank: str, whole: str) -> DataFrame:
    """Rows with equal ranks as one, how many they are, and whether their ``rank`` has others."""
    same = rows.groupBy(rank, whole).agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("d", "k", "lo", "n", "anchor", "asks")).alias("one")
    )
    return durable(same, "classes")


def _open(classes: DataFrame, rank: str) -> DataFrame:
    """One row of each class whose rank has other classes too; it asks if it is alone in its own."""
    several = classes.groupBy(rank).count().filter("count > 1").select(rank)
    return classes.join(several, rank, "left_semi").select(
        "one.d", "one.k", "one.lo", "one.n", "one.anchor", (F.col("one.asks") & (F.col("times") == 1)).alias("asks")
    )


def _repeated(rows: DataFrame, classes: DataFrame, rank: str, whole: str, threshold: int) -> DataFrame:
    """Byte ranges of asking rows that are not alone in their class."""
    often = classes.filter("times > 1").select(rank, whole)
    return rows.filter("asks").join(often, [rank, whole], "left_semi").select(
        "d", "k", "lo", (F.col("lo") + F.col("n") + threshold - 1).alias("hi")
    )


def repeated_ranges(
    docs: DataFrame, threshold: int = THRESHOLD, seed: int = SEED, step: int = STEP
) -> DataFrame:
    """(d, k, cuts): for rows with repeated windows, the byte ranges that these cover.

    ``cuts`` is an array of (lo, hi), in no order, perhaps overlapping; a row's ranges are bounded
    by its own length.
    """
    with arrow_rows(docs.sparkSession, 2000):
        return _ranges(docs, threshold, min(seed, threshold), min(step, threshold))


def _ranges(docs: DataFrame, threshold: int, seed: int, step: int) -> DataFrame:
    keyed = _keyed(docs).filter(F.octet_length("text") >= threshold)

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in anchors(*text_buffer(batch.column(0)), threshold, seed, False):
                yield _batch({"seed": found[3]})

    counted = keyed.select("text").mapInArrow(lean(seeds), "seed long").groupBy("seed").count()
    seed_map = BitMap(durable(counted.filter("count > 1").select("seed"), "seeds"), "seed", 24)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, k = (batch.column(c).to_numpy() for c in ("d", "k"))
            for found in anchors(*text_buffer(batch.column("text")), threshold, seed, True):
                row, lo, n, rank, whole, anchor = (x[seed_map.holds(found[3])] for x in found)
                yield _batch({
                    "seed": rank, "whole": whole, "d": d[row], "k": k[row], "lo": lo.astype(np.int32),
                    "n": n.astype(np.int32), "anchor": anchor.astype(np.int32),
                })

    found = keyed.select("d", "k", "text").mapInArrow(
        lean(stretches), "seed long, whole long, d long, k long, lo int, n int, anchor int"
    ).withColumn("asks", F.lit(True))
    classes = _classes(found, "seed", "whole")
    by_stretch = _repeated(found, classes, "seed", "whole", threshold)

    parts = durable(
        _open(classes, "seed").groupBy("d", "k").agg(F.collect_list(F.struct("lo", "n", "anchor", "asks")).alias("parts")),
        "open",
    )
    some = keyed.filter(BitMap(parts, "k", 23).marked("k"))
    texts = durable(some.join(parts, ["d", "k"]).select("d", "k", "text", "parts"), "open-texts")

    def pieces(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        """The blocks of the open stretches of a batch."""
        data, bounds = text_buffer(batch.column("text"))
        lists = batch.column("parts")
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        lo, n, anchor = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "n", "anchor"))
        asks = flat.field("asks").to_numpy(zero_copy_only=False)
        of, first, count, core, whole, full = blocks(data, bounds[row] + lo, n, anchor, threshold, step)
        d, k = (batch.column(c).to_numpy()[row][of] for c in ("d", "k"))
        place = first - bounds[row][of]
        # A block without all its windows is like no other.
        whole = np.where(full, whole, mixed((k ^ mixed(d.view(np.uint64)).view(np.int64)).view(np.uint64) + place.view(np.uint64)).view(np.int64))
        return {
            "core": core, "whole": whole, "d": d, "k": k, "lo": place.astype(np.int32), "n": count.astype(np.int32),
            "anchor": np.zeros(len(of), dtype=np.int32), "asks": asks[of], "at": first,
        }

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            yield _batch({"core": pieces(batch)["core"]})

    counted = texts.mapInArrow(lean(cores), "core long").groupBy("core").count()
    core_map = BitMap(counted.filter("count > 1"), "core", 24)

    def kept(batches: Iterator[pa.RecordBatch], through: BitMap | None = None) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            own = pieces(batch)
            keep = core_map.holds(own["core"])
            if through is not None:
                keep &= through.holds(own["k"] ^ own["lo"])
            yield _batch({c: x[keep] for c, x in own.items() if c != "at"})

    kind = "core long, whole long, d long, k long, lo int, n int, anchor int, asks boolean"
    found = texts.mapInArrow(lean(kept), kind)
    classes = _classes(found, "core", "whole")
    by_block = _repeated(found, classes, "core", "whole", threshold)
    left_open = _open(classes, "core").select(F.col("k").bitwiseXOR(F.col("lo").cast("long")).alias("p"))
    open_map = BitMap(left_open, "p", 23)

    single = texts.mapInArrow(lean(lambda b: kept(b, open_map)), kind)
    by_text = single.groupBy("d", "k").agg(F.collect_list(F.struct("lo", "n", "asks")).alias("parts"))
    left = durable(texts.select("d", "k", "text").join(by_text, ["d", "k"]), "last-texts")

    def windows(batches: Iterator[pa.RecordBatch], through: BitMap | None) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            data, bounds = text_buffer(batch.column("text"))
            lists = batch.column("parts")
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            lo, n = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "n"))
            of = np.repeat(np.arange(len(row)), n)
            at = (bounds[row] + lo)[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            if through is not None:
                asks = flat.field("asks").to_numpy(zero_copy_only=False)[of]
                of, at = of[asks], at[asks]
            one, two = (fingerprints(data, at, at + threshold, second) for second in (False, True))
            if through is None:
                yield _batch({"w1": one, "w2": two})
                continue
            keep = through.holds(one)
            d, k = (batch.column(c).to_numpy()[row][of][keep] for c in ("d", "k"))
            place = (at - bounds[row][of])[keep].astype(np.int32)
            yield _batch({"w1": one[keep], "w2": two[keep], "d": d, "k": k, "lo": place})

    ranks = left.mapInArrow(lean(lambda b: windows(b, None)), "w1 long, w2 long").groupBy("w1", "w2").count()
    again = durable(ranks.filter("count > 1").select("w1", "w2"), "windows")
    again_map = BitMap(again, "w1", 24)
    placed = left.mapInArrow(lean(lambda b: windows(b, again_map)), "w1 long, w2 long, d long, k long, lo int")
    by_window = placed.join(again, ["w1", "w2"], "left_semi").select(
        "d", "k", "lo", (F.col("lo") + threshold).alias("hi")
    )
    ranges = by_stretch.unionByName(by_block).unionByName(by_window)
    return durable(ranges.groupBy("d", "k").agg(F.collect_list(F.struct("lo", "hi")).alias("cuts")), "ranges")


def cut_out(text: bytes, cuts) -> tuple[bytes, int, int]:
    """The bytes outside all ranges, the number of those inside, and of their maximal runs."""
    marks = np.zeros(len(text) + 1, dtype=np.int32)
    for lo, hi in cuts:
        marks[lo] += 1
        marks[hi] -= 1
    gone = np.cumsum(marks[:-1]) > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])) if len(gone) else 0
    return np.frombuffer(text, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _with_cuts(docs: DataFrame, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have ranges, joined with them, and the others; only the first are moved."""
    key = {"_t": text_of(docs), "_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))}
    keyed = docs.withColumns(key)
    keyed = keyed.withColumn("_k", F.xxhash64(F.col("doc_id").cast("long"), "_t"))
    keyed = keyed.withColumn("_some", BitMap(ranges, "k", 23).marked("_k"))
    some = keyed.filter("_some").join(
        ranges.select(F.col("d").alias("_d"), F.col("k").alias("_k"), F.col("cuts").alias("_cuts")), ["_d", "_k"], "left"
    )
    return some, keyed.filter("NOT _some")


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Measure the removal of every byte covered by a ``threshold``-byte string that also starts elsewhere.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256. Strings are judged on the whole
    input, matches stay inside a row's text, and a repeated row is an occurrence like any other.
    A null text counts as empty, shorter texts lose nothing; null and repeated doc_ids are told
    apart by their texts; an empty table gives no rows; other columns are not read.
    """
    slim = docs.select("doc_id", "text")
    some, others = _with_cuts(slim, repeated_ranges(slim, threshold))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            made = [cut_out(t, c) for t, c in _texts_and_cuts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(kept) + removed for kept, removed, _ in made], pa.int64()),
                    pa.array([removed for _, removed, _ in made], pa.int64()),
                    pa.array([runs for *_, runs in made], pa.int64()),
                    pa.array([hashlib.sha256(kept).hexdigest() for kept, *_ in made], pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = slim.schema["doc_id"].dataType.simpleString()
    cut = some.select("doc_id", "_t", "_cuts").mapInArrow(
        lean(measure), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    whole = others.select(
        "doc_id", F.octet_length("_t").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("_t", 256).alias("kept_sha256"),
    )
    return cut.unionByName(whole)


def _texts_and_cuts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    for text, cuts in zip(batch.column("_t"), batch.column("_cuts").to_pylist()):
        yield text.as_buffer().to_pybytes(), [(c["lo"], c["hi"]) for c in cuts or ()]


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The documents with all columns, repeated strings cut out of their texts.

    A character of which a byte was cut goes whole. ``n_chars`` follows the text if it is there.
    """
    columns = docs.columns
    some, others = _with_cuts(docs, repeated_ranges(docs.select("doc_id", "text"), threshold))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = [cut_out(t, c)[0].decode("utf-8", "ignore") if c else t.decode() for t, c in _texts_and_cuts(batch)]
            at = batch.schema.get_field_index("_t")
            yield batch.set_column(at, "_t", pa.array(texts, pa.string()))

    changed = some.select(*columns, "_t", "_cuts").mapInArrow(lean(keep), some.select(*columns, "_t", "_cuts").schema)
    changed = changed.withColumn("text", F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(F.col("_t")))
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.when(F.col("_cuts").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return changed.select(*columns).unionByName(others.select(*columns))
