"""Token ids in wavelet-matrix shards: one succinct, searchable file a shard.

A shard holds the ids of whole documents. Its ids are kept as one bit plane per bit of the largest
id, most significant first; below each plane the ids with a 0 come first, then those with a 1.
A rank directory over each plane answers access, count and occurrence queries from the planes
alone, without unpacking the ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsift.llm.common import text_of, word_encoder
from clipsift.session import durable

# Ids a shard holds before it is closed after the current document.
SHARD_TOKENS = 1 << 20

_HEAD = struct.Struct("<4sIQIB")  # magic, documents, ids, checksum of what follows, planes
_MAGIC = b"WMX2"
_CODEC = pa.Codec("zstd", 1)
_BLOCK = 512  # bits between two entries of the rank directory
_PLACES = 1 << 15  # bits of a plane that are dealt to its two sides at once, within a core's cache


def _sides(bits: np.ndarray, zeros: int) -> Iterator[tuple[slice, np.ndarray, slice]]:
    """Some places at a time, those of zeros and of ones, and where they go: all zeros first, then the ones."""
    ends = [0, zeros]
    for at in range(0, len(bits), _PLACES):
        here = slice(at, at + _PLACES)
        some = bits[here]
        for side, which in enumerate((~some, some)):
            places = np.flatnonzero(which)
            first, ends[side] = ends[side], ends[side] + len(places)
            yield here, places, slice(first, ends[side])


class WaveletMatrix:
    """Rank and select over a sequence of unsigned integers."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: np.ndarray):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.width = len(planes)
        self._ranks: list[np.ndarray | None] = [None] * self.width

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        width = max(1, int(ids.max()).bit_length()) if n else 1
        rest = ids.astype(np.uint16 if width <= 16 else np.uint32)
        below = np.empty_like(rest)
        planes, zeros = [], np.zeros(width, dtype=np.int64)
        for level in range(width):
            bits = rest & rest.dtype.type(1 << (width - 1 - level)) != 0
            planes.append(np.packbits(bits, bitorder="little"))
            zeros[level] = n - np.count_nonzero(bits)
            for here, places, to in _sides(bits, int(zeros[level])):
                rest[here].take(places, out=below[to], mode="clip")
            rest, below = below, rest
        return cls(n, planes, zeros)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.n, bitorder="little")

    def _rank1(self, level: int, at: int) -> int:
        """Ones before position ``at`` of a plane: a directory entry and at most one block."""
        plane = self.planes[level]
        if self._ranks[level] is None:
            counts = np.bitwise_count(plane)
            whole = np.add.reduceat(counts, np.arange(0, len(plane), _BLOCK // 8), dtype=np.int64)
            self._ranks[level] = np.concatenate([[0], np.cumsum(whole)])
        block = at // _BLOCK
        ones = int(self._ranks[level][block])
        first, last = block * _BLOCK // 8, at // 8
        ones += int(np.bitwise_count(plane[first:last]).sum())
        if at % 8:
            ones += int(plane[last] & ((1 << at % 8) - 1)).bit_count()
        return ones

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(self.width):
            bit = int(self.planes[level][at // 8] >> (at % 8)) & 1
            ones = self._rank1(level, at)
            at = int(self.zeros[level]) + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _descend(self, value: int, first: int, last: int) -> tuple[int, int]:
        for level in range(self.width):
            a, b = self._rank1(level, first), self._rank1(level, last)
            if value >> (self.width - 1 - level) & 1:
                first, last = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, value: int, first: int = 0, last: int | None = None) -> int:
        """Occurrences of an id in positions first..last-1."""
        first, last = max(first, 0), self.n if last is None else min(last, self.n)
        if value < 0 or value >> self.width or last <= first:
            return 0
        a, b = self._descend(value, first, last)
        return b - a

    def locate(self, value: int) -> np.ndarray:
        """All positions of an id, ascending."""
        if value < 0 or value >> self.width or not self.n:
            return np.zeros(0, dtype=np.int64)
        at = np.arange(*self._descend(value, 0, self.n), dtype=np.int64)
        for level in reversed(range(self.width)):
            bits = self._bits(level)
            if value >> (self.width - 1 - level) & 1:
                at = np.flatnonzero(bits)[at - int(self.zeros[level])]
            else:
                at = np.flatnonzero(bits == 0)[at]
        return at

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of an id, -1 if there is none."""
        at = self.locate(value)
        return int(at[k]) if 0 <= k < len(at) else -1

    def all(self) -> np.ndarray:
        """Every id in order, rebuilt from the last plane upwards."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        values = np.zeros(self.n, dtype=kind)
        above = np.empty_like(values)
        for level in reversed(range(self.width)):
            values[int(self.zeros[level]) :] |= kind(1 << (self.width - 1 - level))
            for here, places, of in _sides(self._bits(level).view(bool), int(self.zeros[level])):
                above[here][places] = values[of]
            values, above = above, values
        return values.astype(np.uint32)


def pack_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A shard file: header, then compressed document ids, document lengths and bit planes."""
    wm = WaveletMatrix.build(ids)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    body = b"".join([
        known.tobytes(),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        np.array(lengths, dtype="<u4").tobytes(),
        wm.zeros.astype("<i8").tobytes(),
        *[p.tobytes() for p in wm.planes],
    ])
    body = _CODEC.compress(body, asbytes=True)
    return _HEAD.pack(_MAGIC, len(doc_ids), wm.n, zlib.crc32(body), wm.width) + body


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, lengths and the wavelet matrix of a shard file."""
    magic, docs, n, crc, width = _HEAD.unpack_from(data)
    body = data[_HEAD.size :]
    if magic != _MAGIC or zlib.crc32(body) != crc:
        raise ValueError("not a whole shard file")
    size = docs * (1 + 8 + 4) + width * (8 + (n + 7) // 8)
    body = _CODEC.decompress(body, size, asbytes=True)
    at = 0

    def take(count: int, kind: str) -> np.ndarray:
        nonlocal at
        part = np.frombuffer(body, dtype=kind, count=count, offset=at)
        at += part.nbytes
        return part

    known = take(docs, "u1")
    doc_ids = [int(d) if k else None for k, d in zip(known, take(docs, "<i8"))]
    lengths = take(docs, "<u4")
    zeros = take(width, "<i8")
    planes = [take((n + 7) // 8, "u1") for _ in range(width)]
    return doc_ids, lengths, WaveletMatrix(n, planes, zeros)


SHARD_SCHEMA = (
    "part int, seq int, n_docs long, n_tokens long, first_doc long, last_doc long, payload binary"
)


def write_shards(
    docs: DataFrame, tokenizer: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Encode every whole text, in ascending ``doc_id`` order, and write shard files.

    One row is one shard file (``payload``) with its place: ``part`` and ``seq`` ascend with
    doc_id. Rows are written once to the shared folder by Spark's own committer, so a lost
    executor leaves neither half a file nor two of them. A null text has only the end id; null
    doc_ids come first; repeated doc_ids stay apart, in no fixed order among themselves. A
    document is never cut, so a shard may exceed ``shard_tokens`` by its last document. An empty
    table gives no shard. Other columns of ``docs`` are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        source.repartitionByRange(n, F.col("doc_id").asc_nulls_first())
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        ids: list[bytes] = []
        names: list[int | None] = []
        held, seq, part = 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, seq
            lengths = [len(x) // 4 for x in ids]
            payload = pack_shard(names, lengths, np.frombuffer(b"".join(ids), dtype="<u4"))
            known = [x for x in names if x is not None]
            row = {
                "part": part, "seq": seq, "n_docs": len(names), "n_tokens": sum(lengths),
                "first_doc": known[0] if known else None,
                "last_doc": known[-1] if known else None, "payload": payload,
            }
            ids.clear()
            names.clear()
            held, seq = 0, seq + 1
            return pa.RecordBatch.from_pylist([row], schema=_arrow_shard())

        for batch in batches:
            parts = batch.column("part")
            part = parts[0].as_py() if len(parts) else part
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), encoder.encoded(batch.column("text"), end_id)):
                ids.append(own)
                names.append(doc_id)
                held += len(own) // 4
                if held >= shard_tokens:
                    yield close()
        if names:
            yield close()

    return durable(ranged.mapInArrow(shards, SHARD_SCHEMA), "token-shards")


def _arrow_shard() -> pa.Schema:
    return pa.schema([
        ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
        ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("payload", pa.binary()),
    ])


def shard_offsets(shards: DataFrame) -> DataFrame:
    """(part, seq, before): ids in all earlier shards.

    Totals per part are summed in one window (a row per range partition), shards inside a part
    in windows of their own.
    """
    per_part = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = per_part.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_p"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("_s"))
    return own.join(parts, "part").select("part", "seq", (F.col("_p") + F.col("_s")).alias("before"))


def read_shards(shards: DataFrame) -> DataFrame:
    """Documents as read back from shard files: doc_id, start, n_tokens, ids_crc32."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(
                batch.column("part").to_pylist(), batch.column("seq").to_pylist(), batch.column("payload")
            ):
                doc_ids, lengths, wm = open_shard(data.as_py())
                ids = memoryview(wm.all().astype("<u4").tobytes())
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(doc_ids), pa.int32()),
                        pa.array([seq] * len(doc_ids), pa.int32()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths.astype(np.int64), pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    rows = shards.select("part", "seq", "payload").mapInArrow(
        unpack, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long"
    )
    return rows.join(shard_offsets(shards), ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )
