"""Bounded-space online packing of token sequences.

Every partition keeps a fixed number of open windows. A piece goes to the window it fits best;
when it fits none, the fullest window is closed: as it is if little is missing, else filled with
the head of the piece, whose rest is placed anew. At the end of a partition the open windows are
merged into each other; at most one part-filled window is left. Those leftovers are merged in
rounds, a bounded number of partitions a task, until one is left.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsift.llm.common import lean, text_of, word_encoder
from clipsift.session import durable

WINDOW = 4096
OPEN_WINDOWS = 64
MAX_PADDING = 32  # ids that a closed window may lack
FAN_IN = 1024  # leftover windows merged in one task

_SCHEMA = (
    "round int, part int, local long, doc_id long, start long, length long, ids_crc32 long, "
    "doc_tokens long, offset long, ids binary"
)
_ARROW = pa.schema([
    ("round", pa.int32()), ("part", pa.int32()), ("local", pa.int64()), ("doc_id", pa.int64()),
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])

Piece = tuple  # doc_id, start, doc_tokens, ids as bytes


class Packer:
    """Best fit into a bounded number of open windows."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, max_padding: int = MAX_PADDING):
        self.window, self.open_windows, self.max_padding = window, open_windows, max_padding
        self.free: list[tuple[int, int]] = []  # (free ids, window number), ascending
        self.pieces: dict[int, list[Piece]] = {}
        self.opened = 0
        self.closed: list[list[Piece]] = []

    def _put(self, at: int, piece: Piece) -> None:
        free, number = self.free.pop(at)
        self.pieces[number].append(piece)
        free -= len(piece[3]) // 4
        if free:
            insort(self.free, (free, number))
        else:
            self.closed.append(self.pieces.pop(number))

    def _close_fullest(self) -> None:
        _, number = self.free.pop(0)
        self.closed.append(self.pieces.pop(number))

    @staticmethod
    def _cut(piece: Piece, n: int) -> tuple[Piece, Piece]:
        doc_id, start, total, ids = piece
        return (doc_id, start, total, ids[: 4 * n]), (doc_id, start + n, total, ids[4 * n :])

    def add(self, piece: Piece) -> None:
        while len(piece[3]) // 4 > self.window:
            head, piece = self._cut(piece, self.window)
            self.closed.append([head])
        size = len(piece[3]) // 4
        while size:
            at = bisect_left(self.free, (size, -1))
            if at < len(self.free):
                self._put(at, piece)
                return
            if len(self.free) < self.open_windows:
                insort(self.free, (self.window, self.opened))
                self.pieces[self.opened] = []
                self.opened += 1
            elif self.free[0][0] <= self.max_padding:
                self._close_fullest()
            else:
                head, piece = self._cut(piece, self.free[0][0])
                self._put(0, head)
                size = len(piece[3]) // 4

    def finish(self) -> list[Piece]:
        """Merge the open windows; the pieces of the one left part-filled, if there is one."""
        while len(self.free) > 1:
            if self.free[0][0] <= self.max_padding:
                self._close_fullest()
                continue
            _, emptiest = self.free.pop()
            for piece in self.pieces.pop(emptiest):
                while piece is not None and self.free:
                    size = len(piece[3]) // 4
                    at = bisect_left(self.free, (size, -1))
                    if at < len(self.free):
                        self._put(at, piece)
                        piece = None
                    else:
                        head, piece = self._cut(piece, self.free[0][0])
                        self._put(0, head)
                if piece is not None:
                    insort(self.free, (self.window - len(piece[3]) // 4, self.opened))
                    self.pieces[self.opened] = [piece]
                    self.opened += 1
        left = [p for _, number in self.free for p in self.pieces[number]]
        if left and self.free[0][0] <= self.max_padding:
            self.closed.append(left)
            left = []
        self.free, self.pieces = [], {}
        return left


def _rows(level: int, part: int, first: int, windows: list[list[Piece]], keep_ids: bool) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(10)]
    for number, pieces in enumerate(windows, first):
        offset = 0
        for doc_id, start, total, ids in pieces:
            size = len(ids) // 4
            row = (level, part, number, doc_id, start, size, zlib.crc32(ids), total, offset, ids if keep_ids else None)
            for col, value in zip(cols, row):
                col.append(value)
            offset += size
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)


def _pack(pieces: Iterator[Piece], level: int, part: int, packer: Packer, last: bool) -> Iterator[pa.RecordBatch]:
    done = 0
    for piece in pieces:
        packer.add(piece)
        if len(packer.closed) >= 512:
            yield _rows(level, part, done, packer.closed, False)
            done += len(packer.closed)
            packer.closed = []
    left = packer.finish()
    yield _rows(level, part, done, packer.closed, False)
    done += len(packer.closed)
    if left:
        yield _rows(level, part, done, [left], not last)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    max_padding: int = MAX_PADDING,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Pack every whole text, and an end id after each, into sequences of at most ``window`` ids.

    Returns a row a piece: doc_id, start (its document's ids before it), length, ids_crc32,
    doc_tokens, sequence_id, offset. A null text is only its end id; null and repeated doc_ids
    pack like others, each row by itself; an empty table gives no rows; other columns are not
    read. Only the very last sequence may lack more than ``max_padding`` ids.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        number = [0]

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    some = batch.slice(at, 256)
                    number[0] = some.column("part")[0].as_py()
                    texts = some.column("text").to_pylist()
                    for doc_id, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(texts, end_id)):
                        yield doc_id, 0, len(ids) // 4, ids

        packer = Packer(window, open_windows, max_padding)
        stream = pieces()
        head = next(stream, None)
        if head is None:
            return
        packer.add(head)
        yield from _pack(stream, 0, number[0], packer, False)

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"),
        F.spark_partition_id().alias("part"),
    )
    rows = durable(source.mapInArrow(lean(first, encodes=True), _SCHEMA), "packed")
    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    done, level = [rows.filter("ids IS NULL")], 0
    while True:
        level, parts = level + 1, -(-parts // fan_in)
        rows = durable(
            _merge(rows.filter("ids IS NOT NULL"), level, parts == 1, window, open_windows, max_padding, fan_in),
            "leftovers",
        )
        done.append(rows.filter("ids IS NULL"))
        if parts == 1:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    number = F.shiftleft(F.col("round").cast("long"), 58) + F.shiftleft(F.col("part").cast("long"), 32) + F.col("local")
    return out.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", number.alias("sequence_id"), "offset"
    )


def _merge(
    left: DataFrame, level: int, last: bool, window: int, open_windows: int, max_padding: int, fan_in: int
) -> DataFrame:
    """Pack the leftovers of ``fan_in`` tasks in one task; it leaves one window at most."""

    def merge(table: pa.Table) -> pa.Table:
        cols = [table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")]
        packer = Packer(window, open_windows, max_padding)
        batches = list(_pack(zip(*cols), level, table.column("group")[0].as_py(), packer, last))
        return pa.Table.from_batches(batches, schema=_ARROW)

    grouped = left.withColumn("group", F.expr(f"CAST(part DIV {fan_in} AS INT)"))
    ordered = grouped.select("group", "part", "doc_id", "start", "doc_tokens", "offset", "ids")
    return ordered.groupBy("group").applyInArrow(
        lambda table: merge(table.sort_by([("part", "ascending"), ("offset", "ascending")])), _SCHEMA
    )
