"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import re
import string
from array import array
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipsift.tables import load

# Entries a task's word cache may hold before it starts anew; bounds a Python worker's memory.
CACHE_WORDS = 400_000

# Entries of the word encoder's cache before they become its older half, and the half before them goes.
RECENT_WORDS = 300_000

# Bytes of text, but for the last text, that the word encoder cuts and looks up at once.
CACHE_BYTES = 1 << 22

_SPACE = " \t\n\r\v\f"

# Letters that normalisation only lower-cases.
_PLAIN_WORD = re.compile("^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$", re.MULTILINE)

_OTHER, _BLANK, _LETTER, _DIGIT, _MARK = range(5)


def _kinds(marks: str) -> bytes:
    """The kind of each byte of UTF-8 text."""
    kinds = bytearray([_OTHER] * 256)
    for kind, letters in ((_BLANK, _SPACE), (_LETTER, string.ascii_letters), (_DIGIT, string.digits), (_MARK, marks)):
        for byte in letters.encode():
            kinds[byte] = kind
    return bytes(kinds)


_MARKS = string.punctuation.replace("'", "")  # an apostrophe may begin a part of letters
_KINDS = _kinds(_MARKS)
# Where one of the tokenizer's own signs, such as <|endoftext|>, may stand: it stays whole.
_KINDS_BESIDE_SIGNS = _kinds(_MARKS.replace("|", ""))
# Bytes that end a Latin letter after 0xC3, all but the signs of multiplication and division.
_LATIN_ENDS = bytes(0x80 <= b < 0xC0 and b not in (0x97, 0xB7) for b in range(256))


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand tasks at most so many rows at once while a table of wide rows is written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine (installed on every executor)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


class WordEncoder:
    """Exact ids of the ``word_bpe`` tokenizer, part by part.

    Its normaliser and pre-tokenizer never join characters across white space, nor ASCII letters,
    digits and marks with each other, so a text's ids are the ids of such parts in a row. Texts are
    cut and looked up a few megabytes at once. Each distinct part goes through the library once
    per worker, while it is among those kept; a word of plain Latin letters goes straight to the
    library's merge model, which it reaches unchanged but for case. Ids are kept as little-endian
    32-bit bytes.
    """

    def __init__(self, path: str, cache_words: int = RECENT_WORDS):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.spelling = _byte_letters()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cache_words = cache_words

    @staticmethod
    def _lowered(texts: pa.Array) -> pa.Array:
        """Texts of Latin-1 in lower case, as normalisation would make them; so fewer words are distinct."""
        data, ends = text_buffer(texts)
        lowered = pc.utf8_lower(texts)
        wide = np.flatnonzero(data > 0xC3)  # these begin the characters after Latin-1
        if not len(wide):
            return lowered
        return pc.if_else(pa.array(np.diff(np.searchsorted(wide, ends)) == 0), lowered, texts)

    @staticmethod
    def _parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All parts, with the white space before them, and where each text's parts begin (and the last end)."""
        data, ends = text_buffer(texts)
        text = data.tobytes()
        kind = np.frombuffer(text.translate(_KINDS_BESIDE_SIGNS if b"<|" in text else _KINDS), dtype=np.uint8)
        blank, letter, digit, mark = (kind == k for k in (_BLANK, _LETTER, _DIGIT, _MARK))
        closes = letter  # a letter's last byte
        if not text.isascii():
            closes = letter.copy()
            closes[1:] |= (data[:-1] == 0xC3) & np.frombuffer(text.translate(_LATIN_ENDS), dtype=bool)[1:]
        begins = digit.copy()
        begins[1:] |= digit[:-1] | (blank[1:] > blank[:-1]) | (closes[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        begins[ends[:-1][ends[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        offsets = np.append(starts, len(data))
        parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
        return parts, np.searchsorted(starts, ends)

    def _learn(self, words: set[str]) -> None:
        cache, tokenize = self.cache, self.model.tokenize
        plain = _PLAIN_WORD.findall("\n".join(words))  # no word holds a line's end
        for word in plain:
            letters = word.lower()
            spelled = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.spelling)
            cache[word] = array("I", [t.id for t in tokenize(spelled)]).tobytes()
        if len(plain) < len(words):
            for word in words.difference(plain):
                ids = self.library.encode(word, add_special_tokens=False).ids
                cache[word] = array("I", ids).tobytes()

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of each word. Words not seen for long are forgotten."""
        if len(self.cache) > self.cache_words:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        found = list(map(cache.get, words))
        missing = {word for word, ids in zip(words, found) if ids is None}
        unseen = missing.difference(older)
        for word in missing.difference(unseen):
            cache[word] = older[word]
        if unseen:
            self._learn(unseen)
        return [cache[word] if ids is None else ids for word, ids in zip(words, found)]

    def _spelled(self, texts: pa.Array, end: bytes) -> Iterator[bytes]:
        parts, at = self._parts(self._lowered(texts))
        if not len(parts):
            yield from [end] * len(texts)
            return
        coded = parts.dictionary_encode()
        words = pc.ascii_ltrim_whitespace(coded.dictionary).to_numpy(zero_copy_only=False)
        ids = pa.array(self._ids(words.tolist()), pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[at].tolist()
        held = memoryview(data) if data is not None else b""
        for first, last in zip(at, at[1:]):
            yield b"".join((held[first:last], end))

    def encoded(self, texts: pa.Array, end_id: int | None = None) -> Iterator[bytes]:
        """The ids of each text of an Arrow column without nulls."""
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, before = 0, 0
        while at < len(texts):
            last = max(at + 1, int(np.searchsorted(ends, before + CACHE_BYTES, "right")))
            yield from self._spelled(texts.slice(at, last - at), end)
            at, before = last, int(ends[last - 1])

    def encode(self, texts: Iterable[str], end_id: int | None = None) -> list[bytes]:
        return list(self.encoded(pa.array(texts, pa.large_string()), end_id))


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One encoder a Python worker and tokenizer file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)


def give_back() -> None:
    """Return freed memory of this process to the system, which the allocators would keep for themselves."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


ArrowTask = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(task: ArrowTask, encodes: bool = False) -> ArrowTask:
    """The task for ``mapInArrow``, with nothing left over in its Python worker.

    Workers live on from stage to stage beside the executor's JVM. Unless the task ``encodes``, it
    begins by dropping the word encoder that an earlier one may have filled, and every task ends by
    returning what it freed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encodes:
            word_encoder.cache_clear()
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


class BitMap:
    """Hashed keys as a bit map whose size does not grow with the keys.

    A full map lets every row through, so it saves shuffling and never decides a result.
    ``column`` holds 64-bit hashes; their last bits are the places in the map.
    """

    def __init__(self, keys: DataFrame, column: str, log2_bits: int):
        self.mask = (1 << log2_bits) - 1
        at = F.col(column).bitwiseAND(self.mask)
        words = (
            keys.select(at.alias("at"))
            .select(
                F.shiftright("at", 6).alias("w"),
                F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("b"),
            )
            .groupBy("w")
            .agg(F.bit_or("b").alias("b"))
            .toArrow()  # 2**log2_bits / 64 rows at most
        )
        bits = np.zeros(1 << (log2_bits - 6), dtype=np.int64)
        bits[words["w"].to_numpy()] = words["b"].to_numpy()
        self.shared = keys.sparkSession.sparkContext.broadcast(bits)

    def __getstate__(self):
        return {"mask": self.mask, "shared": self.shared}

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """For each 64-bit hash, whether its key may be in the map."""
        at = hashes & self.mask
        return (self.shared.value[at >> 6] >> (at & 63)) & 1 == 1

    def marked(self, column: str) -> Column:
        """The same as a boolean column."""
        own = self

        @F.pandas_udf("boolean")
        def inside(hashes: pd.Series) -> pd.Series:
            return pd.Series(own.holds(hashes.to_numpy(np.int64)))

        return inside(F.col(column))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and where each text begins (and the last ends)."""
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), ends - ends[0]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


class RollingHash:
    """Fingerprints of byte strings from prefix sums, whole buffers at a time.

    A string's fingerprint is the sum of a table value of each byte times a power of an odd
    number, modulo 2**64, freed of its place and mixed.
    """

    def __init__(self, seed: int, capacity: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2**64, 256, dtype=np.uint64)
        base = int(rng.integers(0, 2**63)) * 8 + 5
        self.powers = _powers(base % 2**64, capacity + 1)
        self.inverse = _powers(pow(base, -1, 2**64), capacity + 1)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        sums = np.empty(len(data) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(self.table[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def of(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprints of data[starts:ends]."""
        return mixed((prefix[ends] - prefix[starts]) * self.inverse[starts])

    def every(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """Fingerprints of all strings of one length, by start."""
        n = max(0, len(prefix) - length)
        return mixed((prefix[length:] - prefix[:n]) * self.inverse[:n])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a multiply-and-shift finaliser)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x
