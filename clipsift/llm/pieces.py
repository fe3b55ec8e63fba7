"""Merge-type subword encoding by a table of last tokens.

For every prefix of a text the last token of that prefix's encoding is unique. The table is filled
from left to right: an automaton finds the tokens that end at a position, and the longest one that
is compatible with the last token before it is stored. The ids are read off backwards from the end
of the text. Two tokens are compatible if the merge rules never join what meets at their bound. One pass, whatever the length of the text.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsift.llm.common import CACHE_WORDS, text_of

SPACE = "▁"


class PieceCodec:
    """Encodes and decodes like the sentencepiece library for a merge-type (BPE) model file.

    Pieces hold the space mark only at their start, and no piece holds a line break; both are
    checked, and let a text be encoded segment by segment: line breaks, and words with the space
    marks before them. Encoded segments are kept until ``cache_words`` are held.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.bytes_at: dict[int, int] = {}
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.texts: list[str] = [""] * size
        self.raw: dict[int, int] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes_at[value], self.raw[i] = i, value
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.scores[piece], self.ids[piece], self.texts[i] = sp.get_score(i), i, piece
        if len(self.bytes_at) != 256:
            raise ValueError("the model has no byte fallback")
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("pieces cross the bounds of words or lines")
        self.segments = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        # Marks that no piece has behind a letter: a word and the marks after it are coded apart.
        behind = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalpha()}
        self.marks = "".join(m for m in ".,;:!?" if m not in behind)
        self._automaton = None
        self.edges: dict[str, tuple[list, list]] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.cache_words = cache_words

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """Merge rules applied one by one: the best-scored pair first, the leftmost of equals.

        Ends early when ``stop`` parts are left.
        """
        parts = list(text)
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    @property
    def automaton(self):
        """All tokens that the merge rules can reach."""
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for piece in self.ids:
                if len(piece) > 1 and self.merge(piece) == [piece]:
                    found.add_word(piece, piece)
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def _edges(self, token: str) -> tuple[list, list]:
        """What stands at the left and right edge of a token while it is merged.

        Each is a list of (symbol, score of the merge that uses it up), characters first; nothing
        uses up the token itself.
        """
        known = self.edges.get(token)
        if known is not None:
            return known
        if len(token) == 1:
            made = ([(token, None)], [(token, None)])
        else:
            left, right = self.merge(token, stop=2)
            score = self.scores[token]
            a, b = self._edges(left)[0], self._edges(right)[1]
            made = (
                [*a[:-1], (left, score), (token, None)],
                [*b[:-1], (right, score), (token, None)],
            )
        self.edges[token] = made
        return made

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merge rules leave the bound between two tokens alone.

        Walks through the symbols that meet at the bound as both tokens are merged. They merge
        with each other if that merge has the better score, or an equal one further left.
        """
        key = (left, right)
        fits = self.fits.get(key)
        if fits is not None:
            return fits
        a, b, scores = self._edges(left)[1], self._edges(right)[0], self.scores
        i = j = 0
        while True:
            (x, x_used), (y, y_used) = a[i], b[j]
            score = scores.get(x + y)
            if score is not None and (x_used is None or score > x_used) and (y_used is None or score >= y_used):
                fits = False
                break
            if x_used is None and y_used is None:
                fits = True
                break
            if y_used is None or (x_used is not None and x_used >= y_used):
                i += 1
            else:
                j += 1
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        self.fits[key] = fits
        return fits

    def last_tokens(self, text: str) -> list[str]:
        """The last token of the encoding of each non-empty prefix.

        The longest compatible token that ends there; a character by itself if no other is.
        """
        last = list(text)
        settled, compatible = -1, self.compatible
        for end, token in self.automaton.iter(text):  # longest first at each end
            if end != settled:
                start = end + 1 - len(token)
                if not start or compatible(last[start - 1], token):
                    last[end] = token
                    settled = end
        return last

    def tokens(self, text: str) -> list[str]:
        """The encoding of one segment, recovered from its end."""
        last, out, at = self.last_tokens(text), [], len(text) - 1
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= len(token)
        out.reverse()
        return out

    def token_ids(self, token: str) -> list[int]:
        known = self.ids.get(token)
        return [known] if known is not None else [self.bytes_at[b] for b in token.encode()]

    def _segment(self, text: str) -> tuple[bytes, str]:
        tokens, known = self.tokens(text), self.ids
        try:
            found = [known[t] for t in tokens]
            spelled = "".join([self.texts[i] for i in found]).replace(SPACE, " ")
        except KeyError:
            found = [i for t in tokens for i in self.token_ids(t)]
            spelled = self._spell(found)
        return array("I", found).tobytes(), spelled

    def _learn(self, part: str) -> tuple[bytes, str]:
        word = part.rstrip(self.marks)
        if word != part and word[-1:].isalpha():
            known = self.cache.get(word) or self._learn(word)
            marks = self._segment(part[len(word) :])
            known = (known[0] + marks[0], known[1] + marks[1])
        else:
            known = self._segment(part)
        if len(part) <= 64:
            self.cache[part] = known
        return known

    def _spell(self, ids: Iterable[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            value = self.raw.get(i)
            if value is not None:
                raw.append(value)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.texts[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def _found(self, text: str) -> Iterator[tuple[bytes, str]]:
        if len(self.cache) > self.cache_words:
            self.cache.clear()
        if not text:
            return
        cache = self.cache
        for part in self.segments.findall(SPACE + text.replace(" ", SPACE)):
            known = cache.get(part)
            if known is None:
                known = self._learn(part)
            yield known

    def round_trip(self, text: str) -> tuple[bytes, str]:
        """Ids of a text with begin and end ids (little-endian 32-bit), and their decoding.

        A segment's decoding is spelled from its ids once and kept beside them.
        """
        found = list(self._found(text))
        ids = b"".join([x for x, _ in found])
        begin, end = (int(i).to_bytes(4, "little") for i in (self.begin, self.end))
        return begin + ids + end, "".join([x for _, x in found])[1:]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.round_trip(text)[0], dtype="<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: control ids say nothing, the space before the first word is left out."""
        plain = [i for i in ids if self.texts[i] or i in self.raw]
        text = self._spell(plain)
        return text[1:] if plain and self.texts[plain[0]].startswith(SPACE) else text


@lru_cache(maxsize=2)
def piece_codec(path: str) -> PieceCodec:
    """One codec a Python worker and model file."""
    return PieceCodec(path)


def encode_documents(docs: DataFrame, model: str, keep: bool = False) -> DataFrame:
    """Encode every whole text with begin and end ids and decode it again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``keep``, ids (array) and
    decoded. A null text counts as empty and gives just begin and end ids; each row is coded by
    itself, so null and repeated doc_ids stay; an empty table gives no rows; other columns are
    not read.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep else ""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n, hashes, spelled, ids, texts = [], [], [], [], []
                for text in batch.column("text"):
                    own, decoded = codec.round_trip(text.as_py())
                    n.append(len(own) // 4)
                    hashes.append(hashlib.sha256(own).hexdigest())
                    spelled.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if keep:
                        ids.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                        texts.append(decoded)
                cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hashes, pa.string()), pa.array(spelled, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return source.mapInArrow(code, schema)
