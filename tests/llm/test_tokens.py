"""Encoders, shards and packing against the libraries they must agree with."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clipsift.llm import common, packing, pieces, wavelet
from clipsift.llm.common import WordEncoder
from tests.llm.conftest import ODD_TEXTS


def u32(ids):
    return np.asarray(ids, dtype="<u4").tobytes()


def test_pieces_equal_the_library(piece_path, real_texts):
    codec = pieces.PieceCodec(piece_path, cache_words=500)
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    for text in [t for t in ODD_TEXTS if t is not None] + real_texts:
        ids = sp.encode(text, add_bos=True, add_eos=True)
        own, spelled = codec.round_trip(text)
        assert own == u32(ids)
        assert spelled == sp.decode(ids) == codec.decode(ids)


def test_pieces_single_segment_is_linear(piece_path):
    codec = pieces.PieceCodec(piece_path)
    assert len(codec.encode("tionthe" * 30_000)) > 1000


def test_encode_documents(spark, make_docs, with_clashes, piece_path):
    rows = list(enumerate(ODD_TEXTS)) + [(3, "again"), (None, "no id")]
    out = pieces.encode_documents(with_clashes(make_docs(rows)), piece_path).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_path)
    expected = []
    for doc_id, text in rows:
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        expected.append((doc_id, len(ids), hashlib.sha256(u32(ids)).hexdigest(),
                         hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, expected))
    assert pieces.encode_documents(make_docs([]), piece_path, keep=True).collect() == []


def test_words_equal_the_library(word_path, real_texts):
    library, own = Tokenizer.from_file(word_path), WordEncoder(word_path, cache_words=500)
    texts = [t for t in ODD_TEXTS if t is not None] + real_texts
    for text, ids in zip(texts, own.encode(texts)):
        assert ids == u32(library.encode(text, add_special_tokens=False).ids)


def test_words_are_learned_once_for_all_cases_and_texts(word_path):
    """Texts that are looked up together learn a word once, and its capital forms with it."""
    library, own = Tokenizer.from_file(word_path), WordEncoder(word_path)
    learned, learn = [], own._learn
    own._learn = lambda words: (learned.extend(words), learn(words))
    texts = ["Hello wORLD, ÉTÉ", "hello World, été", "HELLO world, Été", "ΑΣ Hello Σ. ß µ ª", "x\x1cY\x85Z\xa0z", "", "İx Hello"] * 3
    assert own.encode(texts, 1) == [u32(library.encode(t, add_special_tokens=False).ids + [1]) for t in texts]
    assert len(learned) == len(set(learned)) and sum(w.lower() == "hello" for w in learned) == 2  # Greek is left as it is


def test_parts_equal_the_library(word_path):
    """Marks, digits, signs of the tokenizer's own and combining characters, next to everything else."""
    library, own, rng = Tokenizer.from_file(word_path), WordEncoder(word_path, cache_words=300), np.random.default_rng(3)
    pieces_of = [*"abzZéÉß×÷ºµ09 \t\n\r\x0b\x0c\x1c\x85\xa0'.,!?|<>=`-_(\"/~\u0338\u0301\u0327\u20e3\u2003\u3000İſKΑΣς中가\u200d\x00٣½ﬁ",
                 "<|startoftext|>", "<|endoftext|>", "<|endof", "text|>", "'s", "'re", "don't", "Hello", "4.5", "<||>"]
    for k in range(300):
        texts = ["".join(rng.choice(pieces_of, rng.integers(0, 12))) for _ in range(10)]
        texts = [t.encode("latin-1", "ignore").decode("latin-1") for t in texts] if k % 3 == 0 else texts
        for text, ids in zip(texts, own.encode(texts, 7)):
            assert ids == u32(library.encode(text, add_special_tokens=False).ids + [7]), text


def test_a_word_is_learned_once_whatever_stands_beside_it(word_path):
    own, learned = WordEncoder(word_path), []
    learn = own._learn
    own._learn = lambda words: (learned.extend(words), learn(words))
    own.encode(["harbour harbour, (harbour) \"harbour\"... Harbour?!\nharbour/harbour; harbour 17 harbour17 71", "été, été. ÉTÉ!"])
    assert [w for w in learned if "harbour" in w] == ["harbour"] and [w for w in learned if "é" in w] == ["été"]
    assert len(learned) == len(set(learned)) and {"1", "7"} <= set(learned) and "17" not in learned


def test_words_in_use_are_kept_when_others_are_forgotten(word_path):
    own, learned = WordEncoder(word_path, cache_words=20), []
    learn = own._learn
    own._learn = lambda words: (learned.extend(words), learn(words))
    for k in range(200):
        own.encode(["anchor " + " ".join(chr(97 + k // 26) + chr(97 + k % 26) + c for c in "abcde")])
    assert learned.count("anchor") == 1 and len(learned) == 1 + 200 * 5
    assert len(own.cache) + len(own.older) <= 2 * (20 + 6)


def test_texts_are_cut_a_few_at_a_time(word_path, monkeypatch):
    """So that a task holds the parts of some texts only, however many rows a batch has."""
    own, seen = WordEncoder(word_path), []
    spelled = own._spelled
    own._spelled = lambda texts, end: (seen.append(len(texts)), spelled(texts, end))[1]
    monkeypatch.setattr(common, "CACHE_BYTES", 10)
    texts = ["", "one two", "three", "four five six seven", "", "8", "nine"]
    assert own.encode(texts, 1) == WordEncoder(word_path).encode(texts, 1) and seen == [2, 1, 1, 3]
    sliced = pa.array(["left out", *texts, "too"]).slice(1, len(texts))
    assert list(own.encoded(sliced, 1)) == own.encode(texts, 1)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 513, 70_001])
def test_shard_of_any_length(n):
    ids = np.random.default_rng(n).integers(0, 1 << (10 + n % 9), n).astype("<u4")
    docs, lengths, wm = wavelet.open_shard(wavelet.pack_shard([5, None], [n - 1, 1], ids))
    assert docs == [5, None] and lengths.tolist() == [n - 1, 1] and (wm.all() == ids).all() and wm.access(n - 1) == ids[-1]


@pytest.mark.parametrize("ids", [[], [0], [5, 5, 5], list(range(1000)) * 3, [70_000, 1, 2, 70_000]])
def test_wavelet_matrix(ids):
    data = wavelet.pack_shard([4, None], [len(ids), 0], np.array(ids, dtype="<u4"))
    docs, lengths, wm = wavelet.open_shard(data)
    assert docs == [4, None] and lengths.tolist() == [len(ids), 0]
    assert wm.all().tolist() == ids
    for at in range(0, len(ids), 97):
        assert wm.access(at) == ids[at]
    for value in {*ids[:20], 3, 99_999}:
        places = [i for i, x in enumerate(ids) if x == value]
        assert wm.locate(value).tolist() == places
        assert wm.count(value) == len(places)
        assert wm.count(value, 1, 50) == sum(1 <= i < min(50, len(ids)) for i in places)
        assert [wm.select(value, k) for k in range(len(places) + 1)] == [*places, -1]


def test_damaged_shard_is_refused():
    data = wavelet.pack_shard([1], [2], np.array([3, 4], dtype="<u4"))
    with pytest.raises(ValueError):
        wavelet.open_shard(data[:-1])


def test_shards_read_back(spark, make_docs, with_clashes, word_path, real_texts):
    rows = [(100 - i, t) for i, t in enumerate(ODD_TEXTS)] + [(1000 + i, t) for i, t in enumerate(real_texts)]
    shards = wavelet.write_shards(with_clashes(make_docs(rows, 3)), word_path, shard_tokens=5000)
    assert shards.count() > 4
    out = {r.doc_id: r for r in wavelet.read_shards(shards).collect()}
    library, before = Tokenizer.from_file(word_path), 0
    for doc_id, text in sorted(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        r = out[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (before, len(ids), zlib.crc32(u32(ids)))
        before += len(ids)
    assert wavelet.read_shards(wavelet.write_shards(make_docs([]), word_path)).collect() == []


def test_shards_with_null_and_repeated_ids(make_docs, word_path):
    shards = wavelet.write_shards(make_docs([(None, "a"), (2, "b c"), (2, "b c"), (1, None)]), word_path)
    out = sorted((r.start, r.doc_id, r.n_tokens) for r in wavelet.read_shards(shards).collect())
    assert out == [(0, None, 2), (2, 1, 1), (3, 2, 3), (6, 2, 3)]


def check_packing(pieces_out, rows, word_path, window):
    library = Tokenizer.from_file(word_path)
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces_out:
        by_doc[p.doc_id].append(p)
        by_window[p.sequence_id].append(p)
    for doc_id, text in rows:
        ids, at = library.encode(text or "", add_special_tokens=False).ids + [2], 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(u32(ids[at : at + p.length]))
            at += p.length
        assert at == len(ids)
    fills = []
    for own in by_window.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        fills.append(at)
    return sorted(fills)


@pytest.mark.parametrize("window,fan_in", [(64, 2), (4096, 1024)])
def test_packing(spark, make_docs, with_clashes, word_path, real_texts, window, fan_in):
    rows = list(enumerate([*ODD_TEXTS, *real_texts]))
    docs = with_clashes(make_docs(rows, 7))
    out = packing.pack_documents(docs, word_path, window=window, open_windows=4, max_padding=2, fan_in=fan_in)
    fills = check_packing(out.collect(), rows, word_path, window)
    assert all(f >= window - 2 for f in fills[1:])  # only one may be part-filled


def test_packing_of_little(make_docs, word_path):
    assert packing.pack_documents(make_docs([]), word_path).collect() == []
    (only,) = packing.pack_documents(make_docs([(None, None)]), word_path).collect()
    assert (only.doc_id, only.start, only.length, only.offset) == (None, 0, 1, 0)
