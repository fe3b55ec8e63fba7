"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clipsift.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(set)
    for s in members:
        if s:
            kids[s[:-1]].add(s)
    out, totals = [], {}
    for s in sorted(members, key=len, reverse=True):
        own_saved = (len(members[s]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        leaves = sum(totals[k][0] for k in kids[s]) if kids[s] else 1
        totals[s] = (leaves, own_saved + sum(totals[k][1] for k in kids[s]))
        ends = ",".join(str(c) for c in sorted(c for c in members[s] if len(whole[c]) == len(s)))
        out.append((
            min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]), len(kids[s]), *totals[s],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def grown(df, **options):
    return sorted((tuple(r) for r in trie.conversation_trie(df, **options).collect()), key=str)


def conversations(seed, n, longest, texts):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        size = rng.randint(1, longest)
        rows += [(c * rng.choice([1, 1, 1, 3]) if seed % 2 else c, t, "user" if t % 2 == 0 else "assistant", rng.choice(texts)) for t in range(size)]
    return rows


@pytest.mark.parametrize("stretch,block", [(256, 4096), (256, 7), (3, 5), (1, 3), (2, 1)])
def test_equals_dictionary(spark, stretch, block):
    rows = conversations(2, 120, 9, ["a b", "c", "d e f"])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows)
    assert len(want) > 200
    assert grown(df, stretch=stretch, block=block) == want


def test_hot_first_turn_and_copies(spark):
    rows = [(c, t, "user", "hello there" if t == 0 or c % 3 == 0 else f"{c % 7} {t}") for c in range(200) for t in range(5)]
    assert grown(spark.createDataFrame(rows, SCHEMA).repartition(4), block=16) == brute(rows)


def test_one_conversation_holds_a_third(spark):
    rows = [(40, t, "user", f"turn {t % 5}") for t in range(400)]
    rows += [(c, t, "user", f"turn {t % 5}") for c in range(41, 61) for t in range(40)]
    assert grown(spark.createDataFrame(rows, SCHEMA).repartition(4), stretch=16, block=9) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "x"), (0, None, "user", "first"), (0, 1, None, None), (0, 1, "", ""), (0, 2, "a", "b c"),
        (1, 5, "user", "p"), (1, 5, "user", "p"), (1, 5, "user", "o"), (21, 0, "user", "q"), (22, 0, "user", "q"), (23, 0, "u", "q" * 5000),
        (-5, 0, "user", "first"), (-5, 1, "user", "first"), (-25, 0, "u", "é  x\ty"), (47, 3, None, "z"), (60, 1, "user", ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert grown(df) == brute(rows)
    clashing = df.withColumns({c: F.lit(7) for c in ("k", "unit", "key", "level", "n", "depth", "id")})
    assert grown(clashing, block=2) == brute(rows)


def test_empty_and_turnless(spark):
    assert grown(spark.createDataFrame([], SCHEMA)) == []
    rows = [(c, 0, "user", "x") for c in range(21, 40)]
    assert grown(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
