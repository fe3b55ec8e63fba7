"""Quote parsing and linking on written-out mails, and a round trip over all conversations."""

import pytest
from pyspark.sql import functions as F

from clipsift.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"

MAILS = [
    (1, 0, "ann", "Shall we meet on Monday?\nI am free at ten."),
    (1, 1, "bob", "Monday is fine.\n\nOn Sunday, ann wrote:\n> Shall we  meet on MONDAY?\n> I am free at ten."),
    (1, 2, "cem", "> I am free at ten.\nSo am I."),
    (1, 3, "ann", "Good.\nOn Sunday, cem wrote:\n> So am I.\n> > I am free at ten.\n>> Shall we meet on Monday?"),
    (1, 4, "dan", "Nothing quoted > here\nOn Sunday, ann wrote:\nthat is no attribution"),
    (2, 0, "eve", "Forwarded from the others:\n> Monday is fine."),
    (2, 1, "ann", "> nobody wrote this\nWho wrote that?"),
]


def threads(df):
    return {(r.conv_id, r.turn): r for r in quotes.link_quotes(df).collect()}


def test_links_and_order(spark):
    out = threads(spark.createDataFrame(MAILS, SCHEMA))
    parents = {k: (r.parent_conv, r.parent_turn) for k, r in out.items()}
    assert parents == {
        (1, 0): (None, None), (1, 1): (1, 0), (1, 2): (1, 0), (1, 3): (1, 2), (1, 4): (None, None),
        (2, 0): (1, 1), (2, 1): (None, None),
    }
    assert [out[1, t].text for t in range(4)] == ["Shall we meet on Monday?\nI am free at ten.", "Monday is fine.", "So am I.", "Good."]
    assert out[1, 4].text == MAILS[4][3]
    assert out[1, 3].max_level == 2 and out[1, 3].n_quoted == 3
    assert [(out[1, t].root_turn, out[1, t].depth, out[1, t].position) for t in range(5)] == [
        (0, 0, 1), (0, 1, 2), (0, 1, 3), (0, 2, 4), (4, 0, 5)]
    assert (out[2, 0].root_conv, out[2, 0].root_turn, out[2, 0].depth) == (1, 0, 2)


def test_long_chain(spark):
    n = 70
    rows = [(1, 0, "u", "message number 0")] + [(1, i, "u", f"message number {i}\n> message number {i - 1}") for i in range(1, n)]
    out = threads(spark.createDataFrame(rows, SCHEMA))
    assert [(out[1, i].depth, out[1, i].root_turn, out[1, i].position) for i in range(n)] == [(i, 0, i + 1) for i in range(n)]


def test_common_line(spark):
    """Everybody's first turn is the same; a quote of it means the own conversation's."""
    rows = [r for c in range(200) for r in ((c, 0, "u", "Hello"), (c, 1, "a", "Hi\n> Hello"))]
    out = threads(spark.createDataFrame(rows, SCHEMA))
    assert all(out[c, 1].parent_conv == c and out[c, 1].parent_turn == 0 for c in range(200))


def test_nearest_copy(spark):
    """A text that was said before: the nearest earlier copy is quoted, in the own conversation or else before it."""
    rows = [(1, 0, "u", "Start"), (1, 1, "u", "continue"), (1, 2, "a", "One"), (1, 3, "a", "Thanks\n> One"), (1, 4, "a", "Two"),
            (1, 5, "u", "continue"), (1, 6, "a", "Three\n> continue"), (1, 7, "u", "continue"), (1, 8, "u", "continue\n> continue"),
            (2, 0, "x", "> continue"), (3, 0, "x", "Thanks"), (3, 1, "x", "one line\nThanks"), (3, 2, "x", "> Thanks"), (4, 0, "x", "Nothing")]
    out = threads(spark.createDataFrame(rows, SCHEMA))
    parent = {k: (r.parent_conv, r.parent_turn) for k, r in out.items() if r.parent_conv is not None}
    assert parent == {(1, 3): (1, 2), (1, 6): (1, 5), (1, 8): (1, 7), (2, 0): (1, 8), (3, 2): (3, 0)}
    assert (out[1, 6].root_turn, out[1, 6].depth) == (5, 1)


def test_whole_passages(spark):
    """Wrapped quotes are found, and a passage belongs to who wrote all of it, not to first writers of its lines."""
    text = "The first line of it is long\nThanks\nRegards\n\nA second paragraph, which nobody else wrote"
    rows = [(1, 0, "a", "Thanks"), (1, 1, "b", "Regards"), (1, 2, "c", "The first line of it is long"), (2, 0, "d", text),
            (3, 0, "e", "Yes\n> The first line of\n> it is long Thanks\n> Regards\n>\n> A second paragraph, which\n> nobody else wrote"),
            (3, 1, "f", "> A second paragraph,\n> which nobody else wrote\nNo"), (3, 2, "g", "> The first line of it is long\n> Thanks\n> Regards"),
            (3, 3, "h", "> Regards\n\nNo, see below\n> A second paragraph, which nobody\n> else wrote")]
    out = threads(spark.createDataFrame(rows, SCHEMA))
    assert [(out[3, i].parent_conv, out[3, i].parent_turn) for i in range(4)] == [(2, 0)] * 4


def test_odd_rows(spark):
    rows = [(1, 0, "u", None), (1, 1, None, ""), (None, 0, "u", "> a"), (1, None, "u", "a"), (3, 0, "u", "x" * 300_000), (3, 1, "u", "> " + "x" * 300_000),
            (4, 0, "u", "same"), (4, 0, "u", "same"), (4, 1, "u", "> same")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"c": F.lit(1), "t": F.lit(1), "k": F.lit(1), "level": F.lit(1), "position": F.lit(1)})
    out = quotes.link_quotes(df).collect()
    assert len(out) == len(rows)
    by = {(r.conv_id, r.turn): r for r in out}
    assert by[3, 1].parent_turn == 0 and by[3, 1].text == "" and by[4, 1].parent_turn == 0
    assert by[None, 0].parent_turn is None and by[1, 0].text == ""
    assert quotes.link_quotes(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.fixture(scope="module")
def conversations(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def test_round_trip(spark, conversations):
    """Mails made from turns give back the turns; who wrote each line, and most of a quote, decides the parent."""
    rows = sorted((r.conv_id, r.turn, r.role, r.text) for r in conversations.collect())
    out = threads(quotes.as_mail(conversations))
    assert len(out) == len(rows)
    text = {(c, t): x for c, t, _, x in rows}

    def norm(line):
        return " ".join(line.lower().split())

    first, near = {}, {}
    for c, t, _, x in rows:
        for line in {norm(y) for y in x.split("\n")} - {""}:
            first.setdefault(line, (c, t))
            near.setdefault((line, c), (c, t))
    for (c, t), x in text.items():
        r = out[c, t]
        assert r.text == x.strip(" \t\r\n")
        votes = {}
        for line in {norm(y) for y in text.get((c, t - 1), "").split("\n")} - {""}:
            author = near[line, c]
            votes[author] = votes.get(author, 0) + len(line)
        if (c, t - 2) in text:  # the attribution inside the quote is no turn's line
            assert r.max_level == 2
        expected = max(votes.items(), key=lambda v: (v[1], v[0]))[0] if votes else (None, None)
        assert (r.parent_conv, r.parent_turn) == expected
