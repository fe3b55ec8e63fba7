"""Reply-ordered conversations from messages that quote each other.

Each line's quote level is parsed. What is quoted at the first level is hashed as whole passages,
white space and line breaks collapsed: a run of quoted lines, else its paragraphs, else, for partial
quotes, its lines. Each passage belongs to the nearest earlier message that wrote it, in the order
of (conversation, turn), so to the own conversation's if there is one. The message that wrote most
of what is quoted is the parent. Threads follow parents by pointer jumping, and messages are put in
reply order without their quotes. Earlier writers are counted per hash in slices and met by their
number, so a line that everybody writes fills no task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipsift.operators.ordering import numbered, running_totals
from clipsift.session import durable

QUOTED = r"^(?:[ \t]*>)+[ \t]?"
ATTRIBUTION = r"(?i)^[ \t]*(on|am|le|el) .{0,300}(wrote|schrieb|écrit|escribió)[ \t]*:[ \t]*\r?$"
BREAK = "\x01"  # between runs of quoted lines
PARAGRAPH = r"\n[ \t\r]*\n"
WHOLE, PART, WRAPPED, LINE = 4, 3, 2, 1
_ID = ["c", "t", "k"]


def level_of(line: Column) -> Column:
    """Number of quote marks before a line."""
    return F.regexp_count(F.regexp_extract(line, QUOTED, 0), F.lit(">"))


def collapsed(text: Column) -> Column:
    """A passage in lower case, white space and line breaks collapsed."""
    return F.lower(F.btrim(F.regexp_replace(text, r"[\s ]+", " ")))


def quoted_text(lines: Column) -> Column:
    """Lines quoted at the first level without their marks, and BREAK for each line between them."""
    def shown(line: Column, i: Column) -> Column:
        bare = F.regexp_replace(line, QUOTED, "")
        above = F.rlike(bare, F.lit(ATTRIBUTION)) & (level_of(F.coalesce(F.get(lines, i + 1), F.lit(""))) > 1)
        return F.when(level_of(line) == 0, F.lit(BREAK)).when((level_of(line) == 1) & ~above, bare)

    return F.array_join(F.transform(lines, shown), "\n")  # without nulls


def own_text(lines: Column) -> Column:
    """What is left of a message without quoted lines and the attributions right above them."""
    def written(line: Column, i: Column) -> Column:
        above = F.rlike(line, F.lit(ATTRIBUTION)) & (level_of(F.coalesce(F.get(lines, i + 1), F.lit(""))) > 0)
        return (level_of(line) == 0) & ~above

    return F.btrim(F.array_join(F.filter(lines, written), "\n"), F.lit(" \t\r\n"))


def _units(runs: Column, partial: bool) -> Column:
    """Passages (run, paragraph, rank, kind, text) of each run of lines.

    ``rank`` tells what a passage is of its own run, ``kind`` what it is compared with. A quoted
    paragraph may be a line that was wrapped (``partial``).
    """
    def unit(b, p, rank, kind, text):
        return F.struct(b.alias("b"), p.alias("p"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), collapsed(text).alias("norm"))

    def of_part(b: Column, p: Column, part: Column) -> Column:
        whole = [unit(b, p, PART, PART, part)] + ([unit(b, p, WRAPPED, LINE, part)] if partial else [])
        return F.concat(F.array(*whole), F.transform(F.split(part, "\n"), lambda x: unit(b, p, LINE, LINE, x)))

    def of_run(run: Column, b: Column) -> Column:
        parts = F.transform(F.split(run, PARAGRAPH), lambda part, p: of_part(b, p, part))
        return F.concat(F.array(unit(b, F.lit(-1), WHOLE, WHOLE, run)), F.flatten(parts))

    return F.flatten(F.transform(runs, of_run))


def _passages(messages: DataFrame) -> DataFrame:
    """(c, t, k, wrote, b, p, rank, h, size) of all that messages wrote (wrote 1) or quoted (0)."""
    lines = F.split(F.translate(F.coalesce("text", F.lit("")), BREAK, " "), "\n")
    rows = messages.filter("c IS NOT NULL AND t IS NOT NULL").select(*_ID, lines.alias("lines"))
    written = rows.select(*_ID, F.lit(1).alias("wrote"), F.explode(_units(F.array(own_text(F.col("lines"))), False)).alias("u"))
    quoting = rows.filter(F.exists("lines", lambda x: level_of(x) > 0))
    quoted = quoting.select(*_ID, F.lit(0).alias("wrote"), F.explode(_units(F.split(quoted_text(F.col("lines")), BREAK), True)).alias("u"))

    def hashed(units: DataFrame) -> DataFrame:
        units = units.filter("u.norm <> ''")
        return units.select(*_ID, "wrote", "u.b", "u.p", "u.rank", F.xxhash64("u.kind", "u.norm").alias("h"), F.length("u.norm").alias("size"))

    once = hashed(written).select(*_ID, "wrote", F.lit(0).alias("b"), F.lit(0).alias("p"), F.lit(0).alias("rank"), "h", "size").distinct()
    return once.unionByName(hashed(quoted))


def _parents(messages: DataFrame) -> DataFrame:
    """(c, t, k, pc, pt, pk) of messages that quote an earlier one."""
    passages = durable(_passages(messages), "passages")
    # The number of writers so far: a quote meets the last one before it. A message's quotes come before what it wrote.
    counted = durable(running_totals(passages, ["h", "size"], [*_ID, "wrote"], {"n": F.col("wrote").cast("long")}), "counted")
    writers = counted.filter("wrote = 1").select("h", "size", "n", F.struct(*_ID).alias("author"))
    met = counted.filter("wrote = 0 AND n > 0").join(writers, ["h", "size", "n"])
    # Of a run that was met as a whole its parts count no more, nor a met paragraph's lines.
    run, part = Window.partitionBy(*_ID, "b"), Window.partitionBy(*_ID, "b", "p")
    met = met.withColumn("best_run", F.max("rank").over(run)).withColumn("best_part", F.max("rank").over(part))
    votes = met.filter(f"rank = IF(best_run = {WHOLE}, {WHOLE}, best_part)")
    votes = votes.groupBy(*_ID, "author").agg(F.sum("size").alias("weight"))
    best = votes.groupBy(*_ID).agg(F.max(F.struct("weight", "author")).alias("best"))
    return best.select(*_ID, F.col("best.author.c").alias("pc"), F.col("best.author.t").alias("pt"), F.col("best.author.k").alias("pk"))


def _threads(parents: DataFrame) -> DataFrame:
    """(c, t, k, rc, rt, rk, depth): the first message of each replying message's thread.

    Every round doubles the way that has been followed; parents come before their replies in the
    order of (conversation, turn), so there are no circles.
    """
    steps = durable(parents.select(*_ID, F.col("pc").alias("rc"), F.col("pt").alias("rt"), F.col("pk").alias("rk"), F.lit(1).cast("long").alias("depth"), F.lit(True).alias("moved")), "steps")
    while True:
        on = steps.select(
            F.col("c").alias("rc"), F.col("t").alias("rt"), F.col("k").alias("rk"),
            F.col("rc").alias("nc"), F.col("rt").alias("nt"), F.col("rk").alias("nk"), F.col("depth").alias("more"),
        )
        # A row that has reached a first message is done and joins no more.
        joined = steps.filter("moved").join(on, ["rc", "rt", "rk"], "left")
        moved = joined.select(
            *_ID, F.coalesce("nc", "rc").alias("rc"), F.coalesce("nt", "rt").alias("rt"), F.coalesce("nk", "rk").alias("rk"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("more").isNotNull().alias("moved"),
        )
        steps = durable(steps.filter("NOT moved").unionByName(moved.select(*steps.columns)), "steps")
        if not steps.filter("moved").limit(1).count():
            return steps.drop("moved")


def link_quotes(messages: DataFrame) -> DataFrame:
    """Conversations in reply order: one row a message of (conv_id, turn, role, text).

    Returns conv_id, turn, role, text (without quotes and their attributions), n_quoted (lines),
    max_level, parent_conv, parent_turn, root_conv, root_turn, depth and position, which counts a
    conversation's messages from 1: threads in the order of their first messages, in a thread
    parents before replies. A quote's author is the nearest message before it in the order of
    (conv_id, turn) that wrote the same.
    Null texts are empty and quote nothing; messages without conv_id or turn are kept as threads
    of their own; repeated rows stay, side by side; an empty table gives no rows; other columns
    are not read.
    """
    rows = messages.select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("t"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    ).withColumn("k", F.xxhash64("role", "text"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    shaped = rows.withColumn("lines", lines).select(
        *_ID, "role", own_text(F.col("lines")).alias("text"),
        F.size(F.filter("lines", lambda x: level_of(x) > 0)).cast("long").alias("n_quoted"),
        F.coalesce(F.array_max(F.transform("lines", level_of)), F.lit(0)).cast("long").alias("max_level"),
    )
    parents = durable(_parents(rows), "parents")
    links = parents.join(_threads(parents), _ID)
    joined = shaped.join(links, _ID, "left").select(
        F.col("c").alias("conv_id"), F.col("t").alias("turn"), "role", "text", "n_quoted", "max_level",
        F.col("pc").alias("parent_conv"), F.col("pt").alias("parent_turn"),
        F.coalesce("rc", "c").alias("root_conv"), F.coalesce("rt", "t").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
    return numbered(joined, ["conv_id"], ["root_conv", "root_turn", "depth", "turn", "role", "text"], "position")


def as_mail(conversations: DataFrame) -> DataFrame:
    """Turns as mails: each quotes the turn before it, with that turn's own quote of the one before.

    Quotes stand below the text under an attribution, a quoted line has one mark per level.
    """
    once = conversations.groupBy("conv_id", "turn").agg(F.min(F.struct("role", "text")).alias("m"))

    def earlier(n: int) -> DataFrame:
        return once.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("m.role").alias(f"role{n}"), F.col("m.text").alias(f"text{n}"))

    def quoted(text: str, marks: str) -> Column:
        return F.concat(F.lit(marks + " "), F.replace(F.col(text), F.lit("\n"), F.lit(f"\n{marks} ")))

    rows = conversations.join(earlier(1), ["conv_id", "turn"], "left").join(earlier(2), ["conv_id", "turn"], "left")
    first = F.concat(F.lit("\n\nOn turn "), F.col("turn") - 1, F.lit(" "), F.col("role1"), F.lit(" wrote:\n"), quoted("text1", ">"))
    second = F.concat(F.lit("\n> On turn "), F.col("turn") - 2, F.lit(" "), F.col("role2"), F.lit(" wrote:\n"), quoted("text2", ">>"))
    return rows.select(
        "conv_id", "turn", "role",
        F.concat(F.col("text"), F.coalesce(first, F.lit("")), F.coalesce(second, F.lit(""))).alias("text"),
    )
