"""Quotation linking: replies joined to the messages they quote.

A line's quote level is the number of ">" before its text (spaces between them ignored).  Lines
of one level in a row are a block, blank lines part it into paragraphs.  Blocks, paragraphs and
lines are all passages, compared in normalised form (lowered, white space and line breaks
collapsed), so a reply may quote any part of a message and a mail client may wrap it anew.

A quoted line goes by the largest of its passages that an earlier message of its conversation
has one level lower, else has as its own words; of several such messages by the latest.  A message
replies to the message that most lines of its lowest linked quote level come from, then the latest.

The answer is one row per message without its quotes, with its place in the reply order of the
conversation: threads by the turn of their first message, inside a thread by turn, which always
puts a message before its replies.  Threads are found by connecting replies and originals.

All columns are built-in functions.  Passages meet by their SHA-256 digests: those who have one and
those who quote it are laid in the order of turns, once per (conversation, level, digest, turn), and
the last writer is carried on to the next quotes, so no pairs arise.  Conversations without a quoted line need no passages.
Null texts are empty; rows without conv_id or turn keep their text and link with nothing; of
rows with one (conv_id, turn) all keep their text and share the links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelattice.llm.common import components
from ratelattice.skew import running, running_total
from ratelattice.sources.kept import keep

_MARKS = r"^[ \t]*((?:>[ \t]*)+)"
_LEVEL_MARKS = r"^[ \t]*(?:>[ \t]*)+"
_INTRO = r"(?i)^\s*(on\b.*\bwrote|.*\b(wrote|writes|said|schrieb|escribió|a écrit)) ?:\s*$"


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), r"[^>]", ""))


def normal_line(line: Column) -> Column:
    """The line without quote marks, lowered, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, _LEVEL_MARKS, "")), r"\s+", " "))


def _digest(normal: Column) -> Column:
    return F.unhex(F.sha2(F.trim(F.regexp_replace(normal, "\n+", " ")), 256))


def passages(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, level, block, paragraph, line) of every line with text: the digests of its passages."""
    split = F.transform(F.split("text", r"\r?\n", -1), lambda x: F.struct(quote_level(x).alias("level"), normal_line(x).alias("normal")))
    level = lambda i: F.get(F.col("lines"), i)["level"]
    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: (i == 0) | (level(i) != level(i - 1)))

    def block(first: Column, k: Column) -> Column:
        part = F.slice("lines", first + 1, F.coalesce(F.get("starts", k + 1), F.size("lines")) - first)
        return F.struct(level(first).alias("level"), F.array_join(F.transform(part, lambda x: x["normal"]), "\n").alias("text"))

    of = ["conv_id", "turn"]
    lines = messages.select(*of, split.alias("lines")).withColumn("starts", starts)
    blocks = lines.select(*of, F.explode(F.transform("starts", block)).alias("b")).select(*of, "b.level", "b.text", _digest(F.col("b.text")).alias("block"))
    parts = blocks.select(*of, "level", "block", F.explode(F.split("text", "\n\n+")).alias("part")).withColumn("paragraph", _digest(F.col("part")))
    return parts.select(*of, "level", "block", "paragraph", F.explode(F.split("part", "\n")).alias("x")).filter("x != ''").select(*of, "level", "block", "paragraph", _digest(F.col("x")).alias("line"))


def unquoted(text: Column) -> Column:
    """The text without quoted lines and the lines that introduce them."""
    lines = F.split(text, r"\r?\n", -1)
    introduces = lambda x, i: x.rlike(_INTRO) & (quote_level(F.coalesce(F.get(lines, i + 1), F.lit(""))) > 0)
    own = F.filter(lines, lambda x, i: (quote_level(x) == 0) & ~introduces(x, i))
    return F.regexp_replace(F.array_join(own, "\n"), r"^\n+|\n+$", "")


def link_quotes(conversations: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, role, text (without quotes), quoted_lines, linked_lines, parent_turn, thread_turn, reply_order.

    parent_turn: the message replied to, null for none.  thread_turn: the first message of the
    thread.  reply_order: the row's place in its conversation, from 0.
    """
    rows = conversations.select("conv_id", "turn", "role", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = keep(rows.withColumn("row_id", F.monotonically_increasing_id()), "messages")
    known = rows.filter("conv_id is not null and turn is not null")
    quoting = keep(known.filter(F.col("text").rlike(r"(?m)^[ \t]*>")).select("conv_id").distinct(), "quoting")
    lines = keep(passages(known.join(quoting, "conv_id", "left_semi")), "passages")

    quoted = lines.filter("level > 0").groupBy("conv_id", "turn", "level", "block", "paragraph", "line").agg(F.count("*").alias("n"))
    quoted = keep(quoted, "quoted")
    # sought one level lower, then among the own words, each time in the largest passage first
    sought = [(F.col("level") - 1, c) for c in ("block", "paragraph", "line")] + [(F.when(F.col("level") > 1, 0), c) for c in ("block", "paragraph", "line")]
    sought = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), at.alias("at"), F.col(c).alias("digest")) for i, (at, c) in enumerate(sought)]))
    sought = keep(quoted.withColumn("s", sought).select(*quoted.columns, "s.*").filter("at IS NOT NULL"), "sought")

    # the latest earlier message that has a passage at a level, its own words at level 0
    key = ["conv_id", "at", "digest"]
    has = lines.select("conv_id", "turn", F.col("level").alias("at"), F.explode(F.array("block", "paragraph", "line")).alias("digest"))
    writers = has.select(*key, "turn", F.lit(1).alias("kind"), F.col("turn").alias("wrote")).distinct()
    seekers = sought.select(*key, "turn", F.lit(0).alias("kind"), F.lit(None).cast(has.schema["turn"].dataType).alias("wrote")).distinct()
    laid = running(writers.unionByName(seekers), key, ["turn", "kind"], {"parent": ("last", "wrote")})
    found = laid.filter("kind = 0 AND parent IS NOT NULL").select(*key, "turn", "parent")
    met = sought.join(found, [*key, "turn"])
    sure = met.groupBy(*quoted.columns).agg(F.min_by("parent", "rank").alias("parent"), (F.min("rank") < 3).alias("near"))
    sure = keep(sure, "sure")

    linked = sure.groupBy("conv_id", "turn").agg(F.sum("n").alias("linked_lines"))
    totals = quoted.groupBy("conv_id", "turn").agg(F.sum("n").alias("quoted_lines")).join(linked, ["conv_id", "turn"], "left")
    votes = sure.groupBy("conv_id", "turn", "level", "near", "parent").agg(F.sum("n").alias("n"))
    parents = votes.groupBy("conv_id", "turn").agg(F.max_by("parent", F.struct(-F.col("level"), "near", "n", "parent")).alias("parent_turn"))
    parents = keep(totals.join(parents, ["conv_id", "turn"], "left"), "parents")

    threads = keep(_threads(parents.filter("parent_turn is not null")), "threads")
    placed = rows.join(parents, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    zero = F.lit(0).cast("bigint")
    shown = placed.select(
        "row_id",
        "conv_id",
        "turn",
        "role",
        unquoted(F.col("text")).alias("text"),
        F.coalesce("quoted_lines", zero).alias("quoted_lines"),
        F.coalesce("linked_lines", zero).alias("linked_lines"),
        "parent_turn",
        F.coalesce("thread_turn", "turn").alias("thread_turn"),
    )
    return running_total(shown, ["conv_id"], ["thread_turn", "turn", "row_id"], "reply_order").drop("row_id")


def _threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn) of the messages that reply or are replied to."""
    ends = links.select("conv_id", "turn").union(links.select("conv_id", F.col("parent_turn").alias("turn"))).distinct()
    named = keep(ends.withColumn("node", F.monotonically_increasing_id()), "ends")
    child = named.withColumnRenamed("node", "a")
    parent = named.select("conv_id", F.col("turn").alias("parent_turn"), F.col("node").alias("b"))
    pieces = components(links.join(child, ["conv_id", "turn"]).join(parent, ["conv_id", "parent_turn"]).select("a", "b"))
    placed = named.join(pieces, "node")
    first = placed.groupBy("component").agg(F.min("turn").alias("thread_turn"))
    return placed.join(first, "component").select("conv_id", "turn", "thread_turn")
