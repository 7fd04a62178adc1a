"""Operator 3: conversations without quotations, in the order of replies. DataFrame functions only.

A line that starts with `>` marks is quoted, at as many levels as there are marks; other lines are the message's own. A line that announces a
quotation (`On ... wrote:`, before a line of a deeper level) is neither. A passage is a run of lines of one level without a blank line among them;
its lines are joined, so that wrapping does not matter, normalised (lower case, letters and digits, single spaces) and hashed. A quoted
passage comes from the latest earlier turn of its conversation that has it as a passage of its own. Of a passage found in no turn, each
sentence of at least SENTENCE_WORDS words comes from the latest earlier turn that has it as a sentence of its own; shorter ones are said
too often to mean anything. Sources are found by one ordered pass over (conversation, hash), in which keys of any size are cut
into slices. A message replies to the turn that most of its linked words of the outermost linked level come from, the latest of equals. A thread
is named by the turn at its root, found by pointer jumping, and messages are ordered by (thread, turn), so that a reply follows what it
replies to. The text that is left has no quoted lines and no line that announces a quotation.

Null texts are empty. Messages without conv_id or turn are kept but never linked. Rows that repeat a turn are all kept; the turn's
own reply is then the earliest of theirs. An empty table gives no rows. Other columns are ignored. Passages are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyrill.llm.common import stored
from keyrill.operators.slices import sliced

_MARKS = r"^[ \t]*((?:>[ \t]?)+)"
_ANNOUNCES = r"^On .*wrote:[ \t]*$"
SENTENCE_WORDS = 3
_END = r"[.!?]+(?:\s+|$)"
_PASSAGE, _TEXT = "\x01", "\x02"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def _body(line: Column) -> Column:
    return F.regexp_replace(line, _MARKS, "")


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _announced(lines: Column, line: Column, i: Column) -> Column:
    return _body(line).rlike(_ANNOUNCES) & (_level(F.coalesce(F.get(lines, i + 1), F.lit(""))) > _level(line))


def _own_text(text: Column) -> Column:
    def kept(lines: Column) -> Column:
        own = F.filter(lines, lambda line, i: (_level(line) == 0) & ~_announced(lines, line, i))
        return F.array_join(own, "\n")

    return F.when(F.contains(text, F.lit(">")), _bound(F.split(text, "\n"), kept)).otherwise(text)


def _passages(text: Column) -> Column:
    """The passages of a text, each as its level, a mark and its joined lines."""

    def described(lines: Column) -> Column:
        return F.transform(lines, lambda line, i: F.struct(_level(line).alias("level"), F.when(~_announced(lines, line, i), _body(line)).alias("body"), (_normal(_body(line)) == "").alias("blank")))

    def joined(lines: Column) -> Column:
        def part(line: Column, i: Column) -> Column:
            before = F.get(lines, i - 1)
            goes_on = (i > 0) & ~before["blank"] & before["body"].isNotNull() & (before["level"] == line["level"])
            lead = F.when(goes_on, F.lit(" ")).otherwise(F.concat(F.lit(_PASSAGE), line["level"].cast("string"), F.lit(_TEXT)))
            return F.when(~line["blank"] & line["body"].isNotNull(), F.concat(lead, line["body"]))

        return F.array_join(F.transform(lines, part), "")

    plain = F.translate(text, _PASSAGE + _TEXT, "  ")
    return F.filter(F.split(_bound(_bound(F.split(plain, "\n"), described), joined), _PASSAGE), lambda passage: passage != "")


def _unit(text: Column) -> Column:
    """The hash of a passage or sentence and its words."""
    return _bound(_normal(text), lambda normal: F.struct(F.xxhash64(normal).alias("hash"), F.size(F.split(normal, " ")).alias("words")))


def _with_sources(units: DataFrame) -> DataFrame:
    """Quoted units (conv_id, hash, turn, level, words, n) with the latest earlier turn that has them as its own, or null."""
    quoted = units.where("level > 0")
    own = units.where("level = 0").join(quoted.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    key = F.concat_ws(":", "conv_id", "hash").alias("key")
    fixed = [key, "conv_id", "hash", "turn"]
    # at one turn quoted units come first: a message is not its own source; levels tell them apart
    both = own.select(*fixed, F.lit(1 << 30).alias("level"), "words", "n", F.col("turn").alias("said")).unionByName(
        quoted.select(*fixed, "level", "words", "n", F.lit(None).cast("int").alias("said"))
    )
    found = sliced(both, order=("turn", "level")).running_last(F.col("said"), "source", before_current=True).result()
    return found.where("said is null").drop("key", "said")


def _counted(units: DataFrame) -> DataFrame:
    return units.groupBy("conv_id", "hash", "turn", "level").agg(F.max("words").alias("words"), F.sum("n").alias("n"))


def _links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, source, n_linked, n_words): how many quoted passages or sentences of a level come from which turn, and their words."""
    passages = (
        messages.where("conv_id is not null and turn is not null")
        .select("conv_id", "turn", F.explode(_passages(F.col("text"))).alias("passage"))
        .select("conv_id", "turn", F.substring_index("passage", _TEXT, 1).cast("int").alias("level"), F.substring_index("passage", _TEXT, -1).alias("text"))
    )
    sentences = F.filter(F.transform(F.split("text", _END), _unit), lambda unit: unit["words"] >= SENTENCE_WORDS)
    passages = passages.select("conv_id", "turn", "level", _unit(F.col("text")).alias("whole"), sentences.alias("sentences"))
    passages = passages.groupBy("conv_id", "turn", "level", "whole", "sentences").agg(F.count("*").alias("n"))
    passages = stored(passages.select("conv_id", "turn", "level", "whole.*", "sentences", "n"), "quote-passages")
    whole = stored(_with_sources(_counted(passages)).where("source is not null"), "quote-sources")
    rest = passages.where("level > 0").join(whole, ["conv_id", "hash", "turn", "level"], "left_anti")
    parts = rest.select("conv_id", "turn", "level", "sentences", "n").unionByName(passages.where("level = 0").select("conv_id", "turn", "level", "sentences", "n"))
    parts = stored(_counted(parts.select("conv_id", "turn", "level", "n", F.explode("sentences").alias("s")).select("conv_id", "turn", "level", "n", "s.*")), "quote-sentences")
    linked = whole.unionByName(_with_sources(parts).where("source is not null"))
    return linked.groupBy("conv_id", "turn", "level", "source").agg(F.sum("n").alias("n_linked"), F.sum(F.col("n") * F.col("words")).alias("n_words"))


def _roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn) of all turns that reply."""
    at = stored(replies.select("conv_id", "turn", F.col("reply_turn").alias("thread_turn")), "threads")
    while True:
        up = at.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("above"))
        moved = at.join(up, ["conv_id", "thread_turn"], "left")
        if moved.where("above is not null").limit(1).count() == 0:
            return at
        at = stored(moved.select("conv_id", "turn", F.coalesce("above", "thread_turn").alias("thread_turn")), "threads")


def reply_order(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, reply_turn, thread_turn, n_linked, position, text) of every message.

    n_linked counts its quoted passages, and of others the sentences, whose source was found; position counts from 1 within the conversation (null without conv_id or turn).
    """
    messages = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("int").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    linked = stored(_links(messages), "quote-links")
    outer = linked.groupBy("conv_id", "turn").agg(F.min("level").alias("level"), F.sum("n_linked").alias("n_linked"))
    replies = (
        linked.drop("n_linked").join(outer, ["conv_id", "turn", "level"])
        .groupBy("conv_id", "turn", "n_linked")
        .agg(F.max_by("source", F.struct("n_words", "source")).alias("reply_turn"))
    )
    replies = stored(replies, "replies")
    threads = replies.join(_roots(replies), ["conv_id", "turn"])
    rows = messages.withColumn("row", F.monotonically_increasing_id()).join(threads, ["conv_id", "turn"], "left")
    rows = rows.select(
        F.col("conv_id").cast("string").alias("key"),
        "conv_id",
        "turn",
        "role",
        "reply_turn",
        F.coalesce("thread_turn", "turn").alias("thread_turn"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        _own_text(F.col("text")).alias("text"),
        "row",
    )
    named = F.col("key").isNotNull() & F.col("turn").isNotNull()
    placed = sliced(rows.where(named), order=("thread_turn", "turn", "row"), measure=None).running_sum(F.lit(1).cast("long"), "position").result()
    columns = ["conv_id", "turn", "role", "reply_turn", "thread_turn", "n_linked", "position", "text"]
    others = rows.where(~named).withColumn("position", F.lit(None).cast("long"))
    return placed.select(columns).unionByName(others.select(columns))
