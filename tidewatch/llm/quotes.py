"""Conversations without quotes, ordered by replies: quotation linking.

A line that starts with > marks is quoted, as deep as it has marks. The quoted lines of one level that nothing less deep
parts are a passage (deeper ones between them were quotes of the quoted message itself), and so are its paragraphs,
if it has several. A passage, normalised (marks off, blanks to one space, lower case, empty lines off), is hashed and joined
to the messages whose own lines hold it whole, one line after the other. Of those the latest earlier message of the same
conversation counts; without one the first of a lower conversation; else the first of a higher one that quotes nothing
itself. A message answers the message that most lines of its shallowest linked quotes come from. A thread is a message that
answers none and all that answer it, directly or through others, in whatever conversations; messages come thread by thread,
each after the one it answers. A line like "Ann wrote:" before a deeper quotation goes with it.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import merged, saved, small_batches

MARKS = re.compile(r"^[ \t]{0,3}((?:>[ \t]?)+)")
WROTE = re.compile(r"^\S.{0,300}\b(?:wrote|writes|said):$", re.I)
#: Turns of a conversation are searched for the latest earlier one in stretches of so many.
STRETCH = 256


def quoted(text: str | None) -> tuple[str, list[tuple[int, list[str]]], list[str], int, int]:
    """The text without quotations, the (level, normalised lines) of their passages, the normalised own lines, the number of quoted lines and the deepest level."""
    rows = []
    for line in (text or "").split("\n"):
        m = MARKS.match(line)
        rows.append((m[1].count(">") if m else 0, " ".join((line[m.end() :] if m else line).lower().split()), line))
    if not any(level for level, _, _ in rows):
        return text or "", [], [x for _, x, _ in rows if x], 0, 0
    own, mine, passages, n, deepest = [], [], [], 0, 0
    open_: dict[int, list[list[str]]] = {}  # by level the paragraphs of the passage

    def shut(level: int) -> None:
        for k in sorted(k for k in open_ if k > level):
            parts = [x for x in open_.pop(k) if x]
            passages.extend((k, x) for x in [sum(parts, []), *parts][: len(parts) + 1 if len(parts) > 1 else 1] if x)

    following = 0  # the level of the next line that isn't empty
    after = []
    for level, bare, _ in reversed(rows):
        after.append(following)
        following = level if bare else following
    for (level, bare, line), further in zip(rows, reversed(after), strict=True):
        if bare and further > level and WROTE.match(bare):
            shut(level)
            continue
        if bare:
            shut(level)
        if not level:
            own.append(line)
            mine += [bare] * bool(bare)
            continue
        parts = open_.setdefault(level, [[]])
        if bare:
            parts[-1].append(bare)
            n, deepest = n + 1, max(deepest, level)
        elif parts[-1]:
            parts.append([])
    shut(0)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip("\n"), passages, mine, n, deepest


def _sha(lines: list[str]) -> bytes:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "replace")).digest()


def _links(batches):
    """What links are found by: the passages (level, first line, number of lines, hash) and the own lines of each message."""
    passage = pa.list_(pa.struct([("level", pa.int32()), ("first", pa.string()), ("size", pa.int32()), ("h", pa.binary())]))
    for b in batches:
        found = list(map(quoted, b.column("text").to_pylist()))
        asked = [[{"level": k, "first": x[0], "size": len(x), "h": _sha(x)} for k, x in f[1]] for f in found]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), pa.array(asked, passage), pa.array([f[2] for f in found], pa.list_(pa.string())), pa.array([not f[3] for f in found], pa.bool_())], names=["conv_id", "turn", "passages", "lines", "plain"])


def _stripped(batches):
    for b in batches:
        found = list(map(quoted, b.column("text").to_pylist()))
        cols = [pa.array([f[0] for f in found], pa.string()), pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in ("conv_id", "turn", "role")), *cols], names=["conv_id", "turn", "role", "text", "n_quotes", "depth"])


def threads(links: DataFrame) -> DataFrame:
    """links (conv_id, turn, reply_conv, reply_turn), one row for each answering message and without cycles, as all links go
    to earlier turns, to lower conversations or to messages that answer none, with the root of the thread (thread_conv, thread_turn) and the number of answers on the way there (reply_depth).

    Each round doubles how far a message sees, up to its root.
    """
    now = saved(links.withColumns({"thread_conv": F.col("reply_conv"), "thread_turn": F.col("reply_turn"), "reply_depth": F.lit(1).cast("long")}))
    while True:
        further = now.select(F.col("conv_id").alias("thread_conv"), F.col("turn").alias("thread_turn"), F.col("thread_conv").alias("to_conv"), F.col("thread_turn").alias("to_turn"), F.col("reply_depth").alias("more"))
        step = merged(now, further, ["thread_conv", "thread_turn"], "left")
        step = saved(step.select("conv_id", "turn", "reply_conv", "reply_turn", F.coalesce("to_conv", "thread_conv").alias("thread_conv"), F.coalesce("to_turn", "thread_turn").alias("thread_turn"), (F.col("reply_depth") + F.coalesce("more", F.lit(0))).alias("reply_depth"), F.col("more").isNotNull().alias("moved")))
        now = step.drop("moved")
        if step.where("moved").isEmpty():
            return now


def _holders(known: DataFrame, asked: DataFrame) -> DataFrame:
    """(h, conv_id, turn, plain): the messages that hold a passage that is asked for, one line after the other.

    Only places where the first line of a passage stands are looked at, with the lengths that passages have from there.
    """
    firsts = asked.groupBy("first").agg(F.collect_set("size").alias("sizes"))
    lines = known.select("conv_id", "turn", F.posexplode("lines").alias("at", "first"))
    starts = merged(lines, firsts, "first").groupBy("conv_id", "turn").agg(F.collect_set(F.struct("at", "sizes")).alias("starts"))
    at = merged(known.select("conv_id", "turn", "lines", "plain"), starts, ["conv_id", "turn"]).withColumn("x", F.explode("starts"))
    at = at.select("conv_id", "turn", "plain", "lines", "x.at", F.explode("x.sizes").alias("size")).where("at + size <= size(lines)")
    h = F.unhex(F.sha2(F.encode(F.array_join(F.slice("lines", F.col("at") + 1, F.col("size")), "\n"), "UTF-8"), 256))
    return merged(at.select(h.alias("h"), "conv_id", "turn", "plain").distinct(), asked.select("h").distinct(), "h", "left_semi")


def _latest_before(asked: DataFrame, holders: DataFrame) -> DataFrame:
    """asked (h, conv_id, turn) with own_turn, the latest turn before it in its conversation that holds the passage.

    The search is in stretches of turns, and over what the stretches before hold, so that a conversation with a
    large share of all rows is no single group.
    """
    key = ["h", "conv_id", "stretch"]
    rows = asked.select("h", "conv_id", "turn", F.lit(None).cast("long").alias("held")).union(holders.select("h", "conv_id", "turn", F.col("turn").alias("held")))
    rows = rows.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    near = F.max("held").over(Window.partitionBy(*key).orderBy("turn").rangeBetween(Window.unboundedPreceding, -1))
    found = rows.withColumn("near", near).where("held is null")
    far = F.max("top").over(Window.partitionBy("h", "conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    tops = rows.groupBy(*key).agg(F.max("held").alias("top")).withColumn("far", far)
    return merged(found, tops.select(*key, "far"), key).select("h", "conv_id", "turn", F.coalesce("near", "far").alias("own_turn"))


def link_quotes(conversations: DataFrame) -> DataFrame:
    """One row for each row of conversations (conv_id, turn, role, text), in reply order: conv_id, turn, role,
    text without quotations, n_quotes (quoted lines), depth (deepest level), reply_conv and reply_turn (the message answered
    by quotation, else null), thread_conv and thread_turn (the message at the root, a message that answers none is its own),
    reply_depth (answers from there). The order is by thread, reply_depth, conv_id and turn.

    Null and empty texts have no quotes; rows with a null conv_id or turn are neither linked nor linked to; a passage that
    many messages hold links to one of them, so copies never multiply; rows that share conv_id and turn share their
    links; other columns are ignored; an empty table gives an empty result.
    """
    small_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    known = saved(rows.where("conv_id is not null and turn is not null").select("conv_id", "turn", "text").mapInArrow(_links, "conv_id long, turn long, passages array<struct<level: int, first: string, size: int, h: binary>>, lines array<string>, plain boolean"))
    asked = saved(known.select("conv_id", "turn", F.explode("passages").alias("p")).select("conv_id", "turn", "p.*").distinct())
    holders = saved(_holders(known, asked))
    here = _latest_before(asked.select("h", "conv_id", "turn").distinct(), holders)
    first = holders.groupBy("h").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    plain = holders.where("plain").groupBy("h", "conv_id").agg(F.min("turn").alias("turn"))
    least = plain.groupBy("h").agg(F.min(F.struct("conv_id", "turn")).alias("p1"))
    second = merged(plain, least, "h").where("conv_id > p1.conv_id").groupBy("h").agg(F.min(F.struct("conv_id", "turn")).alias("p2"))
    found = merged(merged(asked.drop("first"), here, ["h", "conv_id", "turn"]), merged(merged(first, least, "h", "left"), second, "h", "left"), "h")
    higher = F.when(F.col("p1.conv_id") > F.col("conv_id"), F.col("p1")).when(F.col("p2.conv_id") > F.col("conv_id"), F.col("p2"))
    target = F.when(F.col("own_turn").isNotNull(), F.struct("conv_id", F.col("own_turn").alias("turn"))).when(F.col("first.conv_id") < F.col("conv_id"), F.col("first")).otherwise(higher)
    votes = found.select("conv_id", "turn", "level", "size", target.alias("to")).where("to is not null").groupBy("conv_id", "turn", "level", "to").agg(F.sum("size").alias("n"))
    best = F.min(F.struct("level", -F.col("n"), F.col("to.conv_id") != F.col("conv_id"), -F.col("to.turn"), "to")).alias("x")
    best = votes.groupBy("conv_id", "turn").agg(best).select("conv_id", "turn", F.col("x.to.conv_id").alias("reply_conv"), F.col("x.to.turn").alias("reply_turn"))
    out = rows.mapInArrow(_stripped, "conv_id long, turn long, role string, text string, n_quotes long, depth long").join(threads(best), ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", "text", "n_quotes", "depth", "reply_conv", "reply_turn", F.coalesce("thread_conv", "conv_id").alias("thread_conv"), F.when(F.col("thread_conv").isNull(), F.col("turn")).otherwise(F.col("thread_turn")).alias("thread_turn"), F.coalesce("reply_depth", F.lit(0)).alias("reply_depth")).orderBy("thread_conv", "thread_turn", "reply_depth", "conv_id", "turn")
