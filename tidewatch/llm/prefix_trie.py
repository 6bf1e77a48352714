"""Prefix trie of conversations: the Cartesian tree over the LCP array of the sorted conversations.

A conversation is one row of digests, 16 bytes a turn; the rows are sorted in ranges, and a range is a block. With the last row of
the block before it and the first of the block after it, each block has its part of the LCP array. Nodes that begin and end
in a block are found by one pass over that part: nearest smaller values bound the interval of a place, places of equal value
belong to one node, and the depths between two branchings are nodes of the same members. Nodes that reach over blocks
are put together from the block where they begin, whole blocks, and the block where they end, which the minima of the
blocks tell: the nearest block with a smaller one. Figures of a node are sums and minima over its interval: members, leaves, and
the bytes that each conversation shares with the one before it.

A block is one task's: n conversations in b blocks make n / b rows a task. Seven numbers for each block are collected.
"""

import bisect
import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import merged, merged_on, saved, small_batches

DIGEST = 16
#: Bytes of joined ids that go on to be hashed as one row.
PIECE = 1 << 16
#: Places of the rows of the neighbouring blocks.
BEFORE, AFTER = -1, np.iinfo(np.int64).max
NODE = "block int, depth long, conv_id long, n_convs long, n_children long, n_leaves long, shared long, before long, up_kind string, parent_conv_id long, ends_sha256 string"
PART = f"kind string, {NODE}, piece long, ids string"
ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
NO_IDS = hashlib.sha256(b"").hexdigest()


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): place, digest and text bytes of a conversation's turns, in their order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    # the length of the role keeps role and text apart
    digest = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256), 1, 2 * DIGEST))
    own = rows.select("conv_id", F.struct(place.alias("place"), digest.alias("digest"), F.octet_length("text").cast("long").alias("size")).alias("t"))
    return own.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def rebuilt(turns: DataFrame, head: Column, donor: Column, longest: int) -> DataFrame:
    """Each conversation with the first `head` turns (`longest` at most) of conversation `donor` in the place of its own: all if that has
    fewer, none if there's no such conversation."""
    donors = turns.select(F.col("conv_id").alias("from_id"), F.slice("turns", 1, longest).alias("theirs"))
    both = merged(turns.select("conv_id", "turns", head.cast("int").alias("head"), donor.alias("from_id")), donors, "from_id", "left")
    theirs = F.expr("filter(coalesce(theirs, slice(turns, 1, 0)), (t, i) -> i < head)")
    return both.select("conv_id", F.concat(theirs, F.expr("filter(turns, (t, i) -> i >= head)")).alias("turns"))


def _common(a: bytes, b: bytes) -> int:
    """How many leading digests two conversations share."""
    n = min(len(a), len(b)) // DIGEST
    x, y = (np.frombuffer(k, np.uint8, n * DIGEST).reshape(n, DIGEST) for k in (a, b))
    differ = np.flatnonzero((x != y).any(1))
    return int(differ[0]) if len(differ) else n


class _Open:
    """A node on the path to the conversation in hand: the place where it began (None: in a block before), its smallest member, its children,
    the ids that end in it, and rows of children that wait for its smallest member."""

    __slots__ = ("start", "least", "children", "ids", "below")

    def __init__(self, start: int | None):
        self.start, self.least, self.children, self.ids, self.below = start, None, 0, [], []

    def hold(self, least: int | None):
        if least is not None and (self.least is None or least < self.least):
            self.least = least


def _pieces(ids: list[int]):
    """The ids joined by commas, in pieces of bounded length."""
    held, size = [], 0
    for i in ids:
        held.append(str(i))
        size += len(held[-1]) + 1
        if size > PIECE:
            yield ",".join(held)
            held, size = [], 0
    if held:
        yield ",".join(held)


def block_nodes(ids: list[int], keys: list[bytes], sizes: list[list[int]], before: bytes | None, after: bytes | None, block: int = 0) -> list[dict]:
    """The nodes of one block of sorted conversations; before and after: the keys of the rows next to it.

    kind closed: nodes that begin and end here. open: begin here and go on. end: what a node of an earlier block has here where it ends.
    through: what the block adds to nodes that pass through it; depth: its least LCP, the only one at which they gain children here.
    ids: what ends in nodes that aren't closed, in pieces; up_kind: what they are. up_kind of a node: how its parent is found
    where that isn't closed (open: in this block; before: in an earlier one).
    """
    n, out = len(ids), []
    lcp = [-1 if before is None else _common(before, keys[0]), *(_common(x, y) for x, y in zip(keys, keys[1:], strict=False)), -1 if after is None else _common(keys[-1], after)]
    length = [len(k) // DIGEST for k in keys]
    total = [[0, *np.cumsum(np.array(s, np.int64)).tolist()] for s in sizes]
    # sums over the places before each place
    leaves = [0, *np.cumsum([x < y for x, y in zip(lcp[1:], length, strict=True)]).tolist()]
    shared = [0, *np.cumsum([t[max(v, 0)] for t, v in zip(total, lcp, strict=False)]).tolist()]
    path = [_Open(None) for _ in range(lcp[0] + 1)]

    def add(kind: str, depth: int, node: _Open, until: int, **more) -> dict:
        own = node.start or 0
        # the first conversation of a node shares nothing with the others before it
        first = own + (node.start is not None)
        row = {"kind": kind, "block": block, "depth": depth, "conv_id": node.least, "n_convs": until - own, "n_children": node.children, "n_leaves": leaves[until] - leaves[own], "shared": shared[until] - shared[first], "before": total[own][max(depth - 1, 0)] if node.start is not None else 0}
        out.append(row | more)
        return out[-1]

    def add_ids(kind: str, depth: int, node: _Open):
        out.extend({"kind": "ids", "block": block, "depth": depth, "up_kind": kind, "piece": k, "ids": x} for k, x in enumerate(_pieces(node.ids)))

    def linked(row: dict):
        """The parent of the node of this row is the last one on the path."""
        if path and path[-1].start is None:
            row["up_kind"] = "before"
        elif path:
            path[-1].below.append(row)

    def finish(until: int):
        node, depth = path.pop(), len(path)
        if path:
            path[-1].hold(node.least)
        if node.start is None:
            add("end", depth, node, until)
            add_ids("before", depth, node)
            return
        linked(add("closed", depth, node, until, ends_sha256=hashlib.sha256(",".join(map(str, node.ids)).encode()).hexdigest()))
        for x in node.below:
            x["parent_conv_id"] = node.least

    for i in range(n):
        while len(path) - 1 > lcp[i]:
            finish(i)
        if path and length[i] > lcp[i]:
            path[-1].children += 1
        for depth in range(lcp[i] + 1, length[i] + 1):
            path.append(_Open(i))
            path[-1].children = int(depth < length[i])
        path[-1].ids.append(ids[i])
        path[-1].hold(ids[i])
    while len(path) - 1 > lcp[n]:
        finish(n)
    least = min(lcp)
    through = _Open(None)
    while path:
        node, depth = path.pop(), len(path)
        if path:
            path[-1].hold(node.least)
        if node.start is not None:
            linked(add("open", depth, node, n))
            add_ids("open", depth, node)
            for x in node.below:
                x["up_kind"] = "open"
        elif depth == least:
            through = node
            add_ids("before", depth, node)
    through.hold(min(ids))
    add("through", least, through, n)
    return out


def _block(table: pa.Table) -> pa.Table:
    table = table.sort_by("place")
    place, ids, keys, sizes = (table.column(c).to_pylist() for c in ("place", "conv_id", "key", "sizes"))
    a, z = int(place[0] == BEFORE), len(ids) - int(place[-1] == AFTER)
    rows = block_nodes(ids[a:z], keys[a:z], sizes[a:z], keys[0] if a else None, keys[-1] if z < len(ids) else None, table.column("block")[0].as_py())
    return pa.Table.from_pylist(rows, _schema(PART))


class Blocks:
    """The sums of the blocks, and their minima in a table of powers of two, for nodes that reach over blocks."""

    def __init__(self, rows):
        self.low = [r["depth"] for r in rows]
        self.sums = [[0, *np.cumsum([r[c] for r in rows]).tolist()] for c in ("n_convs", "n_leaves", "shared")]
        self.children = defaultdict(lambda: ([], [0]))
        for i, r in enumerate(rows):
            at, upto = self.children[r["depth"]]
            at.append(i)
            upto.append(upto[-1] + r["n_children"])
        self.children = dict(self.children)
        self.low_table, self.id_table = self._table(self.low), self._table([r["conv_id"] for r in rows])

    @staticmethod
    def _table(x: list[int]) -> list[np.ndarray]:
        out = [np.array(x, np.int64)]
        while len(out[-1]) > 1 << (len(out) - 1):
            w = 1 << (len(out) - 1)
            out.append(np.minimum(out[-1][:-w], out[-1][w:]))
        return out

    def after(self, block: int, depth: int) -> int:
        """The first block after this one whose minimum is below depth; the number of blocks if there's none."""
        at = block + 1
        for k in reversed(range(len(self.low_table))):
            if at < len(self.low_table[k]) and self.low_table[k][at] >= depth:
                at += 1 << k
        return at

    def before(self, block: int, depth: int) -> int:
        """The last block before this one whose minimum is below depth."""
        at = block
        for k in reversed(range(len(self.low_table))):
            if at - (1 << k) >= 0 and self.low_table[k][at - (1 << k)] >= depth:
                at -= 1 << k
        return at - 1

    def between(self, first: int, past: int, depth: int) -> tuple[int | None, int, list[int]]:
        """Of the blocks first to past - 1: smallest id, children of a node of this depth, and the sums."""
        if first >= past:
            return None, 0, [0, 0, 0]
        k = (past - first).bit_length() - 1
        at, upto = self.children.get(depth, ([], [0]))
        least = int(min(self.id_table[k][first], self.id_table[k][past - (1 << k)]))
        return least, upto[bisect.bisect_left(at, past)] - upto[bisect.bisect_left(at, first)], [s[past] - s[first] for s in self.sums]


def _spanning(blocks: Blocks):
    """Open nodes with all that whole blocks add to them, and the block in which they end."""

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                end = blocks.after(r["block"], r["depth"])
                least, children, (n, leaves, shared) = blocks.between(r["block"] + 1, end, r["depth"])
                r |= {"end_block": end, "conv_id": r["conv_id"] if least is None else min(least, r["conv_id"]), "n_children": r["n_children"] + children, "n_convs": r["n_convs"] + n, "n_leaves": r["n_leaves"] + leaves, "shared": r["shared"] + shared}
            yield pa.RecordBatch.from_pylist(rows, _schema(f"{NODE}, end_block int"))

    return run


def _origin(blocks: Blocks):
    """For rows (block, depth, up_kind, ...) the block where the node began: open in the block itself, or passing in from before it."""

    def run(batches):
        for b in batches:
            where = [k if kind == "open" else blocks.before(k, d) for k, d, kind in zip(*(b.column(c).to_pylist() for c in ("block", "depth", "up_kind")), strict=True)]
            yield b.append_column("origin", pa.array(where, pa.int32()))

    return run


def _hashed(batches):
    """Pieces sorted by node and place: one SHA-256 for each node, of all its pieces joined by commas."""
    node, state = None, None
    out = []
    for b in batches:
        for origin, depth, ids in zip(*(b.column(c).to_pylist() for c in ("origin", "depth", "ids")), strict=True):
            if (origin, depth) != node:
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (origin, depth), hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
        if out:
            yield _ends(out)
            out = []
    if node:
        yield _ends([(*node, state.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.string()))], names=["block", "depth", "sha"])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id unique, turns as turn_rows() gives them): one row for each node.

    A node stands for the conversations that begin with the same turns. conv_id: the smallest of them; depth: how many turns;
    parent_conv_id; n_convs; n_children; n_leaves: childless nodes below and itself; saved_tokens: over the nodes below and itself, members
    but one times the bytes of the node's last text; ends_sha256: of the ascending ids, joined by commas, of the conversations that end in it.
    No conversations make no nodes, as there's no member for the root.
    """
    spark = turns.sparkSession
    small_batches(spark)
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    rows = saved(turns.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes")))
    placed = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    row = ["conv_id", "key", "sizes"]
    placed = saved(placed.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"), *row))
    ends = saved(placed.groupBy("part").agg(F.min_by(F.struct(*row), "place").alias("first"), F.max_by(F.struct(*row), "place").alias("last")))
    # one row for each block, as many as the sort has ranges
    number = spark.createDataFrame([(r[0], i) for i, r in enumerate(sorted(ends.select("part").collect()))], "part int, block int")
    ends = ends.join(F.broadcast(number), "part")
    own = placed.join(F.broadcast(number), "part").select("block", "place", *row)
    left = ends.select((F.col("block") + 1).alias("block"), F.lit(BEFORE).cast("long").alias("place"), "last.*")
    right = ends.select((F.col("block") - 1).alias("block"), F.lit(int(AFTER)).alias("place"), "first.*")
    known = ends.select("block")
    beside = left.union(right).join(F.broadcast(known), "block", "left_semi")
    parts = saved(own.union(beside).groupBy("block").applyInArrow(_block, PART))
    node = [x.split()[0] for x in NODE.split(", ")]
    blocks = Blocks(parts.where("kind = 'through'").select("block", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "shared").orderBy("block").collect())

    ids = parts.where("kind = 'ids'").select("block", "depth", "up_kind", "piece", "ids")
    ids = ids.mapInArrow(_origin(blocks), "block int, depth long, up_kind string, piece long, ids string, origin int")
    hashes = ids.repartition("origin", "depth").sortWithinPartitions("origin", "depth", "block", "piece").mapInArrow(_hashed, "block int, depth long, sha string")
    end = parts.where("kind = 'end'").select(F.col("block").alias("end_block"), "depth", *[F.col(c).alias(f"end_{c}") for c in ("conv_id", "n_convs", "n_children", "n_leaves", "shared")])
    whole = merged(parts.where("kind = 'open'").select(node).mapInArrow(_spanning(blocks), f"{NODE}, end_block int"), end, ["end_block", "depth"], "left")
    whole = merged(whole, hashes, ["block", "depth"], "left")
    summed = [(F.col(c) + F.coalesce(f"end_{c}", F.lit(0))).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")]
    whole = saved(whole.select("block", "depth", F.least("conv_id", "end_conv_id").alias("conv_id"), *summed, "before", "up_kind", "parent_conv_id", F.coalesce("sha", F.lit(NO_IDS)).alias("ends_sha256")))

    nodes = parts.where("kind = 'closed'").select(node).union(whole.select(node))
    child = nodes.where("up_kind is not null").drop("parent_conv_id")
    asked = child.select("block", (F.col("depth") - 1).alias("depth"), "up_kind").distinct().mapInArrow(_origin(blocks), "block int, depth long, up_kind string, origin int")
    parent = whole.select(F.col("block").alias("origin"), "depth", F.col("conv_id").alias("parent_conv_id"))
    told = merged(asked, parent, ["origin", "depth"]).select(F.col("block").alias("at"), (F.col("depth") + 1).alias("below"), F.col("up_kind").alias("kind"), "parent_conv_id")
    found = merged_on(child, told, (F.col("block") == F.col("at")) & (F.col("depth") == F.col("below")) & (F.col("up_kind") == F.col("kind")), "inner").select(node)
    saved_tokens = F.col("shared") - (F.col("n_convs") - 1) * F.col("before")
    return nodes.where("up_kind is null").union(found).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved_tokens.alias("saved_tokens"), "ends_sha256")


def conversation_trie(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """The trie of rebuilt conversations (conv_id, turn, role, text): each takes its first h turns from the one that leads its family.

    Conversation c belongs to c - c % family; h is the unsigned crc32 of its decimal id, modulo `heads`. Turns are in the order of turn, null
    first, then of role and text; a null role or text is empty. Rows without a conv_id belong to no conversation and are left out. Equal
    rows are turns of their own. A conversation's digests (24 bytes a turn) are one row; its texts are never gathered. Other
    columns are ignored; an empty table gives an empty result. See prefix_trie() for the columns.
    """
    small_batches(conversations.sparkSession)
    id_ = F.col("conv_id")
    head = F.crc32(id_.cast("string").cast("binary")) % heads
    return prefix_trie(rebuilt(turn_rows(conversations), head, id_ - id_ % family, heads - 1))
