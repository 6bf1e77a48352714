"""Near-duplicate groups by a chosen-path set similarity join.

Every distinct word-shingle set gets a signature of minwise values. A tree starts with all sets in its root; a
node chooses one or two coordinates of the signature (by a hash of its path, 1 / similarity of them on average)
and sends a set to the child named by its minwise value there. A node of at most `leaf` sets (and `room` shingles)
is compared exhaustively on sketches; what passes is confirmed on the full sets. Independent trees bring recall to
the target. Each larger node branches further for as long as a level at least halves the comparisons that it
needs. A node of sets that are all much alike doesn't shrink so: there, what lies outside its largest group meets
all its sets in blocks, so no set is left out of a comparison because its node is large. Such nodes of different
trees hold much the same sets, so those that share sets are first united where that makes fewer comparisons.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytehash as bh
from tidewatch.llm.common import components, merged, pieces, saved, small_batches, text_bytes

COORDS = 64
U = np.uint64
#: A pair at the similarity of 0.8 agrees in 51 of 64 sketch bytes, standard deviation 3.2: fewer than this with a chance of 1.1e-6.
LEAST_AGREEING = 35
#: A further level of a large node has to leave at most this share of its comparisons.
SHRINK = 0.5
#: Sets whose agreement with all of a node is counted at once.
ROWS = 256


def _signatures(k: int):
    seeds = bh.mix(np.arange(1, COORDS + 1, dtype=U)) | U(1)

    def run(batches):
        for b in batches:
            off, data = text_bytes(b.column(1))
            n, digest, sig, sketch = [], [], [], []
            for i, j in pieces(off):
                sets = bh.shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], k)
                sizes = np.array([len(s) for s in sets])
                flat = np.concatenate([*sets, np.zeros(1, U)])
                at = np.concatenate([[0], np.cumsum(sizes)])
                with np.errstate(over="ignore"):
                    sums = [np.concatenate([[U(0)], np.cumsum(x)]) for x in (flat, bh.mix(flat + U(7)))]
                    d = np.stack([bh.mix(s[at[1:]] - s[at[:-1]] + sizes.astype(U)) for s in sums], 1)
                    low = np.zeros((len(sets), COORDS), np.uint32)
                    for c, seed in enumerate(seeds):
                        least = np.minimum.reduceat(flat * seed, at)[:-1]
                        low[:, c] = (least >> U(32)).astype(np.uint32)
                n += sizes.tolist()
                digest += [x.tobytes() for x in d]
                sig += [x.tobytes() for x in low]
                sketch += [x.tobytes() for x in low.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary()), pa.array(sketch, pa.binary())], names=["doc_id", "n_shingles", "digest", "sig", "sketch"])

    return run


def _children(path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Child paths and the rows they come from: one coordinate for each node, a second one for every fourth node."""
    with np.errstate(over="ignore"):
        h = bh.mix(path)
        first = (h % U(COORDS)).astype(np.int64)
        two = np.flatnonzero((h >> U(40)) % U(4) == 0)
        second = (first[two] + 1 + ((h[two] >> U(20)) % U(COORDS - 1)).astype(np.int64)) % COORDS
        rows = np.concatenate([np.arange(len(path)), two])
        coord = np.concatenate([first, second])
        value = sig[rows, coord].astype(U) << U(8)
        return bh.mix(path[rows] ^ bh.mix(value + coord.astype(U))), rows


def _sig_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDS)


def _roots(trees: range):
    def run(batches):
        for b in batches:
            sig, n = _sig_array(b.column("sig")), b.num_rows
            paths, rows = [], []
            for t in trees:
                p, r = _children(np.full(n, bh.mix(np.array([t + 1], U))[0]), sig)
                paths.append(p)
                rows.append(r)
            rows = pa.array(np.concatenate([*rows, np.zeros(0, np.int64)]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*paths, np.zeros(0, U)]).view(np.int64)), *(b.column(c).take(rows) for c in ("doc", "comp", "size"))], names=["path", "doc", "comp", "size"])

    return run


def _deeper(batches):
    """The children of nodes (path, doc); up is the node that they come from."""
    for b in batches:
        p, r = _children(b.column("path").to_numpy(zero_copy_only=False).view(U), _sig_array(b.column("sig")))
        r = pa.array(r)
        yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), *(b.column(c).take(r) for c in ("doc", "comp", "size", "path"))], names=["path", "doc", "comp", "size", "up"])


def _pairs(members: list[dict], percent: int, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (larger, smaller document) of a node that may be similar: of different groups and opposite sides, of
    like sizes, and with sketches that agree often enough; with forest only the best one of each larger document."""
    members.sort(key=lambda m: m["doc"])
    doc, comp, other, size = (np.array([m[x] for m in members]) for x in ("doc", "comp", "other", "size"))
    n, at = len(doc), np.arange(len(doc))
    sketch = np.frombuffer(b"".join(m["sketch"] for m in members), np.uint8).reshape(n, COORDS).T.copy()
    _, group = np.unique(comp, return_inverse=True)
    look = at if forest else at[group != np.bincount(group).argmax()]  # the sets of one group needn't meet each other
    looked = np.isin(at, look)
    met, more, less = None, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rows in np.split(look, range(ROWS, len(look), ROWS)):
        agree = np.zeros((len(rows), n), np.uint8)
        for x in sketch:
            agree += x[rows, None] == x
        hit = (agree >= LEAST_AGREEING) & (comp[rows, None] != comp)
        if other.any():
            hit &= other[rows, None] != other
        hit &= 100 * np.minimum(size[rows, None], size) >= percent * np.maximum(size[rows, None], size)
        hit &= (at < rows[:, None]) if forest else ~looked | (at < rows[:, None])
        if not hit.any():
            continue
        if forest:
            best = np.where(hit, agree, 0).argmax(1)
            i, j = rows[hit.any(1)], best[hit.any(1)]
        else:
            met = _met_before(members) if met is None else met
            i, j = np.nonzero(hit & ~met[rows])
            i = rows[i]
        more.append(np.maximum(i, j))
        less.append(np.minimum(i, j))
    docs, of = np.unique(doc, return_inverse=True)  # a set may stand on both sides
    found = np.unique(of[np.concatenate(more)] * len(docs) + of[np.concatenate(less)])
    return docs[found // len(docs)], docs[found % len(docs)]


def _compare(percent: int, forest: bool):
    """Of each node the sets that have a partner to be confirmed: (node, doc, partners, last).

    partners are smaller documents of other groups: the best one only, or all of them. A pair that several nodes
    hold is left to the smallest of them: p1 and p2 list the nodes where a set stands on either side of the comparison.
    last is the largest document that has this one for a partner.
    """

    def run(batches):
        for b in batches:
            for name, members in zip(b.column("node").to_pylist(), b.column("members").to_pylist(), strict=True):
                later, partner = _pairs(members, percent, forest)
                docs = np.union1d(later, partner)
                if not len(docs):
                    continue
                last = np.full(len(docs), -1)
                np.maximum.at(last, np.searchsorted(docs, partner), np.searchsorted(docs, later))
                starts = pa.array(np.append(np.searchsorted(later, docs), len(later)), pa.int32())
                cols = [pa.array(np.full(len(docs), name)), pa.array(docs), pa.ListArray.from_arrays(starts, pa.array(partner)), pa.array(docs[last], mask=last < 0)]
                yield pa.RecordBatch.from_arrays(cols, names=["node", "doc", "partners", "last"])

    return run


def _met_before(members: list[dict]) -> np.ndarray:
    """Whether two members stand on opposite sides of a comparison with a smaller name than this one's."""
    met = np.zeros((len(members), len(members)), bool)
    sides: dict[int, tuple[list, list]] = {}
    for i, m in enumerate(members):
        for k, side in enumerate(("p1", "p2")):
            for x in m[side]:
                if x < m["own"]:
                    sides.setdefault(x, ([], []))[k].append(i)
    for a, b in sides.values():
        if len(a) + len(b) > 2:
            met[np.ix_(a, b)] = met[np.ix_(b, a)] = True
    return met


def packed(batches):
    """(doc_id, text) with the text compressed, for the shuffles that carry whole texts."""
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([z.compress((t or "").encode()) for t in b.column(1).to_pylist()], pa.binary())], names=["doc_id", "z"])


def unpacked(column) -> pa.Array:
    z = zstandard.ZstdDecompressor()
    return pa.array([z.decompress(x).decode() for x in column.to_pylist()], pa.large_string())


def _confirm(k: int, percent: int):
    """Rows sorted by node and doc: emits the pairs of a document and a partner whose full sets are similar enough.

    A set is held only until its last partner has come.
    """

    def run(batches):
        node, held = None, {}
        for b in batches:
            off, data = text_bytes(unpacked(b.column("z")))
            a, c = [], []
            columns = zip(*(b.column(n).to_pylist() for n in ("node", "doc", "partners", "last")), strict=True)
            for i, j in pieces(off):
                for s in bh.shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], k):
                    name, doc, partners, last = next(columns)
                    if name != node:
                        node, held = name, {}
                    for x in [x for x, (until, _) in held.items() if until < doc]:
                        del held[x]
                    near = [(x, h) for x in partners if x in held for h in held[x][1] if 100 * min(len(h), len(s)) >= percent * max(len(h), len(s)) > 0]
                    if near:
                        size = np.array([len(h) for _, h in near])
                        flat = np.concatenate([h for _, h in near])
                        hit = s[np.minimum(np.searchsorted(s, flat), len(s) - 1)] == flat
                        both = np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64)
                        for i in np.flatnonzero(100 * both >= percent * (size + len(s) - both)):
                            a.append(near[i][0])
                            c.append(doc)
                    if last is not None:
                        held.setdefault(doc, (last, []))[1].append(s)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(c, pa.int64())], names=["a", "b"])

    return run


def _links(nodes: DataFrame, reps: DataFrame, texts: DataFrame, k: int, percent: int, forest: bool) -> DataFrame:
    """The links of nodes (node, own, doc, other), found on sketches and confirmed on full sets.

    A document's text goes once to each node where it has a partner, however many partners there are.
    """
    full = merged(nodes, reps.select("doc", "comp", "size", "sketch"), "doc")
    if forest:
        none = F.array().cast("array<long>")
        full = full.withColumn("p1", none).withColumn("p2", none)
    else:
        sides = nodes.select("doc", "own", "other").distinct().groupBy("doc")
        sides = sides.agg(*(F.collect_set(F.when(F.col("other") != out, F.col("own"))).alias(side) for side, out in (("p1", 2), ("p2", 1))))
        full = merged(full, sides, "doc")
    full = full.groupBy("node").agg(F.collect_list(F.struct("doc", "comp", "size", "other", "own", "sketch", "p1", "p2")).alias("members"))
    found = full.mapInArrow(_compare(percent, forest), "node long, doc long, partners array<long>, last long")
    rows = merged(found, texts.withColumnRenamed("doc_id", "doc"), "doc").repartition("node").sortWithinPartitions("node", "doc")
    return rows.mapInArrow(_confirm(k, percent), "a long, b long").distinct()


def _small(small: DataFrame) -> DataFrame:
    """Small nodes (path, doc) for _links; nodes of the same sets are one."""
    sets = small.groupBy("path").agg(F.sort_array(F.collect_set("doc")).alias("m")).where("size(m) > 1").select("m").distinct()
    return sets.select(F.xxhash64("m").alias("node"), F.explode("m").alias("doc")).select("node", F.col("node").alias("own"), "doc", F.lit(0).alias("other"))


def _parts(n: str, weight: str, leaf: int, room: int):
    """Into how many parts n sets with so many shingles go, so that each has at most leaf sets and room shingles."""
    return F.least(F.greatest(F.ceil(F.col(n) / leaf), F.ceil(F.col(weight) / room)), F.col(n))


def _alive(rows: DataFrame, leaf: int, room: int) -> DataFrame:
    """rows (path, doc, comp, size ...) of the nodes that have sets of two groups, with the parts they go into."""
    size = rows.groupBy("path").agg(F.count("*").alias("n"), F.sum("size").alias("weight"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    size = size.where("n > 1 and lo < hi").select("path", _parts("n", "weight", leaf, room).alias("parts"))
    return saved(merged(rows, size, "path"))


def _cost(rows: DataFrame, of: str) -> DataFrame:
    """The comparisons that the nodes of rows need: sums of all sets by those outside the largest group, for each `of`."""
    by = ["path"] if of == "path" else [of, "path"]
    groups = rows.groupBy(*by, "comp").agg(F.count("*").alias("c"))
    nodes = groups.groupBy(*by).agg(F.sum("c").alias("n"), F.max("c").alias("most"))
    return nodes.groupBy(of).agg(F.sum((F.col("n") - F.col("most")).cast("double") * F.col("n")).alias("cost"))


def _nodes(reps: DataFrame, trees: range, leaf: int, room: int) -> tuple[DataFrame, DataFrame | None]:
    """Small nodes of the trees as (path, doc), and the large ones that don't shrink (path, doc, comp, size, parts),
    both only where a node has sets of two groups."""
    alive = _alive(saved(reps.mapInArrow(_roots(trees), "path long, doc long, comp long, size long")), leaf, room)
    small, large, left = alive.where("parts = 1").select("path", "doc"), alive.where("parts > 1"), None
    while not large.isEmpty():
        rows = merged(large.select("path", "doc"), reps, "doc").mapInArrow(_deeper, "path long, doc long, comp long, size long, up long")
        below = _alive(saved(rows), leaf, room)
        cost = merged(_cost(large, "path"), _cost(below, "up").select(F.col("up").alias("path"), F.col("cost").alias("after")), "path", "left")
        on = saved(cost.where(F.coalesce("after", F.lit(0.0)) <= SHRINK * F.col("cost")).select("path"))
        stay = merged(large, on, "path", "left_anti").select("path", "doc", "comp", "size", "parts")
        left = stay if left is None else left.union(stay)
        below = merged(below, on.withColumnRenamed("path", "up"), "up", "left_semi")
        small = small.union(below.where("parts = 1").select("path", "doc"))
        large = saved(below.where("parts > 1").drop("up"))
    return small, left


def _blocks(left: DataFrame) -> DataFrame:
    block = F.pmod(F.xxhash64("path", "doc"), "parts")
    return left.select(F.xxhash64("path", block).alias("node"), F.col("path").alias("own"), "doc", F.lit(0).alias("other"))


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80, trees: int = 16, leaf: int = 4096, room: int = 1 << 22) -> DataFrame:
    """One row for each row of documents (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts are linked when 100 * |A & B| >= percent * |A | B| for their sets of distinct k-word shingles; every link
    that counts is confirmed on full sets. component_id is the smallest doc_id reachable. Two trees first join
    groups by their best pairs; `trees` more look for links between different groups only. A pair at the
    threshold is in a common node of one tree with chance 0.84 after one level and 0.52 after five, so 18 trees miss it
    with a chance below 2e-6, and its sketches with one of 1e-6; more similar pairs are missed less.

    Null, empty and blank texts have no shingles and stay alone; a null doc_id stays alone with a null component_id
    and is kept; equal rows are linked; rows that share a doc_id count as one document with all their links; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    small_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    signed = saved(docs.mapInArrow(_signatures(k), "doc_id long, n_shingles long, digest binary, sig binary, sketch binary"))
    found = signed.where("doc_id is not null and n_shingles > 0")
    classes = saved(found.groupBy("digest", "n_shingles").agg(F.min(F.struct("doc_id", "sig", "sketch")).alias("x")).select("digest", "n_shingles", F.col("x.doc_id").alias("doc"), F.col("n_shingles").alias("size"), "x.sig", "x.sketch"))
    reps = classes.select("doc", F.col("doc").alias("comp"), "size", "sig", "sketch")
    alone = merged(found.select("doc_id", "digest", "n_shingles"), classes.select("digest", "n_shingles", "doc"), ["digest", "n_shingles"])
    alone = alone.where("doc_id != doc").select(F.col("doc").alias("a"), F.col("doc_id").alias("b"))
    texts = docs.mapInArrow(packed, "doc_id long, z binary")

    small, left = _nodes(reps, range(2), leaf, room)
    nodes = _small(small)
    if left is not None:
        nodes = nodes.union(_blocks(left))
    links = saved(_links(nodes, reps, texts, k, percent, True))
    groups = saved(components(links))

    rows = merged(classes.select("doc", "size", "sig", "sketch"), groups.withColumnRenamed("id", "doc"), "doc", "left")
    reps = saved(rows.select("doc", F.coalesce("component", "doc").alias("comp"), "size", "sig", "sketch"))
    small, left = _nodes(reps, range(2, 2 + trees), leaf, room)
    nodes = _small(small)
    if left is not None:
        nodes = nodes.union(_against_rest(left, leaf, room))
    more = saved(_links(saved(nodes), reps, texts, k, percent, False))
    if not more.isEmpty():
        links = links.union(more)
        groups = saved(components(links))

    rep = merged(found.select("doc_id", "digest", "n_shingles"), classes.select("digest", "n_shingles", "doc"), ["digest", "n_shingles"])
    rep = merged(rep, groups.withColumnRenamed("id", "doc"), "doc", "left")
    ids = rep.select("doc_id", F.coalesce("component", "doc").alias("component"))
    twice = ids.groupBy("doc_id").agg(F.count_distinct("component").alias("n"), F.min("component").alias("component")).where("n > 1")
    if not twice.isEmpty():  # ids that stand for several texts join the groups of all of them
        groups = components(links.union(alone))
        ids = merged(found.select("doc_id").distinct(), groups.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component"))
    else:
        ids = ids.distinct()
    out = merged(signed.select("doc_id", "n_shingles"), ids, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _sizes(rows: DataFrame) -> DataFrame:
    """For each path of rows (path, doc, comp, size) its sets n and their shingles weight, its largest group and what lies outside that."""
    size = rows.groupBy("path", "comp").agg(F.count("*").alias("c"), F.sum("size").alias("w")).groupBy("path").agg(F.max(F.struct("c", "comp", "w")).alias("x"), F.sum("c").alias("n"), F.sum("w").alias("weight"))
    return size.select("path", "n", "weight", F.col("x.comp").alias("giant"), (F.col("n") - F.col("x.c")).alias("rest"), (F.col("weight") - F.col("x.w")).alias("rest_weight"))


def _united(rows: DataFrame) -> DataFrame:
    """rows (path, doc, comp, size) with nodes that share sets united, where that makes fewer comparisons than the nodes by themselves.

    Two rounds of smallest labels: a set takes the smallest of its nodes, a node the smallest of its sets. A node is
    always in one union with all its sets, so no pair is lost.
    """
    union = rows.select("path", F.col("path").alias("union")).distinct()
    for _ in range(2):
        named = merged(rows.select("path", "doc"), union, "path")
        low = named.groupBy("doc").agg(F.min("union").alias("low"))
        union = saved(merged(named, low, "doc").groupBy("path").agg(F.min("low").alias("union")))
    whole = saved(merged(rows, union, "path").select(F.col("union").alias("path"), "doc", "comp", "size").distinct())
    apart = merged(_cost(rows, "path"), union, "path").groupBy("union").agg(F.sum("cost").alias("apart"))
    cost = merged(_cost(whole, "path").withColumnRenamed("path", "union"), apart, "union")
    fewer = saved(cost.where("cost <= apart").select("union"))
    alone = merged(rows, merged(union, fewer, "union", "left_anti").select("path"), "path", "left_semi")
    return merged(whole, fewer.withColumnRenamed("union", "path"), "path", "left_semi").union(alone)


def _against_rest(left: DataFrame, leaf: int, room: int) -> DataFrame:
    """Of large nodes, all sets outside the largest group (other 1, in chunks) beside every block of all its sets (other 2)."""
    rows = saved(_united(saved(left.select("path", "doc", "comp", "size"))))
    half = leaf // 2, room // 2
    size = _sizes(rows).select("path", "giant", _parts("n", "weight", *half).alias("blocks"), _parts("rest", "rest_weight", *half).alias("chunks"))
    rows = merged(rows, size, "path").where("chunks > 0")
    block, chunk = F.pmod(F.xxhash64("doc", "path"), "blocks"), F.pmod(F.xxhash64("path", "doc"), "chunks")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rest = rows.where("comp != giant").select("path", "blocks", chunk.alias("chunk"), "doc").select("path", each("blocks").alias("blk"), "chunk", "doc", F.lit(1).alias("other"))
    all_ = rows.select("path", "chunks", block.alias("blk"), "doc").select("path", "blk", each("chunks").alias("chunk"), "doc", F.lit(2).alias("other"))
    rows = rest.unionByName(all_)
    return rows.select(F.xxhash64("path", "blk", "chunk").alias("node"), F.col("path").alias("own"), "doc", "other")
