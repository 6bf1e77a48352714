"""Removal of long repeated byte strings by a hash-compared suffix sort.

A byte goes when a string of `length` bytes that covers it also starts elsewhere. Only suffixes that can have such a
twin are sorted. Every window of `length` bytes names an anchor in itself, the k-gram with the least hash; windows in
a row with one anchor make a run. Equal windows have equal anchors at equal offsets, so a run whose anchor is met
nowhere else has no repeated window, and a run met again whole (the same BLAKE2b digest of all its bytes and the
same offsets) is repeated throughout. What remains, mostly runs at the ends of repeats, is gathered by anchor as one
run of each class, and the suffixes at its windows are sorted: by their first eight bytes, then by a merge sort that
compares two suffixes through prefix polynomial hashes, with a binary search for their common extension. Neighbours
in that order that agree over `length` bytes are compared byte by byte before they count. Anchors with more than
`crowd` different runs aren't gathered: their windows are counted by BLAKE2b digests of their bytes in an aggregate.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytehash as bh
from tidewatch.llm.common import merged, pieces, saved, small_batches, text_bytes
from tidewatch.llm.near_dedup import packed, unpacked

U = np.uint64
GRAM = 32
#: Bytes of a text that are looked at together; a longer text is taken in overlapping parts.
PART = 4 << 20
SUFFIXES = 300_000


def _running_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, with one pass over blocks in each direction."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(U).max, U)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of 128-bit BLAKE2b digests of the byte strings [start, end)."""
    view = memoryview(np.ascontiguousarray(data))
    both = b"".join([hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    return tuple(np.frombuffer(both, np.int64).reshape(-1, 2).T)


def _window_starts(off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows that lie in one text, in order, and the text of each: counted up from the texts, so that no place is looked for."""
    n = np.maximum(np.diff(off) - length + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    return np.arange(len(row)) + np.repeat(off[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n), row


def _runs_of(data: np.ndarray, off: np.ndarray, length: int, whole: bool):
    """Runs of windows with one anchor in the texts of a piece: the anchor's hash, and if whole the digest, row, start in the row, and offsets of the anchor."""
    w = length - GRAM + 1
    p = bh.prefix(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = bh.mix(bh.span(p, at, at + GRAM))
    # the upper bits of the hash order the grams, the place parts equal ones: the first one counts
    anchor = (_running_min((gram & ~U(0xFFFFFF)) | at.astype(U), w) & U(0xFFFFFF)).astype(np.int64)
    s, row = _window_starts(off, length)
    anchor = anchor[s]
    if not len(s):
        return None
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(row) != 0)]))
    last = np.concatenate([first[1:], [len(s)]]) - 1
    lo, hi, a, row = s[first], s[last], anchor[first], row[first]
    if not whole:
        return (gram[a].view(np.int64),)
    return gram[a].view(np.int64), *digests(data, lo, hi + length), row, lo - off[row], ((a - lo) * 65536 + a - hi).astype(np.int32)


def _runs(length: int, whole: bool):
    """Runs of all texts; unless whole, only their anchors."""

    def parts(off):
        for i, j in pieces(off):
            size = off[j] - off[i]
            if size <= PART:
                yield i, off[i], off[j], off[i : j + 1] - off[i]
            else:
                for c in range(0, int(size) - length + 1, PART):
                    end = min(int(size), c + PART + length - 1)
                    yield i, off[i] + c, off[i] + end, np.array([0, end - c])

    def run(batches):
        for b in batches:
            off, data = text_bytes(b.column("text"))
            out = []
            with np.errstate(over="ignore"):
                for i, start, end, own in parts(off):
                    if end - start >= length and (found := _runs_of(data[start:end], own, length, whole)):
                        if whole:
                            found[3][:] += i
                            found[4][:] += start - off[i] if len(own) == 2 else 0
                        out.append(found)
            if not out:
                continue
            g, *rest = (np.concatenate(x) for x in zip(*out, strict=True))
            if not whole:
                yield pa.RecordBatch.from_arrays([pa.array(g)], names=["g"])
                continue
            h1, h2, row, lo, offsets = rest
            take = pa.array(row)
            cols = [pa.array(g), pa.array(h1), pa.array(h2), b.column("doc").take(take), b.column("mark").take(take), pa.array(lo.astype(np.int64)), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(cols, names=["g", "h1", "h2", "doc", "mark", "lo", "offsets"])

    return run


def common_extension(p: np.ndarray, i: np.ndarray, j: np.ndarray, length: int) -> np.ndarray:
    """How many bytes the suffixes at i and j have in common, `length` at most, by binary search on prefix hashes."""
    got = np.zeros(len(i), np.int64)
    step = 1 << (length.bit_length() - 1)
    while step:
        fits = got + step <= length
        x, y = (i + got)[fits], (j + got)[fits]
        got[np.flatnonzero(fits)[bh.span(p, x, x + step) == bh.span(p, y, y + step)]] += step
        step >>= 1
    return got


def suffix_order(data: np.ndarray, p: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts sorted by their first `length` bytes, and the common extension of each with the one before it."""
    first = np.zeros(len(starts), U)
    for k in range(8):
        first = (first << U(8)) | data[starts + k]
    order = np.argsort(first, kind="stable")
    starts, first = starts[order], first[order]
    edge = np.concatenate([[True], first[1:] != first[:-1]])
    group = np.flatnonzero(edge)[np.cumsum(edge) - 1]
    size = np.diff(np.concatenate([np.flatnonzero(edge), [len(starts)]]))[np.cumsum(edge) - 1]
    place = np.arange(len(starts)) - group

    def before(i, j, ties):
        """Is suffix i to stand before suffix j; ties: what holds for equal ones."""
        e = common_extension(p, i, j, length)
        end = e == length
        k = np.where(end, 0, e)
        return np.where(end, ties, data[i + k] < data[j + k])

    width = 1
    while len(busy := np.flatnonzero(size > width)):
        own = place[busy] // width
        left = own % 2 == 0
        start = group[busy] + np.where(left, own + 1, own - 1) * width
        stop = np.minimum(start + width, group[busy] + size[busy])
        lo, hi = np.minimum(start, stop), stop.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            # how many of the other run stand before this one: of equal ones, those of the left run
            ahead = before(starts[mid], starts[busy[open_]], ~left[open_])
            lo[open_[ahead]] = mid[ahead] + 1
            hi[open_[~ahead]] = mid[~ahead]
            open_ = open_[lo[open_] < hi[open_]]
        rank = np.maximum(lo - start, 0)
        rank[start >= group[busy] + size[busy]] = 0
        base = group[busy] + (own // 2) * 2 * width
        target = base + place[busy] % width + rank
        moved = starts.copy()
        moved[target] = starts[busy]
        starts = moved
        width *= 2
    extension = np.zeros(len(starts), np.int64)
    same = np.flatnonzero(~edge)
    extension[same] = common_extension(p, starts[same - 1], starts[same], length)
    return starts, extension


def _repeated(bodies: list[bytes], counts: list[int], length: int) -> np.ndarray:
    """For each body its first `counts` windows: does the window stand at another start too?"""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x) for x in bodies])])
    counts = np.array(counts)
    starts = np.repeat(off[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    with np.errstate(over="ignore"):
        order, extension = suffix_order(data, bh.prefix(data), starts, length)
    twin = np.zeros(len(data), bool)
    pairs = np.flatnonzero(extension >= length)
    wrong = []
    for c in range(0, len(pairs), 4096):
        i, j = order[pairs[c : c + 4096] - 1], order[pairs[c : c + 4096]]
        same = (data[i[:, None] + np.arange(length)] == data[j[:, None] + np.arange(length)]).all(1)
        twin[i[same]] = twin[j[same]] = True
        wrong += data[i[~same]].tolist()
    if wrong:  # hashes met for different bytes: count the windows themselves
        seen: dict[bytes, list[int]] = {}
        for s in starts.tolist():
            seen.setdefault(data[s : s + length].tobytes(), []).append(s)
        twin[:] = False
        for places in seen.values():
            twin[places] = len(places) > 1
    return twin[starts]


def _stretches(rows: list[tuple], counts: list[int], twin: np.ndarray):
    """Runs of repeated windows of the bodies that aren't known to be repeated throughout."""
    own = np.repeat(np.arange(len(counts)), counts)
    known = np.array([r[3] for r in rows])
    flag = twin & ~known[own]
    at = np.arange(len(own)) - np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    left = np.flatnonzero(flag & np.concatenate([[True], ~flag[:-1] | (own[1:] != own[:-1])]))
    right = np.flatnonzero(flag & np.concatenate([~flag[1:] | (own[1:] != own[:-1]), [True]]))
    r = [rows[i] for i in own[left]]
    lo = np.array([x[2] for x in r], np.int64)
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in r], pa.int64()), pa.array([x[1] for x in r], pa.int64()), pa.array(lo + at[left]), pa.array(lo + at[right])], names=["doc", "mark", "lo", "hi"])


def _resolve(length: int):
    """Rows sorted by anchor; sorts the suffixes of whole anchor groups, a bounded number at a time."""

    def run(batches):
        rows, bodies, counts, total, cut, last = [], [], [], 0, 0, None

        def flush(n):
            nonlocal rows, bodies, counts, total
            if n:
                yield _stretches(rows[:n], counts[:n], _repeated(bodies[:n], counts[:n], length))
            rows, bodies, counts = rows[n:], bodies[n:], counts[n:]
            total = sum(counts)

        for b in batches:
            for g, doc, mark, lo, offsets, known, body in zip(*(b.column(n).to_pylist() for n in ("g", "doc", "mark", "lo", "offsets", "known", "body")), strict=True):
                if g != last:
                    last, cut = g, len(rows)
                    if total >= SUFFIXES:
                        yield from flush(cut)
                        cut = 0
                rows.append((doc, mark, lo, known))
                bodies.append(body)
                counts.append((offsets >> 16) - (offsets & 0xFFFF) + 1)
                total += counts[-1]
        yield from flush(len(rows))

    return run


def _bodies(length: int):
    """The bytes of the wanted runs of each text."""

    def run(batches):
        for b in batches:
            out = [[] for _ in range(8)]
            texts = unpacked(b.column("z")).to_pylist()
            for text, doc, mark, wanted in zip(texts, b.column("doc").to_pylist(), b.column("mark").to_pylist(), b.column("wanted").to_pylist(), strict=True):
                raw = text.encode()
                for x in wanted:
                    end = x["lo"] + (x["offsets"] >> 16) - (x["offsets"] & 0xFFFF) + length
                    for o, v in zip(out, (x["g"], doc, mark, x["lo"], x["offsets"], x["known"], x["crowded"], raw[x["lo"] : end]), strict=True):
                        o.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds, strict=True)], names=["g", "doc", "mark", "lo", "offsets", "known", "crowded", "body"])

    return run


def _windows(length: int):
    """A row with the digest of each window of the bodies."""

    def run(batches):
        for b in batches:
            out = []
            for i, (body, lo, offsets) in enumerate(zip(b.column("body").to_pylist(), b.column("lo").to_pylist(), b.column("offsets").to_pylist(), strict=True)):
                s = np.arange((offsets >> 16) - (offsets & 0xFFFF) + 1)
                out.append((np.full(len(s), i), s + lo, *digests(np.frombuffer(body, np.uint8), s, s + length)))
            if not out:
                continue
            i, s, w1, w2 = (np.concatenate(x) for x in zip(*out, strict=True))
            take = pa.array(i)
            yield pa.RecordBatch.from_arrays([pa.array(w1), pa.array(w2), b.column("doc").take(take), b.column("mark").take(take), pa.array(s), b.column("known").take(take)], names=["w1", "w2", "doc", "mark", "lo", "known"])

    return run


def _cut(length: int, with_text: bool):
    def run(batches):
        for b in batches:
            out = [[] for _ in range(5)]
            texts = unpacked(b.column("z")).to_pylist()
            for text, spans in zip(texts, b.column("spans").to_pylist(), strict=True):
                raw = text.encode()
                kept, removed, n, at = [], 0, 0, 0
                end = None
                for x in sorted((x["lo"], x["hi"] + length) for x in spans or ()):
                    if end is not None and x[0] <= end:
                        end = max(end, x[1])
                        continue
                    if end is not None:
                        at = end
                    kept.append(raw[at : x[0]])
                    n, end = n + 1, x[1]
                if end is not None:
                    at = end
                kept.append(raw[at:])
                rest = b"".join(kept)
                removed = len(raw) - len(rest)
                for o, v in zip(out, (len(raw), removed, n, hashlib.sha256(rest).hexdigest(), rest if with_text else None), strict=True):
                    o.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"]
            m = 5 if with_text else 4
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(o, k) for o, k in zip(out[:m], kinds[:m], strict=True)]], names=["doc_id", *names[:m]])

    return run


def cut_repeats(documents: DataFrame, length: int = 200, crowd: int = 4096, with_text: bool = False) -> DataFrame:
    """One row for each row of documents (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with_text kept_bytes.

    Texts are UTF-8 bytes; every byte covered by a string of `length` bytes that also starts anywhere else goes, judged on
    the input. Null and shorter texts keep all. Equal rows, and rows that share a doc_id, are documents of their own
    (equal ones repeat each other); a null doc_id is kept as null; other columns are ignored; an empty table gives an
    empty result.
    """
    spark = documents.sparkSession
    small_batches(spark)
    # rows are told apart by doc_id and a hash of the text, those without a doc_id by two
    docs = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("second"), "text")).alias("doc"), F.xxhash64("text").alias("mark"), "text")
    anchors = docs.select("text").mapInArrow(_runs(length, False), "g long")
    again = saved(anchors.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"))
    runs = docs.select("doc", "mark", "text").mapInArrow(_runs(length, True), "g long, h1 long, h2 long, doc long, mark long, lo long, offsets int")
    runs = saved(merged(runs, again, "g"))
    key = ["g", "h1", "h2", "offsets"]
    classes = saved(runs.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("doc", "mark", "lo")).alias("x")))
    whole = merged(runs, classes.where("n > 1").select(*key), key).select("doc", "mark", "lo", (F.col("lo") + F.shiftright("offsets", 16) - F.col("offsets").bitwiseAND(0xFFFF)).alias("hi"))
    mixed = classes.groupBy("g").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    wanted = merged(classes, mixed, "g").select("g", "offsets", "x.*", (F.col("n") > 1).alias("known"), (F.col("kinds") > crowd).alias("crowded"))
    wanted = wanted.groupBy("doc", "mark").agg(F.collect_list(F.struct("g", "lo", "offsets", "known", "crowded")).alias("wanted"))

    def compressed(batches):
        for b in batches:
            z = next(packed(iter([pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text")], names=["doc_id", "text"])])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("doc"), b.column("mark"), z.column("z")], names=["doc_id", "doc", "mark", "z"])

    small = docs.mapInArrow(compressed, "doc_id long, doc long, mark long, z binary")
    bodies = saved(small.join(wanted, ["doc", "mark"]).mapInArrow(_bodies(length), "g long, doc long, mark long, lo long, offsets int, known boolean, crowded boolean, body binary"))
    sorted_ = bodies.where("not crowded").repartition("g").sortWithinPartitions("g").mapInArrow(_resolve(length), "doc long, mark long, lo long, hi long")
    windows = bodies.where("crowded").mapInArrow(_windows(length), "w1 long, w2 long, doc long, mark long, lo long, known boolean")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    counted = windows.where("not known").join(twice, ["w1", "w2"]).select("doc", "mark", "lo", F.col("lo").alias("hi"))
    spans = whole.union(sorted_).union(counted).groupBy("doc", "mark").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_text
    return small.join(spans, ["doc", "mark"], "left").mapInArrow(_cut(length, with_text), schema)
