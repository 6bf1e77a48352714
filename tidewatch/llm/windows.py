"""Removal of repeated token windows: Rabin-Karp hashes of every window of `length` words, counted over the whole corpus.

Documents are dealt into batches of a few megabytes, written once. Of a batch each different window is one entry, at its
first place, and its hash says in which bucket it is counted; what stands again in the batch itself is known there. An
entry is 10 bytes (80 bits besides those that name the bucket): entries travel as arrays in document order, with the
ids of their documents, so that a window that a third of all documents hold is one entry of each batch. A bucket
answers with one bit for each entry, whether the window starts earlier elsewhere, and the bits go back to the batch,
where windows that start earlier merge into maximal intervals of words.

Two different windows are taken for one with a chance of less than n * n / 2**81 / buckets for n windows in all.
"""

import itertools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import bytehash as bh
from tidewatch.llm.common import saved, small_batches

U = np.uint64
#: Bytes of text in a batch, about; a longer text is a batch of its own. Words and windows are hashed in parts of this size.
BATCH = 4 << 20
PART = 1 << 20
#: Buckets for each shuffle partition.
BUCKETS = 2
LAST = np.iinfo(np.int64).max


def _batched(size: int):
    """Batches of documents in the order of their ids: ids, lengths in bytes and the texts, compressed."""

    def run(batches):
        z, n = zstandard.ZstdCompressor(level=3), itertools.count(TaskContext.get().partitionId() << 33)

        def flush(held):
            held.sort(key=lambda x: LAST if x[0] is None else x[0])
            texts = [x[1] for x in held]
            cols = [next(n)], [[x[0] for x in held]], [[len(x) for x in texts]], [z.compress(b"".join(texts))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()), strict=True)], names=["batch", "ids", "sizes", "z"])

        held, total = [], 0
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                raw = (t or "").encode()
                if held and total + len(raw) > size:
                    yield flush(held)
                    held, total = [], 0
                held.append((i, raw))
                total += len(raw)
        if held:
            yield flush(held)

    return run


def _word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each row how many words come before it."""
    out, ends, first, n = [], [], 0, len(data)
    while first < n:
        past = min(n, first + PART)
        while past < n and not bh.BLANK[data[past]]:  # not within a word
            stop = np.flatnonzero(bh.BLANK[data[past : past + PART]])
            past = past + int(stop[0]) if len(stop) else min(n, past + PART)
        own = off[(off > first) & (off < past)] - first
        part = data[first:past]
        start, end = bh.words(part, np.concatenate([[0], own, [past - first]]), bh.BLANK)
        out.append(bh.mix(bh.span(bh.prefix(part), start, end) + (end - start).astype(U) * U(bh.BASES[1])))
        ends.append(start + first)
        first = past
    w = np.concatenate(out) if out else np.zeros(0, U)
    start = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    return w, np.searchsorted(start, off)


def rolling(w: np.ndarray, length: int, which: int) -> np.ndarray:
    """Polynomial hashes of each `length` consecutive values: prefix sums of value times a power of the base, shifted back."""
    out = np.zeros(max(0, len(w) - length + 1), U)
    for a in range(0, len(out), PART):
        part = w[a : min(len(w), a + PART + length - 1)]
        up, down = bh.powers(len(part), which)
        p = np.zeros(len(part) + 1, U)
        np.cumsum(part * up[: len(part)], out=p[1:])
        n = len(part) - length + 1
        out[a : a + n] = bh.mix((p[length:] - p[:n]) * down[:n])
    return out


def _by_value(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that brings equal values (low, high) together, and where in it another value begins."""
    order = np.argsort(low, kind="stable")
    same = low[order][1:] == low[order][:-1]
    if (same & (high[order][1:] != high[order][:-1])).any():
        order = np.lexsort((high, low))
        same = low[order][1:] == low[order][:-1]
    same &= high[order][1:] == high[order][:-1]
    return order, np.concatenate([np.ones(min(1, len(low)), bool), ~same])


class _Windows:
    """The windows of a batch: starts (numbers of words), hashes, and the entries, ordered by bucket, then by place."""

    def __init__(self, data: np.ndarray, off: np.ndarray, length: int, buckets: int):
        with np.errstate(over="ignore"):
            w, self.count = _word_hashes(data, off)
            low, high = rolling(w, length, 0), (rolling(bh.mix(w + U(1)), length, 1) >> U(48)).astype(np.uint16)
        row = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(self.count))
        self.start = np.flatnonzero(row[: len(low)] == row[length - 1 :]) if len(low) else np.zeros(0, np.int64)
        self.row, low, high = row[self.start], low[self.start], high[self.start]
        order, new = _by_value(low, high)
        first = np.sort(order[new])
        #: windows that start earlier in the same batch
        self.again = np.ones(len(low), bool)
        self.again[first] = False
        bucket = ((low[first] >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        self.entry = first[by]
        self.low, self.high = low[self.entry], high[self.entry]
        self.edge = np.searchsorted(bucket[by], np.arange(buckets + 1))


def _texts(b: pa.RecordBatch):
    """The rows of the batch table as (ids, offsets, bytes)."""
    z = zstandard.ZstdDecompressor()
    for k in range(b.num_rows):
        off = np.concatenate([[0], np.cumsum(np.array(b.column("sizes")[k].as_py(), np.int64))])
        yield b.column("ids")[k].as_py(), off, np.frombuffer(z.decompress(b.column("z")[k].as_py()), np.uint8)


def _entries(length: int, buckets: int):
    def run(batches):
        for b in batches:
            for (ids, off, data), batch in zip(_texts(b), b.column("batch").to_pylist(), strict=True):
                own, out = _Windows(data, off, length, buckets), []
                ids = np.array([LAST if i is None else i for i in ids], np.int64)
                for k in np.flatnonzero(np.diff(own.edge)).tolist():
                    a, c = own.edge[k], own.edge[k + 1]
                    row = own.row[own.entry[a:c]]
                    head = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
                    counts = np.diff(np.concatenate([head, [c - a]])).astype(np.uint32)
                    out.append((k, batch, own.low[a:c].tobytes(), own.high[a:c].tobytes(), np.diff(ids[row[head]], prepend=0).tobytes(), counts.tobytes()))
                if out:
                    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["bucket", "batch", "low", "high", "ids", "counts"])

    return run


def _earlier(table: pa.Table) -> pa.Table:
    """Of one bucket: for each batch a bit for each entry, whether the same window starts earlier in another batch.

    Earlier is by document; among rows that share an id, by batch.
    """
    table = table.sort_by("batch")

    def read(name, kind):
        return [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]

    low, high, counts = read("low", U), read("high", np.uint16), read("counts", np.uint32)
    ids = np.concatenate([np.repeat(np.cumsum(i), c) for i, c in zip(read("ids", np.int64), counts, strict=True)])
    size = [len(x) for x in low]
    by_id = np.argsort(ids, kind="stable")
    order, new = _by_value(np.concatenate(low)[by_id], np.concatenate(high)[by_id])
    bits = np.ones(len(ids), bool)
    bits[by_id[order[new]]] = False
    rows = [(batch, k, np.packbits(x).tobytes()) for batch, k, x in zip(table.column("batch").to_pylist(), table.column("bucket").to_pylist(), np.split(bits, np.cumsum(size)[:-1]), strict=True) if x.any()]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["batch", "bucket", "bits"])


def _intervals(length: int, buckets: int):
    """Of each document the words that windows cover which start earlier, as maximal intervals, and the words that stay."""

    def run(batches):
        for b in batches:
            for (ids, off, data), found in zip(_texts(b), b.column("found").to_pylist(), strict=True):
                own = _Windows(data, off, length, buckets)
                gone = own.again
                for x in found or ():
                    a, c = own.edge[x["bucket"]], own.edge[x["bucket"] + 1]
                    gone[own.entry[a:c][np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=c - a).astype(bool)]] = True
                n, hit = int(own.count[-1]) + 1, own.start[gone]
                covered = np.cumsum(np.bincount(hit, minlength=n) - np.bincount(hit + length, minlength=n))[:-1] > 0
                raw = data.tobytes()
                for first in range(0, len(ids), 1000):  # bounded rows of output at a time
                    out = []
                    for k in range(first, min(len(ids), first + 1000)):
                        cut = covered[own.count[k] : own.count[k + 1]]
                        turn = np.flatnonzero(np.diff(np.concatenate([[False], cut, [False]])))
                        words = raw[off[k] : off[k + 1]].split()
                        kept = b" ".join(itertools.compress(words, ~cut) if len(turn) else words)
                        out.append((ids[k], len(cut), [{"first": x, "past": y} for x, y in turn.reshape(-1, 2).tolist()], kept.decode()))
                    kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())])), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["doc_id", "n_words", "removed", "kept_text"])

    return run


def repeated_windows(documents: DataFrame, length: int = 20, batch_bytes: int = BATCH) -> DataFrame:
    """One row for each row of documents (doc_id, text): doc_id, n_words, removed (array of (first, past), words from 0), kept_text.

    Words are runs of bytes other than space and tab to carriage return, unchanged. A word goes if a window of `length` words
    covers it whose words also start earlier: in a document of smaller id, or before it in the same one; windows are judged on the
    input. What stays is joined by one space. Null, empty and shorter texts lose nothing. Rows that share a doc_id are documents of
    their own, in no given order among themselves: of a window that only they hold, one of them keeps its first place. A null doc_id is
    larger than any other. Other columns are ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    small_batches(spark)
    buckets = BUCKETS * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    batches = saved(docs.mapInArrow(_batched(batch_bytes), "batch long, ids array<long>, sizes array<long>, z binary"))
    entries = batches.mapInArrow(_entries(length, buckets), "bucket int, batch long, low binary, high binary, ids binary, counts binary")
    earlier = saved(entries.groupBy("bucket").applyInArrow(_earlier, "batch long, bucket int, bits binary"))
    found = earlier.groupBy("batch").agg(F.collect_list(F.struct("bucket", "bits")).alias("found"))
    with_found = batches.join(found.hint("merge"), "batch", "left")
    return with_found.mapInArrow(_intervals(length, buckets), "doc_id long, n_words long, removed array<struct<first:long,past:long>>, kept_text string")
