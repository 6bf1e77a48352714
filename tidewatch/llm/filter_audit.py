"""Audit of document filters in every order: who removes what, alone, first, or after the others.

Each document gets the mask of the filters that it fails. Four judge a text alone; the fifth, being a copy of a smaller
document, is found by routing: an RDD of documents is partitioned by the xxhash of the text, and a partition keeps for
each fingerprint a chain of the different full texts with the minimum id of each, so that texts whose hashes collide
stay apart. Before anything moves, each task chains its own rows in bounded memory: rows that aren't the minimum there
are decided there, so that a text that a third of all rows share travels a few times a task. Masks meet the labels
by document, and combineByKey merges them into vectors of counts (one for each part, a place for each mask and label), from
which the figures of all orders follow.
"""

import itertools
import math

import pyarrow as pa
import zstandard
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import merged, saved, small_batches

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")
UPPER, SIGNS = bytes(range(65, 91)), b"#$%&*|"
#: Bytes of texts that a task chains before it passes them on.
CHAINED = 32 << 20
#: A vector has a place for each mask and each of the four pairs of labels.
PLACES = 4 << len(LETTERS)
#: What a task passes on, and an odd number that spreads decided rows.
ENTRY = pa.schema([("hash", pa.int64()), ("z", pa.binary()), ("doc_id", pa.int64()), ("mask", pa.int32()), ("parts", pa.map_(pa.string(), pa.int64()))])
ODD = 0x9E3779B97F4A7C15
COLUMNS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(text: str) -> int:
    """The filters of A to D that a text fails.

    A: under 50 words. B: under 65 different words of 100. C: over 5 letters A-Z of 100 code points. D: any of the signs # $ % & * |.
    """
    raw = text.encode()
    words = raw.split()
    fails = len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * (len(raw) - len(raw.translate(None, UPPER))) > 5 * len(text), len(raw) != len(raw.translate(None, SIGNS))
    return sum(x << i for i, x in enumerate(fails))


def _rank(doc_id: int | None) -> float | int:
    return math.inf if doc_id is None else doc_id


class Chains:
    """Texts by fingerprint: for each different text its smallest doc_id, its mask, and how many rows of each part have that id."""

    def __init__(self):
        self.by_hash, self.size = {}, 0

    def add(self, fingerprint: int, text: str, doc_id: int | None, mask: int | None, parts: dict[str, int]):
        """Yields (doc_id, part, mask, rows) of the rows that turn out to be copies of a smaller document."""
        chain = self.by_hash.setdefault(fingerprint, [])
        entry = next((x for x in chain if x[0] == text), None)
        if entry is None:
            chain.append([text, doc_id, text_mask(text) if mask is None else mask, dict(parts)])
            self.size += len(text) + 200
            return
        if _rank(doc_id) < _rank(entry[1]):
            late, entry[1], entry[3] = (entry[1], entry[3]), doc_id, dict(parts)
        elif doc_id == entry[1]:
            late = None
            for part, n in parts.items():
                entry[3][part] = entry[3].get(part, 0) + n
        else:
            late = doc_id, parts
        if late:
            for part, n in late[1].items():
                yield late[0], part, entry[2] | COPY, n


def _chained(batches):
    """Of a task's rows: those that are decided, and the minimum of each text with the text; hash: where they are routed to."""
    z, chains, out = zstandard.ZstdCompressor(level=1), Chains(), []

    def batch(rows):
        columns = [x[0] for x in rows], [x[1] for x in rows], [x[2] for x in rows], [x[3] for x in rows], [list(x[4].items()) for x in rows]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ENTRY.types, strict=True)], schema=ENTRY)

    def flush():
        for h, chain in chains.by_hash.items():
            for text, doc_id, mask, parts in chain:
                yield h, z.compress(text.encode()), doc_id, mask, parts

    place = 0
    for b in batches:
        for fingerprint, text, doc_id, part in zip(*(b.column(c).to_pylist() for c in ("fingerprint", "text", "doc_id", "part")), strict=True):
            for late in chains.add(fingerprint, text, doc_id, None, {part: 1}):
                place += 1  # decided rows don't all go to where the text is
                out.append(((fingerprint + place * ODD) % (1 << 63), None, late[0], late[2], {late[1]: late[3]}))
        if chains.size > CHAINED:
            yield batch(list(flush()))
            chains = Chains()
        if out:
            yield batch(out)
            out = []
    yield batch(list(flush()))


def _resolved(rows):
    """Rows sorted by hash: one chain is held at a time."""
    z, last, chains = zstandard.ZstdDecompressor(), None, Chains()

    def rest():
        for chain in chains.by_hash.values():
            for _, doc_id, mask, parts in chain:
                yield from ((doc_id, part, mask, n) for part, n in parts.items())

    for h, (text, doc_id, mask, parts) in rows:
        if text is None:
            yield from ((doc_id, part, mask, n) for part, n in parts.items())
            continue
        if h != last:
            yield from rest()
            last, chains = h, Chains()
        yield from chains.add(h, z.decompress(text).decode(), doc_id, mask, parts)
    yield from rest()


def masks(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, part, mask, rows): how many rows of documents (doc_id, text, source) have the id, the source and fail just these filters."""
    spark = documents.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("fingerprint"))
    entries = saved(rows.mapInArrow(_chained, "hash long, z binary, doc_id long, mask int, parts map<string, long>"))
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = entries.rdd.map(lambda r: (r[0], (r[1], r[2], r[3], r[4])))
    routed = pairs.repartitionAndSortWithinPartitions(partitions, lambda h: h % partitions)
    return spark.createDataFrame(routed.mapPartitions(_resolved), "doc_id long, part string, mask int, rows long", verifySchema=False)


def _create(value: tuple[int, int]) -> list[int]:
    return _add([0] * PLACES, value)


def _add(vector: list[int], value: tuple[int, int]) -> list[int]:
    vector[value[0]] += value[1]
    return vector


def _merge(a: list[int], b: list[int]) -> list[int]:
    return [x + y for x, y in zip(a, b, strict=True)]


def count_vectors(masks: DataFrame, labels: DataFrame) -> RDD:
    """(part, counts by 4 * mask + 2 * good + toxic) of the rows that masks() gives."""
    label = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.expr("int(quality = 1)")).alias("good"), F.max(F.expr("int(toxic = 1)")).alias("toxic"))
    counted = masks.groupBy("doc_id", "part", "mask").agg(F.sum("rows").alias("rows"))
    both = merged(counted, label.where("doc_id is not null"), "doc_id", "left")
    place = F.col("mask") * 4 + F.coalesce("good", F.lit(0)) * 2 + F.coalesce("toxic", F.lit(0))
    return both.select("part", place.alias("place"), "rows").rdd.map(lambda r: (r[0], (r[1], r[2]))).combineByKey(_create, _add, _merge)


def orders(vector: list[int]):
    """For each order of the filters and each step of it: (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost)."""
    full = range(1 << len(LETTERS))
    total = [sum(vector[4 * m : 4 * m + 4]) for m in full]
    good = [vector[4 * m + 2] + vector[4 * m + 3] for m in full]
    toxic = [vector[4 * m + 1] + vector[4 * m + 3] for m in full]
    for order in itertools.permutations(range(len(LETTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            bit = 1 << f
            here = [m for m in full if m & bit and not m & before]
            redundant = sum(total[m] for m in full if m & bit and m & before)
            before |= bit
            kept = sum(total[m] for m in full if not m & before)
            yield "".join(LETTERS[i] for i in order), step, kept, sum(total[m] for m in here), redundant, total[bit], sum(good[m] for m in here), sum(toxic[m] for m in here)


def _figures(part_and_vector):
    part, vector = part_and_vector
    rows = list(orders(vector))
    shapley = dict.fromkeys(LETTERS, 0)
    for order, step, _, removed, *_ in rows:
        shapley[order[step - 1]] += removed
    return [(part, *row, shapley[row[0][row[1] - 1]]) for row in rows]


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (source; null: the empty string), each order of the five filters and each step of it.

    documents has doc_id, text (null: empty) and source; labels has doc_id, quality and toxic. A to D are those of
    text_mask; E fails what is identical to the text of any smaller doc_id in the whole table. kept: documents that are left after
    the step; removed: by its filter here; redundant: fail it, but were removed before; unique_fails: fail no other filter;
    good_lost, toxic_lost: of the removed those with label quality or toxic 1; shapley: what the filter removes, summed over
    all orders. A null doc_id is larger than any other and has no labels; rows that share an id and a text are no copies of each other; of
    several labels of an id the largest counts. Other columns are ignored; an empty table gives an empty result.
    """
    return documents.sparkSession.createDataFrame(count_vectors(masks(documents), labels).flatMap(_figures), COLUMNS)
