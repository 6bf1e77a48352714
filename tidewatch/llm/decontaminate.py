"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame operations only.

A short item inside a long document has a tiny Jaccard similarity, so the search is for containment: the share of an
item's word shingles that a document has. Items are partitioned by the size of their shingle sets (powers of two), and
each partition has a MinHash sketch of its own length: one value more than the largest set of the partition may lack
at the threshold, and so every document that contains enough of an item has a value of its sketch, whatever the
document's size. Documents probe the sketches with all their shingles; candidates are then verified by the exact
containment of shingles, as words and not as hashes.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import merged_on, saved

#: Sketch values that may be sent to every executor (16 bytes each); beyond it the probe is a shuffled join.
BROADCAST_VALUES = 200_000


#: The words of a text: A-Z lower-cased, parted by blanks.
WORDS = "filter(split(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x != '')"


def _shingles(each: str, whole: str, kind: str, k: int) -> Column:
    """`each` of every k words in a row (at i) of column text, or `whole` of a shorter text. The words are bound to a lambda
    variable, so that they are split once and not for each shingle."""
    words = WORDS.format(text="text")
    return F.expr(f"transform(array({words}), w -> CASE WHEN size(w) >= {k} THEN transform(sequence(0, size(w) - {k}), i -> {each}) WHEN size(w) > 0 THEN array({whole}) ELSE CAST(array() AS array<{kind}>) END)[0]")


def _row(k: int) -> str:
    return ", ".join(f"get(w, i + {j})" for j in range(k))


def _hashes(k: int) -> Column:
    return _shingles(f"xxhash64({_row(k)})", "xxhash64(concat_ws(' ', w))", "bigint", k)


def _strings(k: int) -> Column:
    return F.array_distinct(_shingles(f"concat_ws(' ', {_row(k)})", "concat_ws(' ', w)", "string", k))


def _key(documents: DataFrame) -> list[Column]:
    """A row's name: two independent 64-bit hashes of doc_id and text."""
    return [F.xxhash64(documents["doc_id"], documents["text"]).alias("key1"), F.xxhash64(F.lit("second"), documents["text"], documents["doc_id"]).alias("key2")]


def matches(documents: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows (key1, key2, item_id, n_shared, n_item) for the documents that contain at least `percent` % of an item's shingles."""
    items = saved(benchmark.select("item_id", _strings(k).alias("item"), F.array_distinct(_hashes(k)).alias("h"))).where("size(h) > 0")
    size = items.select("item_id", F.size("h").alias("q"), F.explode("h").alias("h"))
    # a partition's largest set has 2 ** ceil(log2 q) shingles
    sketch = F.floor((100 - percent) * F.pow(F.lit(2), F.ceil(F.log2("q"))) / 100) + 1
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.xxhash64("h", F.lit(1)), "h"))
    values = saved(size.withColumn("place", place).where(F.col("place") <= sketch).select("h", "item_id").distinct())
    small = values.count() <= BROADCAST_VALUES
    keyed = documents.select(*_key(documents), "text")
    probe = keyed.select("key1", "key2", F.explode(_hashes(k)).alias("h"))
    hits = probe.join(F.broadcast(values) if small else values, "h").select("key1", "key2", "item_id").distinct()
    pairs = saved(hits).join(items.select("item_id", "item"), "item_id")
    shared = keyed.join(pairs, ["key1", "key2"]).select("key1", "key2", "item_id", F.size(F.array_intersect("item", _strings(k))).cast("long").alias("n_shared"), F.size("item").cast("long").alias("n_item"))
    return shared.where(f"100 * n_shared >= {percent} * n_item").distinct()


def contaminated(documents: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of documents (doc_id, text): doc_id, n_items (benchmark items contained), max_shared (most
    shingles of one of them), contaminated, kept.

    An item of fewer than k words is one shingle, its whole sequence, which only texts of just those words have; items
    without words match nothing, nor do null and empty texts. Rows that share doc_id and text are judged alike; null
    ids are judged by their text; repeated items count once by item_id; other columns are ignored; empty tables give
    no matches.
    """
    found = saved(matches(documents, benchmark, k, percent)).groupBy("key1", "key2").agg(F.count_distinct("item_id").alias("n_items"), F.max("n_shared").alias("max_shared"))
    rows = documents.select("doc_id", *_key(documents)).join(found, ["key1", "key2"], "left")
    n = F.coalesce("n_items", F.lit(0).cast("long"))
    return rows.select("doc_id", n.alias("n_items"), F.coalesce("max_shared", F.lit(0).cast("long")).alias("max_shared"), (n > 0).alias("contaminated"), (n == 0).alias("kept"))


def decontaminated(documents: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of documents that contain no benchmark item, with all their columns; rows are told apart by doc_id and text."""
    found = saved(matches(documents, benchmark, k, percent)).select(F.col("key1").alias("hit1"), F.col("key2").alias("hit2")).distinct()
    key1, key2 = _key(documents)
    return merged_on(documents, found, (key1 == found["hit1"]) & (key2 == found["hit2"]), "left_anti")
