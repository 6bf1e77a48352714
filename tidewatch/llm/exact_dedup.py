"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Rows are dealt into runs by a hash of their id. A run holds each digest once, with its smallest id and its count
(combined before anything moves, so a text that a third of all rows share is one entry of each run). In each round
`fan_in` runs are merged: entries of one digest from the merged runs meet in digest order and the smallest identifier
stays, verified by the texts' length beside the SHA-256. What the last round finds goes back down the same tree, so
that no join has more than one run's share of a text in a place.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import merged_on, saved

BLANKS = "[\\x20\\x09-\\x0D]+"


def _text(documents: DataFrame) -> Column:
    return F.regexp_replace(F.coalesce(documents["text"], F.lit("")), BLANKS, " ")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def exact_duplicates(documents: DataFrame, runs: int = 64, fan_in: int = 4) -> DataFrame:
    """One row for each row of documents (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of blanks became one space; null counts as empty. The smallest
    doc_id of a group stays; rows that share it all stay. A null doc_id is larger than any other: it stays only where
    a group has no other id, and keep_id is null then. Other columns are ignored; an empty table gives an empty result.
    """
    rows = documents.select("doc_id", _text(documents).alias("t"))
    leaves = saved(rows.select("doc_id", _digest(F.col("t")).alias("digest"), F.octet_length("t").alias("length"), F.pmod(F.xxhash64("doc_id"), F.lit(runs)).alias("run")))
    key = ["digest", "length"]
    levels = [leaves.groupBy("run", *key).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))]
    n = runs
    while n > 1:
        n = -(-n // fan_in)
        merged = Window.partitionBy("up", *key)
        entries = levels[-1].withColumn("up", F.floor(F.col("run") / fan_in))
        first = F.row_number().over(merged.orderBy(F.col("keep_id").asc_nulls_last(), "run"))
        entries = entries.withColumn("place", first).withColumn("total", F.sum("group_size").over(merged))
        levels.append(entries.where("place = 1").select(F.col("up").alias("run"), *key, "keep_id", F.col("total").alias("group_size")))
    found = levels.pop()
    while levels:
        below = levels.pop().select("run", *key)
        above = found.select(F.col("run").alias("up"), *key, "keep_id", "group_size")
        found = below.withColumn("up", F.floor(F.col("run") / fan_in)).join(above, ["up", *key]).drop("up")
    out = leaves.join(found, ["run", *key])
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows of documents that exact_duplicates keeps, with all their columns. Rows are told apart by doc_id and text, so
    a row that shares its id with a dropped one stays, and a copy without an id goes like any other."""
    gone = exact_duplicates(documents).where("not kept").select(F.col("doc_id").alias("gone_id"), F.unhex("text_sha256").alias("gone_digest")).distinct()
    same = documents["doc_id"].eqNullSafe(gone["gone_id"]) & (_digest(_text(documents)) == gone["gone_digest"])
    return merged_on(documents, gone, same, "left_anti")
