"""What the training-data operators share: shared-folder tables, batches of text as byte arrays, components."""

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir. Where that is unset, a temporary one serves a local master, as in tests, and a cluster is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is to name a folder that all executors share")
        found = f"file://{tempfile.gettempdir()}/tidewatch-shared"
    return found.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors.

    The folder has the life of the cluster's checkpoint folder, which the cluster empties.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidewatch/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the input: sorted and merged at every size, never broadcast."""
    return left.join(right.hint("merge"), on, how)


def merged_on(left: DataFrame, right: DataFrame, condition: Column, how: str) -> DataFrame:
    """merged() by a condition, for sides whose keys have other names or may be null."""
    return left.join(right.hint("merge"), condition, how)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers hold, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and UTF-8 bytes of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0] : off[-1]]


def pieces(off: np.ndarray, most: int = 1 << 20):
    """Ranges (first, past) of rows with about `most` bytes together; a longer row is a range of its own."""
    first, n = 0, len(off) - 1
    while first < n:
        past = max(first + 1, int(np.searchsorted(off, off[first] + most, "right")) - 1)
        yield first, past
        first = past


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component), component the smallest id.

    Large-star and small-star steps in turn; each is an aggregate and a join on one row for each node, so
    that no neighbourhood is ever collected. The rounds grow with the square of the logarithm of a component's size at
    most; an unfinished labelling is an error. Empty edges give an empty table; loops and repeats are harmless.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct())
    mark = None
    for _ in range(rounds):
        both = now.select(F.col("v").alias("u"), F.col("m").alias("w")).union(now.select("m", "v"))
        low = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("low"))
        large = merged(both.where("w >= u"), low, "u").select(F.col("w").alias("v"), F.col("low").alias("m")).union(low.select("u", "low")).where("v != m")
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = merged(large, low, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).union(low.select("v", "low")).where("v != m").distinct()
        now = saved(small)
        is_star = now.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if tuple(is_star) == mark:
            break
        mark = tuple(is_star)
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return now.groupBy(F.col("v").alias("id")).agg(F.min("m").alias("component")).union(now.select(F.col("m").alias("id"), "m").distinct()).distinct()
