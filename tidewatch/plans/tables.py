"""Base tables, and the pings and outlines that are derived from them for the queries over positions and polygons."""

import math
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a large table that a task sorts or groups, about.
ROWS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share, in that of spark.checkpoint.dir. Where that isn't set, a temporary folder serves a local
    master, and a cluster is an error."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is to name a folder that all executors share")
        at = f"file://{tempfile.gettempdir()}/tidewatch-shared"
    return f"{at.rstrip('/')}/tidewatch/{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df written to a shared folder and read again: cuts the lineage of loops and survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """rows in as many partitions as shuffles have, whatever their bytes: for work that costs far more than moving the rows."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a shuffle of so many rows: those of the session, more where a task would get over ROWS."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS))


@contextmanager
def shuffled_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs within it shuffles to partitions for so many rows, so that what a task holds doesn't grow with the table. Small ones are put together as
    the session has it; the session's number comes back at the end."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts_for(spark, rows)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ssvid, id, t, x, y, speed, course): one position for each event, t in microseconds, x and y in metres, speed in knots; some have no course."""
    e = table(spark, sf_dir, "events")
    lon = 10 + (F.col("user_id") % 20) / 10 + (F.col("event_id") % 977) / 10000
    lat = 40 + (F.col("user_id") % 15) / 10 + (F.col("event_id") % 787) / 10000
    course = F.when(F.col("event_id") % 7 != 0, (F.col("event_id") * 36 % 360).cast("double"))
    return e.select(F.col("user_id").alias("ssvid"), F.col("event_id").alias("id"), micros("ts").alias("t"), (lon * 82700).alias("x"), (lat * 110540).alias("y"), (F.col("value") % 30).alias("speed"), course.alias("course"))


#: The same for DuckDB.
PINGS = """SELECT user_id AS ssvid, event_id AS id, epoch_us(ts) AS t, (10 + (user_id % 20) / 10 + (event_id % 977) / 10000) * 82700 AS x,
    (40 + (user_id % 15) / 10 + (event_id % 787) / 10000) * 110540 AS y, value % 30 AS speed, CASE WHEN event_id % 7 <> 0 THEN (event_id * 36 % 360)::DOUBLE END AS course FROM events"""


def outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, cls, confidence, ring): a star-shaped outline of five to eight corners for each order, as an open ring of
    (x, y) in degrees; orders of one block of 500 lie within half a degree. Orders are dealt over all cores while they are two numbers, as what
    is done with outlines costs far more than reading them."""
    o = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey").select(F.col("o_orderkey").alias("id"), (1 + F.col("o_orderkey") % 12).cast("int").alias("cls"), "o_totalprice")
    block = F.floor(F.col("id") / 500)
    lon = -150 + block % 300 + (F.col("id") * 6007 % 10007) / 20014
    lat = -50 + F.floor(block / 300) % 100 + (F.col("id") * 7001 % 10009) / 20018
    o = o.select("id", "cls", (F.col("o_totalprice") / 600000).alias("confidence"), lon.alias("lon"), lat.alias("lat"), (200 + F.sqrt("o_totalprice") * 3).alias("size"), (5 + F.col("id") % 4).alias("n"))

    return o.mapInArrow(_rings, "id long, cls int, confidence double, ring array<struct<x: double, y: double>>")


def _rings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, cls, confidence, lon, lat, size, n) with their rings, all corners of a batch at a time."""
    for b in batches:
        ids, lon, lat, size, n = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "lon", "lat", "size", "n"))
        off = np.concatenate([[0], np.cumsum(n)])
        k = np.arange(off[-1]) - np.repeat(off[:-1], n)
        ids, lon, lat, size, n = (np.repeat(v, n) for v in (ids, lon, lat, size, n))
        angle = 2 * math.pi * (k + 0.3 * (ids % 3)) / n
        r = size * (0.55 + 0.45 * (ids * (k + 3) % 7) / 6 + 0.007 * k)
        x, y = lon + r * np.cos(angle) / (111320 * np.cos(np.radians(lat))), lat + r * np.sin(angle) / 110540
        ring = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.StructArray.from_arrays([pa.array(x), pa.array(y)], ["x", "y"]))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "cls", "confidence")), ring], names=["id", "cls", "confidence", "ring"])


#: The same for DuckDB, a row for each corner k of n.
CORNERS = """SELECT id, cls, confidence, n, k, lon + r * cos(angle) / (111320 * cos(radians(lat))) AS x, lat + r * sin(angle) / 110540 AS y FROM (
    SELECT *, 2 * pi() * (k + 0.3 * (id % 3)) / n AS angle, (200 + sqrt(price) * 3) * (0.55 + 0.45 * (id * (k + 3) % 7) / 6 + 0.007 * k) AS r FROM (
        SELECT *, unnest(range(0, n)) AS k FROM (
            SELECT o_orderkey AS id, (1 + o_orderkey % 12)::INT AS cls, o_totalprice / 600000 AS confidence, o_totalprice AS price, 5 + o_orderkey % 4 AS n,
                -150 + (o_orderkey // 500) % 300 + (o_orderkey * 6007 % 10007) / 20014 AS lon, -50 + (o_orderkey // 500 // 300) % 100 + (o_orderkey * 7001 % 10009) / 20018 AS lat FROM orders) AS a) AS b) AS c"""
