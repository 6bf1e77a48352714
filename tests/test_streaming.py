"""Streaming queries against their SQL, and a stream whose files come in several batches."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewatch.streaming import notifications

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(notifications.QUERIES))
def test_stream_equals_sql(spark, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    want = c.execute(notifications.ORACLES[name])
    names = [d[0] for d in want.description]
    got = notifications.QUERIES[name](spark, DATA).select(*names).collect()
    assert got and sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str)


def test_batches_add_up(spark, tmp_path):
    """Three files, one a batch: appended rows are those of all, a complete result is the last one."""
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).coalesce(1).write.parquet(f"{tmp_path}/in/part={n}")
    stream = spark.readStream.schema("id long, part int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    assert sorted(r.id for r in notifications.drained(stream.select("id"), "append").collect()) == list(range(30))
    assert [r.n for r in notifications.drained(stream.groupBy().agg(F.count("*").alias("n")), "complete").collect()] == [30]
