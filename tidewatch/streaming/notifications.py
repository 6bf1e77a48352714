"""Streaming analogues: acquisition filter, task deduplication and daily alerts over an event stream (T1s, T2s, T5s, F1, F15, K6).

The transformations take batch or streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.plans.tables import shared_folder


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a folder of Parquet files, read as they arrive."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 40)
    return stream.parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def wanted_scenes(events: DataFrame) -> DataFrame:
    """Acquisitions in mode IW, resolution H and a V polarization."""
    mode = F.when(F.col("event_id") % 3 == 0, "EW").otherwise("IW")
    resolution = F.when(F.col("event_id") % 5 == 0, "M").otherwise("H")
    polarization = F.when(F.col("event_id") % 2 == 0, "DV").otherwise("DH")
    return events.where((mode == "IW") & (resolution == "H") & (F.substring(polarization, 2, 1) == "V"))


def tasks(events: DataFrame, late: str = "1 day") -> DataFrame:
    """One row for each task id; on a stream, ids are kept until the watermark passes."""
    ids = events.withColumn("task_id", F.concat_ws("-", F.lit("asa"), F.col("user_id").cast("string"), F.substring(F.sha2("event_type", 256), 1, 10), F.date_format("ts", "yyyyMMdd")))
    if events.isStreaming:
        return ids.withWatermark("ts", late).dropDuplicatesWithinWatermark(["task_id"])
    return ids.dropDuplicates(["task_id"])


def alert_counts(events: DataFrame, least: int = 1) -> DataFrame:
    """Events of each type in the 24 hours before each day's 08:00, with an alert where there are more than `least`; day: on which they begin."""
    n = events.groupBy(F.window("ts", "24 hours", "24 hours", "8 hours"), "event_type").agg(F.count("*").alias("n"))
    return n.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", (F.col("n") > least).alias("alert"))


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """What a stream gives for all that is there now. Each batch is written under its number in a shared folder, beside the stream's
    checkpoint, so that a batch that runs again replaces itself; of a complete result the last batch counts."""
    folder = shared_folder(stream.sparkSession)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    rows = stream.sparkSession.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{folder}/rows")
    if mode == "complete":
        rows = rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0])
    return rows.drop("batch")


def stream_alert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(alert_counts(event_stream(spark, sf_dir)), "complete")


def stream_scene_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(wanted_scenes(event_stream(spark, sf_dir)).select("event_id", "user_id"), "append")


def stream_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drained(tasks(event_stream(spark, sf_dir)).select("task_id"), "append")


QUERIES = {f.__name__: f for f in (stream_alert_counts, stream_scene_filter, stream_tasks)}
ORACLES = {
    "stream_alert_counts": "SELECT strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d') AS day, event_type, count(*) AS n, count(*) > 1 AS alert FROM events GROUP BY 1, 2",
    "stream_scene_filter": "SELECT event_id, user_id FROM events WHERE event_id % 3 <> 0 AND event_id % 5 <> 0 AND event_id % 2 = 0",
    "stream_tasks": "SELECT DISTINCT concat('asa-', user_id, '-', substr(sha256(event_type), 1, 10), '-', strftime(ts, '%Y%m%d')) AS task_id FROM events",
}
