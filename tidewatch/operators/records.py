"""Scenes, triggers and logs: which notified scenes matter, what a batch takes on, logs rolled up by scene, payloads as JSON, pixels as places."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions import geometry as geo
from tidewatch.functions.scalars import scene_fields, scene_start
from tidewatch.plans import tables

#: A mask of open water for the registered queries, as a ring.
OCEAN = ((10.0, 40.0), (12.5, 40.2), (11.9, 41.6), (10.4, 41.3))


def relevant(scenes: DataFrame, ocean: Column) -> DataFrame:
    """scenes (scene_id, lon, lat ...) with matters: in mode IW, of high resolution, with a vertical polarization, and their middle in the ocean ring."""
    f = scene_fields(F.col("scene_id"))
    kind = (f["mode"] == "IW") & (f["resolution"] == "H") & (F.substring(f["polarization"], 2, 1) == "V")
    return scenes.withColumn("matters", F.coalesce(kind & geo.contains(geo.edges(ocean), F.col("lon"), F.col("lat")), F.lit(False)))


def triggers(scenes: DataFrame) -> DataFrame:
    """An audit row for each day's notifications: how many scenes, and how many of them matter."""
    return scenes.groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("scene_count"), F.count_if("matters").alias("filtered_scene_count"))


def claimed(rows: DataFrame, pending: Column, order: list[Column], n: int) -> DataFrame:
    """The n first rows in the order that are pending: what one worker takes on. Rows that were taken on are pending no more in the next table."""
    return rows.where(pending).orderBy(*order).limit(n)


def rolled_up(log: DataFrame) -> DataFrame:
    """log (scene, ts, id, kind, value) by scene: the first kind that isn't null, how many of each, their distinct kinds, and the values in order of time, ten at most of those above 400."""
    w = Window.partitionBy("scene").orderBy("ts", "id")
    high = log.where("value > 400").withColumn("n", F.row_number().over(w)).where("n <= 10").groupBy("scene").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "value"))), lambda x: F.format_string("%.2f", x["value"])), " ").alias("high"))
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("click", "view", "purchase", "signup", "error")]
    rows = log.groupBy("scene").agg(F.min_by("kind", F.when(F.col("kind").isNotNull(), F.struct("ts", "id"))).alias("first_kind"), *counts, F.count_distinct("kind").alias("kinds"))
    return rows.join(high, "scene", "left")


def pixel_place(col: Column, row: Column, width: Column, height: Column, box: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a pixel's middle; rows go down from the upper edge."""
    return box["minx"] + (col + 0.5) / width * (box["maxx"] - box["minx"]), box["maxy"] - (row + 0.5) / height * (box["maxy"] - box["miny"])


def _scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tables.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (F.col("event_id") % n + 1).cast("int"))
    name = F.concat_ws("_", F.lit("S1A"), pick(3, "IW", "EW", "IW"), F.concat(F.lit("GRD"), pick(2, "H", "M")), F.concat(F.lit("1S"), pick(4, "DV", "DH", "SV", "SH")), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.col("event_id"))
    return e.select("event_id", "ts", name.alias("scene_id"), (9.5 + (F.col("event_id") * 37 % 401) / 100).alias("lon"), (39.5 + (F.col("event_id") * 53 % 307) / 100).alias("lat"))


def _ocean() -> Column:
    """The ring in decimals, as in the SQL: differences of its corners are exact, and so is the side on which a place next to the border lies."""
    at = lambda v: F.lit(Decimal(str(v))).cast("decimal(8, 4)")
    return F.array(*[F.struct(at(x).alias("x"), at(y).alias("y")) for x, y in OCEAN])


def scene_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 T1s K7: audit rows of notifications by day."""
    return triggers(relevant(_scenes(spark, sf_dir), _ocean()))


def relevant_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenes that matter, with their start."""
    rows = relevant(_scenes(spark, sf_dir), _ocean()).where("matters")
    return rows.select("event_id", F.unix_timestamp(scene_start(F.col("scene_id"))).alias("start_s"))


def claimed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of detections that a worker takes on."""
    o = tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus", "o_totalprice")
    return claimed(o, F.col("o_orderstatus") == "P", [F.asc("id")], 100).select("id", "o_totalprice")


def log_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs by scene."""
    e = tables.table(spark, sf_dir, "events").select(F.col("user_id").alias("scene"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("id"), F.when(F.col("event_id") % 5 > 0, F.col("event_type")).alias("kind"), "value")
    return rolled_up(e)


def payload_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as JSON, with a field out of the payload."""
    e = tables.table(spark, sf_dir, "events")
    body = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.from_json("props", "k bigint")["k"].alias("k"), F.array(F.col("user_id"), F.col("user_id") + 1).alias("users")))
    return e.select("event_id", body.alias("body"))


def pixel_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the pixels of offset tiles, 8 by 8 each."""
    n = tables.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("tile"), (F.col("n_nationkey") % 5 * 0.7 - 0.35 * 0.5).alias("x"), (F.col("n_regionkey") * 0.7).cast("double").alias("y"))
    box = F.struct(F.col("x").alias("minx"), F.col("y").alias("miny"), (F.col("x") + 0.7).alias("maxx"), (F.col("y") + 0.7).alias("maxy"))
    rows = n.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(63))))
    lon, lat = pixel_place(F.col("at") % 8, F.floor(F.col("at") / 8), F.lit(8), F.lit(8), box)
    return rows.select("tile", "at", F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"))


QUERIES = {f.__name__: f for f in (scene_triggers, relevant_scenes, claimed_batch, log_rollup, payload_json, pixel_places)}

_CROSS = " + ".join(f"CASE WHEN ({ay} > lat) <> ({by} > lat) AND lon < ({bx} - {ax}) * (lat - {ay}) / ({by} - {ay}) + {ax} THEN 1 ELSE 0 END" for (ax, ay), (bx, by) in zip(OCEAN, (*OCEAN[1:], OCEAN[0]), strict=True))
_MATTERS = f"WITH s AS (SELECT event_id, ts, 9.5 + (event_id * 37 % 401) / 100 AS lon, 39.5 + (event_id * 53 % 307) / 100 AS lat FROM events), m AS (SELECT *, event_id % 3 <> 1 AND event_id % 2 = 0 AND event_id % 4 IN (0, 2) AND ({_CROSS}) % 2 = 1 AS matters FROM s)"
ORACLES = {
    "scene_triggers": _MATTERS + " SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS scene_count, count(*) FILTER (matters) AS filtered_scene_count FROM m GROUP BY 1",
    "relevant_scenes": _MATTERS + " SELECT event_id, floor(epoch(ts))::BIGINT AS start_s FROM m WHERE matters",
    "claimed_batch": "SELECT o_orderkey AS id, o_totalprice FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 100",
    "log_rollup": """WITH e AS (SELECT user_id AS scene, ts, event_id AS id, CASE WHEN event_id % 5 > 0 THEN event_type END AS kind, value FROM events)
SELECT scene, arg_min(kind, (ts, id)) FILTER (kind IS NOT NULL) AS first_kind, count(*) FILTER (kind = 'click') AS n_click, count(*) FILTER (kind = 'view') AS n_view, count(*) FILTER (kind = 'purchase') AS n_purchase, count(*) FILTER (kind = 'signup') AS n_signup, count(*) FILTER (kind = 'error') AS n_error, count(DISTINCT kind) AS kinds,
    (SELECT string_agg(printf('%.2f', value), ' ' ORDER BY ts, id) FROM (SELECT * FROM e f WHERE f.scene = e.scene AND value > 400 ORDER BY ts, id LIMIT 10)) AS high FROM e GROUP BY scene""",
    "payload_json": """SELECT event_id, '{"id":' || event_id || ',"kind":"' || event_type || '","k":' || json_extract_string(props, '$.k') || ',"users":[' || user_id || ',' || (user_id + 1) || ']}' AS body FROM events""",
    "pixel_places": "SELECT n_nationkey AS tile, i::INT AS at, round(n_nationkey % 5 * 0.7::DOUBLE - 0.175 + (i % 8 + 0.5) / 8 * 0.7, 8) AS lon, round(n_regionkey * 0.7::DOUBLE + 0.7 - (i // 8 + 0.5) / 8 * 0.7, 8) AS lat FROM nation, range(0, 64) t(i)",
}
