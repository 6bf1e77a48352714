"""Views and joins whose Spark plans are written apart from the catalogue's SQL, which stays their definition for the oracle.

They are here because the plain SQL would meet all pairs, one task or a whole table in a broadcast.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions import cells
from tidewatch.functions import geometry as geo
from tidewatch.operators.ranking import numbered
from tidewatch.plans import tables
from tidewatch.plans.catalogue import view

# Tags that take a vessel, and one that takes any source, out of the ranking of repeated sources.
VESSEL_TAGS, ANY_TAG = (5, 6, 7), 12
VESSEL, INFRA = 1, 2


def _matters(link: DataFrame) -> Column:
    """Whether a link, with its source and one of its tags, tells of a source that was there: the best-ranked structure, or a vessel
    that a reviewer or its score speaks for."""
    structure = (F.col("type") == INFRA) & (F.col("link_rank") == 1)
    spoken_for = F.coalesce(F.col("hitl"), F.lit(False)) | (F.col("score") > 0)
    vessel = (F.col("type") == VESSEL) & spoken_for & (F.col("tag").isNull() | ~F.col("tag").isin(*VESSEL_TAGS))
    return (structure | vessel) & (F.col("tag").isNull() | (F.col("tag") != ANY_TAG)) & ~F.col("hitl").eqNullSafe(False)


def repeat_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by how many runs saw their detections; each tag and each review of a detection counts its area once more, as defined."""
    at = lambda name: view(name, spark, sf_dir)
    links = at("link").where("active").join(at("source").withColumnsRenamed({"id": "source"}), "source").join(at("tag"), ["ext_id", "type"], "left")
    links = links.where(_matters(links)).select("source", "ext_id", "type", "slick")
    shown = at("slick").where("active").join(F.broadcast(at("not_oil")).withColumnRenamed("id", "cls"), "cls", "left_anti").select(F.col("id").alias("slick"), "run", "area")
    reviews = at("review").select("slick", F.col("cls").alias("reviewed"))
    rows = links.join(shown, "slick").join(reviews, "slick", "left").join(F.broadcast(at("not_oil")), F.col("reviewed") == F.col("id"), "left_anti")
    rows = rows.groupBy(F.col("source").alias("source_id"), "ext_id", "type").agg(F.count_distinct("run").alias("run_count"), (F.round(F.sum("area"), 2) / 1e6).alias("total_area"))
    return numbered(rows, [F.desc("run_count"), F.desc("total_area"), F.asc("source_id")], "global_rank")


def stale_deactivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All active detections of the scenes that run again become inactive."""
    again = view("run", spark, sf_dir).where("scene % 4 = 1").select(F.col("id").alias("run"), F.lit(True).alias("rerun"))
    rows = view("slick", spark, sf_dir).join(again, "run", "left")
    return rows.select("id", (F.col("active") & F.col("rerun").isNull()).alias("active"))


def aoi_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections in areas: an equi-join on the grid cells that an area covers, then the exact test."""
    return view("slick_to_aoi", spark, sf_dir).select("slick", "aoi", "type")


def seaice_fallback_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest mask not after each day: days and masks in one order, a running maximum in each year and the last of the years before."""
    pings = view("ping", spark, sf_dir).select(F.to_date("ts").alias("day"), (F.col("value") > 489).alias("mask"))
    days = pings.groupBy("day").agg(F.bool_or("mask").alias("mask")).withColumn("year", F.year("day")).withColumn("own", F.when(F.col("mask"), F.col("day")))
    running = F.max("own").over(Window.partitionBy("year").orderBy("day"))
    years = days.groupBy("year").agg(F.max("own").alias("last")).withColumn("earlier", F.max("last").over(Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)))
    rows = days.withColumn("here", running).join(F.broadcast(years), "year").select("day", F.coalesce("here", "earlier").alias("mask_day"))
    return rows.where("mask_day is not null").select(F.col("day").cast("string").alias("day"), F.col("mask_day").cast("string").alias("mask_day"))


def _cells(lon: Column, lat: Column, size: float, around: int) -> Column:
    steps = F.sequence(F.lit(-around), F.lit(around))
    gx, gy = F.floor(lon / size), F.floor(lat / size)
    return F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct(F.pmod(gx + i, F.lit(round(360 / size))).alias("gx"), (gy + j).alias("gy")))))


def dark_detections(detections: DataFrame, sites: DataFrame) -> DataFrame:
    """detections (id, lon, lat, length_m, match_score, presence) that are no structure and no known vessel: matched with less than 0.01,
    present by more than 0.99, longer than 30 m, and without a structure less than 100 m away. Of a structure's positions
    (structure, lon, lat, confidence) near any unmatched detection the most confident one counts."""
    size = 0.001
    unmatched = detections.where("match_score < 0.01").withColumn("cell", cells.cell(F.col("lon"), F.col("lat"), size))
    # a place counts once however many structures have been there, and is met by any detection near it
    spots = sites.select("lon", "lat").distinct()
    wide = spots.withColumn("cell", F.explode(_cells(F.col("lon"), F.col("lat"), size, 1)))
    seen = unmatched.select(F.col("cell").alias("d_cell"), F.col("lon").alias("dx"), F.col("lat").alias("dy"))
    met = (F.col("cell") == F.col("d_cell")) & (F.abs(F.col("lon") - F.col("dx")) < size) & (F.abs(F.col("lat") - F.col("dy")) < size)
    near = sites.join(wide.join(seen, met, "left_semi").select("lon", "lat").distinct(), ["lon", "lat"], "left_semi")
    one = near.groupBy("structure").agg(F.min_by(F.struct("lon", "lat"), F.struct(-F.col("confidence"), "lon", "lat")).alias("p")).select("structure", F.col("p.lon").alias("sx"), F.col("p.lat").alias("sy"))
    one = one.select("sx", "sy").distinct().withColumn("cell", F.explode(cells.surroundings(F.col("sx"), F.col("sy"), 100.0, size)))
    wanted = unmatched.where("length_m > 30 and presence > 0.99")
    close = (wanted["cell"] == one["cell"]) & (geo.haversine(wanted["lon"], wanted["lat"], one["sx"], one["sy"]) < 100)
    return wanted.join(one, close, "left_anti").drop("cell")


def haversine_band_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of vessels that aren't known."""
    c = tables.table(spark, sf_dir, "customer")
    d = c.select(F.col("c_custkey").alias("id"), (5 + (F.col("c_custkey") * 6007 % 10007) / 200140).alias("lon"), (50 + (F.col("c_custkey") * 7001 % 10009) / 200180).alias("lat"), F.col("c_acctbal").alias("length_m"), (F.col("c_custkey") % 13 / 1000).alias("match_score"), (1 - F.col("c_custkey") % 9 / 500).alias("presence"))
    s = tables.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") / 2).cast("long").alias("structure"), (5 + (F.col("s_suppkey") * 7919 % 1000) / 20000).alias("lon"), (50 + (F.col("s_suppkey") * 104729 % 1000) / 20000).alias("lat"), (F.col("s_suppkey") % 7).alias("confidence"))
    return dark_detections(d, s).select("id", "length_m")


def group_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, mode (the least of equals), mean and maximum of a group."""
    rows = tables.table(spark, sf_dir, "lineitem")
    return rows.groupBy(F.col("l_suppkey").alias("source")).agg(F.round(F.median("l_extendedprice"), 6).alias("med"), F.mode(F.col("l_linenumber"), True).alias("mode_rank"), F.round(F.avg("l_quantity"), 8).alias("mean_qty"), F.max("l_extendedprice").alias("top"))


FRAMES = {f.__name__: f for f in (repeat_source, stale_deactivation, aoi_membership, seaice_fallback_asof, haversine_band_anti, group_rollup)}
