"""Catalogue queries as DataFrame plans over the domain views; the catalogue's SQL is their definition for the oracle."""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.functions import cells
from tidewatch.functions import geometry as geo
from tidewatch.operators.graph import lineage
from tidewatch.operators.tuning import grid_sums, summed_measures
from tidewatch.plans.catalogue import FUNCTION_COLUMNS, view

FRAMES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
View = Callable[[str], DataFrame]


def frame(plan: Callable[[View], DataFrame]) -> Callable[[View], DataFrame]:
    """Registers a plan over the domain views under its name."""
    FRAMES[plan.__name__] = lambda spark, sf_dir: plan(lambda name: view(name, spark, sf_dir))
    return plan


def first_of(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in an order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")


def best_first() -> list[Column]:
    return [F.desc("score"), F.asc("source"), F.asc("truth")]


@frame
def source_plus(at: View) -> DataFrame:
    slick, source, kind = at("slick").where("active").select(F.col("id").alias("slick"), F.col("confidence").alias("slick_confidence")), at("source").withColumnRenamed("id", "source"), at("source_type").select(F.col("id").alias("type"), F.col("name").alias("source_type"))
    rows = at("link").where("active").drop("active").join(slick, "slick").join(source, "source").join(F.broadcast(kind), "type")
    url = F.when(F.col("type") == 1, F.concat(F.lit("https://example.org/sources/"), "ext_id")).when(F.col("type") == 2, F.concat(F.lit("https://example.org/?ext_id_name="), "ext_id"))
    rows = rows.select("slick", "source", "ext_id", "source_type", "link_rank", F.round("score", 8).alias("score"), "slick_confidence", url.alias("url"))
    return rows.orderBy(F.desc_nulls_last("slick"), F.asc_nulls_last("link_rank"))


def _of_links(at: View, links: DataFrame) -> DataFrame:
    names = [c.strip() for c in FUNCTION_COLUMNS.split(",")]
    return at("slick_plus").join(links.select(F.col("slick").alias("id")), "id", "left_semi").select(*names)


def slicks_with_source(at: View, sources: list[int] | None, rank: int, least: float | None = None) -> DataFrame:
    """Detections that an active link up to a rank ties to any of the sources, or any at all for None."""
    links = at("link").where("active")
    if sources is not None:
        links = links.where(F.col("source").isin(sources) & (F.col("link_rank") <= rank))
    rows = _of_links(at, links)
    return rows if least is None else rows.where(F.col("max_score") >= least)


@frame
def slicks_by_source(at: View) -> DataFrame:
    return slicks_with_source(at, [1, 2, 3], 2)


@frame
def slicks_by_aoi(at: View) -> DataFrame:
    return _of_links(at, at("slick_to_aoi").where(F.col("aoi").isin(3, 7))).where("max_score >= 0.5")


@frame
def slicks_by_aoi_or_source(at: View) -> DataFrame:
    return slicks_with_source(at, [1, 5], 1, 0.0)


@frame
def latest_review(at: View) -> DataFrame:
    return first_of(at("review"), ["slick"], [F.desc("ts"), F.desc("id"), F.desc("reviewer")]).select("slick", "cls", "ts")


@frame
def not_oil_exclusion(at: View) -> DataFrame:
    return at("slick").where("active").join(F.broadcast(at("not_oil").select(F.col("id").alias("cls"))), "cls", "left_anti").select("id", "cls")


@frame
def slicks_of_scene(at: View) -> DataFrame:
    runs = at("run").where(F.col("scene").isin(3, 4)).join(at("scene").select(F.col("id").alias("scene")), "scene").select(F.col("id").alias("run"))
    rows = at("slick").where("active and confidence > 0.2").join(runs, "run", "left_semi")
    return rows.join(F.broadcast(at("not_oil").select(F.col("id").alias("cls"))), "cls", "left_anti").select("id", "confidence").distinct()


@frame
def deactivate_by_type(at: View) -> DataFrame:
    again = at("source").where(F.col("type").isin(1, 3)).select(F.col("id").alias("source"), F.lit(True).alias("again"))
    return at("link").join(again, "source", "left").select("slick", "source", "link_rank", (F.col("active") & F.col("again").isNull()).alias("active"))


@frame
def exc_sync(at: View) -> DataFrame:
    out = at("tag").where("tag = 6").select("ext_id", "type").distinct()
    gone = at("source").join(out, ["ext_id", "type"], "left_semi").select(F.col("id").alias("source"), F.lit(True).alias("gone"))
    return at("link").join(gone, "source", "left").select("slick", "source", "link_rank", "part", (F.col("active") & F.col("gone").isNull()).alias("active"))


@frame
def retained_scores(at: View) -> DataFrame:
    kinds = at("source_type").where("name != 'VESSEL'").select(F.col("id").alias("type"), F.col("name").alias("type_name"))
    rows = at("link").where("active").join(at("source").select(F.col("id").alias("source"), "type"), "source").join(F.broadcast(kinds), "type")
    return rows.groupBy("slick", "source", "type_name").agg(F.round(F.max("score"), 8).alias("score"))


@frame
def rerank_top8(at: View) -> DataFrame:
    score, cols = at("score"), ("slick", "source", "score", "fresh")
    kept = score.where("type != 1").withColumn("fresh", F.lit(False)).select(*cols)
    again = score.where("type = 1").select("slick", "source", (F.col("score") * 1.1).alias("score"), F.lit(True).alias("fresh"))
    more = score.where("type = 3").select((F.col("slick") % 500).alias("slick"), (F.col("source") + 1000).alias("source"), (F.col("score") - 1).alias("score"), F.lit(True).alias("fresh"))
    w = Window.partitionBy("slick").orderBy(F.desc_nulls_last("score"), "source", "fresh")
    rows = kept.union(again).union(more).withColumn("new_rank", F.row_number().over(w))
    return rows.where("new_rank <= 8 or not fresh").select("slick", "source", "fresh", "new_rank", (F.col("new_rank") <= 8).alias("active"))


@frame
def dedup_merge(at: View) -> DataFrame:
    """One link for each detection and merged source: a reviewed one first, then an active one, then by score and rank; flags are or-ed."""
    rows = at("link").withColumn("target", F.when(F.col("source") % 7 == 0, F.col("source") - 1).otherwise(F.col("source")))
    kind = F.when(F.col("hitl"), 0).when(F.col("hitl").isNull(), 1).otherwise(2)
    order = F.struct(kind.alias("k"), (~F.col("active")).alias("a"), F.col("score").isNull().alias("n"), (-F.col("score")).alias("s"), F.col("link_rank").alias("r"), F.col("source").alias("o"), F.col("ts").alias("t"), F.col("part").alias("p"))
    yes, no = F.bool_or(F.coalesce("hitl", F.lit(False))), F.bool_or(~F.coalesce("hitl", F.lit(True)))
    rows = rows.groupBy("slick", "target").agg(F.min_by("source", order).alias("donor"), F.bool_or("active").alias("any_active"), yes.alias("any_hitl"), no.alias("any_no"))
    return rows.select("slick", "target", "donor", "any_active", "any_hitl", F.when(F.col("any_hitl"), True).when(F.col("any_no"), False).alias("kept_hitl"))


@frame
def dup_rank_audit(at: View) -> DataFrame:
    return at("link").groupBy("slick", "link_rank").agg(F.count("*").alias("n")).where("n > 1")


@frame
def shape_metrics(at: View) -> DataFrame:
    compact = geo.polsby_popper(F.col("area"), F.col("perimeter"))
    return at("slick").select("id", F.round(compact, 8).alias("polsby_popper"), F.round(F.pow("length", F.lit(2)) / F.col("area") / compact, 8).alias("linearity"))


@frame
def radius_neighbours(at: View) -> DataFrame:
    """Detections and sites at most two kilometres apart, by cells that a site's surroundings cover."""
    near = cells.near_places(at("customer_places"), at("supplier_places"), 2000.0, 0.04)
    return near.select(F.col("a_id").alias("detection"), F.col("b_id").alias("site"), F.round("metres", 3).alias("metres"))


@frame
def vessel_extent(at: View) -> DataFrame:
    return at("ping").groupBy("ssvid").agg(*[f(c).alias(n) for n, f, c in (("minx", F.min, "lon"), ("maxx", F.max, "lon"), ("miny", F.min, "lat"), ("maxy", F.max, "lat"), ("top_speed", F.max, "speed"), ("first_ts", F.min, "ts"), ("last_ts", F.max, "ts"))], F.min_by("lon", "ts").alias("first_lon"), F.max_by("lon", "ts").alias("last_lon"))


@frame
def collated(at: View) -> DataFrame:
    return at("score").join(F.broadcast(at("type_moments")), "type").select("slick", "source", F.round((F.col("score") - F.col("mu")) / F.col("sd"), 8).alias("collated"))


def _share(at: View, share: float) -> DataFrame:
    """Of each detection's links by size those that come before the share is full."""
    w = Window.partitionBy("slick").orderBy(F.desc("qty"), "part", "link_rank", "price").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("qty").over(w), F.lit(0.0))
    rows = at("link").withColumns({"before": before, "total": F.sum("qty").over(Window.partitionBy("slick"))})
    return rows.where(F.col("before") < share * F.col("total")).select("slick", "part", "link_rank")


@frame
def cumulative_share_80(at: View) -> DataFrame:
    return _share(at, 0.8)


@frame
def cumulative_share_95(at: View) -> DataFrame:
    return _share(at, 0.95)


@frame
def weighted_average(at: View) -> DataFrame:
    mean = F.coalesce(F.try_divide(F.sum(F.col("qty") * F.col("score")), F.sum("qty")), F.avg("score"))
    return at("link").groupBy("source").agg(F.round(mean, 8).alias("weighted"), F.round(F.max("score"), 8).alias("best"))


@frame
def eval_metrics(at: View) -> DataFrame:
    w = Window.partitionBy("slick")
    false_best = F.max(F.when(~F.col("truth"), F.col("score")).otherwise(0.0)).over(w)
    rows = at("truth").withColumns({"r": F.row_number().over(w.orderBy(*best_first())), "false_best": false_best}).where("truth")
    part = lambda c: F.round(F.avg(c.cast("double")), 8)
    return rows.groupBy("type").agg(part(F.col("r") == 1).alias("top1"), part(F.col("r") <= 3).alias("top3"), part(F.col("score")).alias("true_score"), part(F.col("false_best")).alias("false_score"), F.count("*").alias("n"))


@frame
def score_moments(at: View) -> DataFrame:
    return at("truth").where("truth").groupBy("type").agg(*[F.round(f("score"), 8).alias(n) for n, f in (("mean", F.mean), ("sd_pop", F.stddev_pop), ("sd_samp", F.stddev_samp))])


@frame
def true_rank(at: View) -> DataFrame:
    w = Window.partitionBy("slick")
    rows = at("truth").withColumns({"r": F.row_number().over(w.orderBy(*best_first())), "n": F.count_if("truth").over(w)})
    return rows.where("truth and n = 1").select("slick", "r")


@frame
def rank_regressions(at: View) -> DataFrame:
    w = Window.partitionBy("slick")
    new = w.orderBy((F.col("score") - F.col("type")).desc(), "source", "truth")
    rows = at("truth").withColumns({"old_rank": F.row_number().over(w.orderBy(*best_first())), "new_rank": F.row_number().over(new)})
    return rows.where("truth and new_rank > old_rank").select("slick", "source", "old_rank", "new_rank")


@frame
def metrics_long(at: View) -> DataFrame:
    wide = at("truth").groupBy("slick").agg(F.max("score").alias("best"), F.avg("score").alias("mean"))
    return wide.unpivot("slick", ["best", "mean"], "metric", "v").select("slick", "metric", F.round("v", 8).alias("v"))


@frame
def highest_false(at: View) -> DataFrame:
    return at("truth").groupBy("slick").agg(F.round(F.coalesce(F.max(F.when(~F.col("truth"), F.col("score"))), F.lit(0.0)), 8).alias("false_score"))


@frame
def hard_negatives(at: View) -> DataFrame:
    rows = at("truth").select("slick", "source", "truth", "score")
    true = rows.where("truth")
    return true.drop("score").union(rows.where("not truth and score > 0.5").join(true.select("slick", "source").distinct(), ["slick", "source"], "left_anti").select("slick", "source", "truth"))


@frame
def missing_truth(at: View) -> DataFrame:
    met = at("score").where("score > 0").select("slick", "source").distinct()
    return at("truth").where("truth").select("slick", "source").distinct().join(met, ["slick", "source"], "left_anti").withColumn("score", F.lit(0.0))


@frame
def utm_zone(at: View) -> DataFrame:
    zone = (F.floor((F.col("lon") + 180) / 6) + 1).cast("int")
    return at("place").select("id", zone.alias("zone"), (F.when(F.col("lat") >= 0, 32600).otherwise(32700) + zone).alias("epsg"))


@frame
def web_mercator(at: View) -> DataFrame:
    y = F.log(F.tan(math.pi / 4 + F.radians("lat") / 2))
    return at("place").select("id", F.round(F.radians("lon") * 6378137.0, 4).alias("x"), (F.round(y * 6378137.0, 4) + 0.0).alias("y"))


@frame
def mask_class(at: View) -> DataFrame:
    return at("place").select("id", F.when(F.col("lon") < -60, "LAND").when(F.col("lat") > 30, "SEA_ICE").alias("mask"))


@frame
def map_class(at: View) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in ((1, "INFRA"), (2, "NATURAL"), (3, "VESSEL")) for x in pair])
    rows = at("slick").select("id", F.try_element_at(names, (F.col("id") % 4).cast("int")).alias("short_name"))
    rows = rows.join(F.broadcast(at("cls").select("short_name", F.col("id").alias("own"))), "short_name", "left")
    return rows.select("id", F.coalesce(F.when(F.col("id") % 10 == 0, F.lit(9)), "own").alias("cls"))


def precursors(slicks: DataFrame) -> DataFrame:
    """(id, pre): what each detection was made from."""
    rows = slicks.select("id", F.explode(F.filter(F.array(F.floor(F.col("id") / 2), F.when(F.col("id") % 5 == 0, F.floor(F.col("id") / 3))), lambda x: x > 0)).alias("pre"))
    return rows.select("id", F.col("pre").cast("long").alias("pre"))


@frame
def slick_history(at: View) -> DataFrame:
    """How often the lineages of all detections reach each one."""
    slicks = at("slick").select("id")
    return lineage(slicks, precursors(slicks), by_start=False).select("id", F.col("paths").alias("reached"))


@frame
def collation_grid(at: View) -> DataFrame:
    """Candidates are moved once, by detection, and ranked at all points of the grid where they are."""
    sums = grid_sums(at("truth"), [(m, s) for m in (0.2, 0.5, 0.8) for s in (0.1, 0.3)], 1)
    return summed_measures(sums, ["mu", "sd"]).select("mu", "sd", F.round("mean_rank", 8).alias("mean_rank"), F.round("top3", 8).alias("top3"))


@frame
def optimizer_grid(at: View) -> DataFrame:
    rows = at("truth").repartition("slick").withColumn("mu", F.explode(F.array(*map(F.lit, (-0.5, 0.0, 0.5, 1.0)))))
    score = F.when(F.col("type") == 2, F.col("score") - F.col("mu")).otherwise(F.col("score"))
    of = Window.partitionBy("mu", "slick")
    rows = rows.withColumns({"r": F.row_number().over(of.orderBy(score.desc_nulls_last(), "source", "truth")), "has": F.bool_or("truth").over(of)}).where("r = 1 and has")
    return rows.groupBy("mu").agg(F.round(F.avg(F.col("truth").cast("double")), 8).alias("share"))


@frame
def cls_subtree(at: View) -> DataFrame:
    """Down the tree from every class of the upper two levels at once."""
    n = at("region").select(F.col("r_regionkey").cast("long").alias("id"), F.lit(None).cast("long").alias("supercls"))
    n = n.union(at("nation").select((1000 + F.col("n_nationkey")).cast("long"), F.col("n_regionkey").cast("long")))
    n = n.union(at("customer").select(1000000 + F.col("c_custkey"), (1000 + F.col("c_nationkey")).cast("long")))
    below = lineage(n.where("id < 1000000").select("id"), n.select(F.col("supercls").alias("id"), F.col("id").alias("pre")))
    return below.join(n, "id").select(F.col("start").alias("root"), "id", "supercls")


@frame
def version_filter(at: View) -> DataFrame:
    """Versions are compared as arrays of their numbers."""
    p = at("part").select(F.col("p_partkey").alias("id"), F.concat_ws(".", F.col("p_partkey") % 3, F.col("p_partkey") % 13, F.col("p_size") % 11).alias("v"))
    return p.where(F.split("v", "[.]").cast("array<int>") > F.array(F.lit(1), F.lit(9), F.lit(9)))


@frame
def i18n_seed(at: View) -> DataFrame:
    d = at("documents").select(F.col("source").alias("entity"), F.col("lang").alias("locale"), F.when(F.col("n_chars") > 3000, F.col("doc_id").cast("string")).alias("name"), F.when(F.col("n_chars") < 100, F.col("n_chars").cast("string")).alias("description"))
    return d.groupBy("entity", "locale").agg(F.max("name").alias("name"), F.max("description").alias("description")).where("name is not null or description is not null")


@frame
def locale_chain(at: View) -> DataFrame:
    """A code's depth is how many it falls back on."""
    codes = at("part").select(F.col("p_partkey").alias("id"))
    chain = lineage(codes, codes.select("id", F.floor(F.col("id") / 3).alias("pre")).where("pre > 0"))
    return chain.groupBy(F.col("start").alias("code")).agg((F.count("*") - 1).cast("int").alias("depth"))
