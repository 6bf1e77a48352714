"""Model output over tiles: softmax and masking, instances by three thresholds, statistics by zone, channels, mosaics, suppression by Dice.

A tile is one row of `embeddings`: 8 by 8 values. Instances are connected components of pixels in one distributed
graph, so that a scene of any number of tiles needs no array of its whole size anywhere.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.graph import components
from tidewatch.operators.instances import labelled
from tidewatch.plans import tables

WIDTH = 8
CLASSES = 4


def pixels(tiles: DataFrame) -> DataFrame:
    """(tile, x, y, value) of tiles (tile, values), in double precision."""
    rows = tiles.select("tile", F.posexplode("values").alias("at", "v"))
    return rows.select("tile", (F.col("at") % WIDTH).alias("x"), F.floor(F.col("at") / WIDTH).cast("int").alias("y"), F.col("v").cast("double").alias("value"))


def softmax(classes: Column) -> Column:
    """Shares of an array of class values; the largest is taken off first, so that no exponential overflows."""
    top = F.array_max(classes)
    e = F.transform(classes, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, x: a + x))


def masked(shares: Column, empty: Column) -> Column:
    """Shares whose classes but the background, the first, are 0 where the input had no data."""
    return F.transform(shares, lambda v, i: F.when(empty & (i > 0), 0.0).otherwise(v))


def instances(pixel: DataFrame, group: float, trim: float, keep: float) -> DataFrame:
    """pixel (tile, x, y, value) with instance: pixels of at least `group` that touch by a side are one, named by its first pixel. It
    counts if its largest value is at least `keep`, and then has its pixels of at least `trim`."""
    rows = pixel.where(F.col("value") >= group).withColumn("id", (F.col("tile") * WIDTH + F.col("y")) * WIDTH + F.col("x"))
    here = rows.select(F.col("id").alias("a"), "tile", "x", "y")
    next_ = here.select("a", "tile", F.explode(F.array(F.struct((F.col("x") + 1).alias("x"), F.col("y").alias("y")), F.struct(F.col("x").alias("x"), (F.col("y") + 1).alias("y")))).alias("p")).select("a", "tile", "p.x", "p.y")
    links = next_.join(here.withColumnRenamed("a", "b"), ["tile", "x", "y"]).select("a", "b")
    named = rows.join(components(rows.select("id"), links), "id").withColumnRenamed("component", "instance")
    best = named.groupBy("instance").agg(F.max("value").alias("best")).where(F.col("best") >= keep).select("instance")
    return named.join(best, "instance").where(F.col("value") >= trim).drop("id")


def zonal(pixel: DataFrame, by: str) -> DataFrame:
    """Of pixel (value, cls and the column `by`): count, mean, median, largest, sum, and the class with the largest sum, the least of equals."""
    sums = pixel.groupBy(by, "cls").agg(F.sum("value").alias("s"))
    best = sums.groupBy(by).agg(F.max(F.struct(F.round("s", 9).alias("s"), -F.col("cls"))).alias("m")).select(by, (-F.col("m.col2")).alias("best_class"))
    rows = pixel.groupBy(by).agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.median("value").alias("median"), F.max("value").alias("top"), F.sum("value").alias("total"))
    return rows.join(best, by)


def dice(u: Column, v: Column) -> Column:
    """Likeness of two masks of probabilities: twice the sum of the roots of products by the sum of both."""
    both = F.aggregate(F.zip_with(u, v, lambda a, b: F.sqrt(a * b)), F.lit(0.0), lambda s, x: s + x)
    add = lambda m: F.aggregate(m, F.lit(0.0), lambda s, x: s + x)
    return F.coalesce(F.try_divide(2 * both, add(u) + add(v)), F.lit(0.0))


def mask_suppressed(masks: DataFrame, box_score: float, pixel_score: float, most: float) -> DataFrame:
    """Of masks (id, scene, cls, score, mask) those that stay: score over box_score, a pixel over pixel_score, and no better mask of its
    scene and class (the smaller id of equals) that stays and is more than `most` alike. A scene is one image's detections."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "id"], ascending=[False, True])
        m = np.array(pdf["mask"].to_list())
        stays: list[int] = []
        for i in range(len(m)):
            if all(2 * np.sqrt(m[i] * m[j]).sum() <= most * (m[i] + m[j]).sum() for j in stays):
                stays.append(i)
        return pdf.iloc[stays][["id"]]

    rows = masks.where((F.col("score") > box_score) & (F.array_max("mask") > pixel_score))
    return rows.groupBy("scene", "cls").applyInPandas(run, "id long")


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"), F.col("embedding").alias("values"), "label")


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four class values a pixel, sixteen pixels a tile; a pixel has no data where the tile's id and place say so."""
    e = tables.table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double") * 6).alias("v"))
    e = e.select("vec_id", "v", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("pixel"))
    classes = F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda c: F.col("v")[c * 16 + F.col("pixel")])
    return e.select("vec_id", "pixel", masked(softmax(classes), (F.col("vec_id") + F.col("pixel")) % 5 == 0).alias("shares"))


def class_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Softmax over classes, foreground off where there is no data; R2's sum of the oil classes."""
    rows = _shares(spark, sf_dir)
    return rows.select("vec_id", "pixel", *[F.round(F.col("shares")[c], 8).alias(f"c{c}") for c in range(CLASSES)], F.round(F.col("shares")[1] + F.col("shares")[2] + F.col("shares")[3], 8).alias("oil"))


def tile_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 G1: instances within tiles by three thresholds, with their pixels, largest value and mean; a tile is labelled in one pass."""
    tiles = _tiles(spark, sf_dir).select("tile", F.transform("values", lambda v: v.cast("double")).alias("values"))
    rows = labelled(tiles, 0.0)
    best = F.transform(F.filter("found", lambda f: f["best"] >= 0.2), lambda f: f["label"])
    rows = rows.withColumn("kept", best).select("tile", "kept", F.posexplode(F.arrays_zip("values", "labels")).alias("at", "p"))
    rows = rows.select("tile", F.col("p.labels").alias("instance"), F.col("p.values").alias("value"), (F.col("at") % WIDTH).alias("x"), F.floor(F.col("at") / WIDTH).cast("int").alias("y"), "kept")
    rows = rows.where("array_contains(kept, instance) and value >= 0.05")
    return rows.groupBy("tile", "instance").agg(F.count("*").alias("n"), F.round(F.max("value"), 7).alias("best"), F.round(F.avg("value"), 7).alias("mean"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


def zonal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of each label's pixels, and its best class."""
    rows = pixels(_tiles(spark, sf_dir)).join(_tiles(spark, sf_dir).select("tile", "label"), "tile").withColumn("cls", (F.col("x") + F.col("y")) % CLASSES)
    return zonal(rows, "label").select("label", "n", *[F.round(c, 7).alias(c) for c in ("mean", "median", "top")], F.round("total", 4).alias("total"), F.col("best_class").cast("int").alias("best_class"))


def channel_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile's first half, scaled to bytes by its largest value, as the first channel beside the second half."""
    e = tables.table(spark, sf_dir, "embeddings")
    first, second = (F.transform(F.slice("embedding", i, 32), lambda v: F.abs(v.cast("double"))) for i in (1, 33))
    top = F.array_max(first)
    scaled = F.transform(first, lambda v: F.least(F.lit(255.0), F.floor(v / (top / 255))))
    pairs = F.zip_with(scaled, second, lambda a, b: F.struct(a.alias("vv"), b.alias("aux")))
    rows = e.select("vec_id", F.posexplode(pairs).alias("pixel", "p"))
    return rows.select("vec_id", "pixel", F.col("p.vv").cast("long").alias("vv"), F.round(F.col("p.vv") / 255, 8).alias("unit"), F.round("p.aux", 7).alias("aux"))


def _masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tables.table(spark, sf_dir, "embeddings")
    mask = F.transform("embedding", lambda v: 1 / (1 + F.exp(-8 * v.cast("double"))))
    return e.select(F.col("vec_id").alias("id"), F.floor(F.col("vec_id") / 25).alias("scene"), (F.col("label") % 3).alias("cls"), (F.col("vec_id") * 37 % 101 / 100).alias("score"), mask.alias("mask"))


def mask_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dice of pairs of masks of one scene and class."""
    a, b = (_masks(spark, sf_dir).select("scene", "cls", F.col("id").alias(n), F.col("mask").alias(f"m{n}")) for n in "ab")
    return a.join(b, ["scene", "cls"]).where("a < b").select("a", "b", F.round(dice(F.col("ma"), F.col("mb")), 7).alias("dice"))


def suppressed_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks that stay."""
    return mask_suppressed(_masks(spark, sf_dir), 0.1, 0.7, 0.945)


QUERIES = {f.__name__: f for f in (class_shares, tile_instances, zonal_stats, channel_stack, mask_likeness, suppressed_masks)}

_PIXELS = "p AS (SELECT vec_id AS tile, label, (i - 1) % 8 AS x, (i - 1) // 8 AS y, embedding[i]::DOUBLE AS v FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings))"
ORACLES = {
    "class_shares": """WITH e AS (SELECT vec_id, i AS pixel, [exp(6 * embedding[i + 1]::DOUBLE), exp(6 * embedding[i + 17]::DOUBLE), exp(6 * embedding[i + 33]::DOUBLE), exp(6 * embedding[i + 49]::DOUBLE)] AS w FROM (SELECT *, unnest(range(0, 16)) AS i FROM embeddings)),
s AS (SELECT vec_id, pixel, w, list_sum(w) AS t, CASE WHEN (vec_id + pixel) % 5 = 0 THEN 0 ELSE 1 END AS on_ FROM e)
SELECT vec_id, pixel::INT AS pixel, round(w[1] / t, 8) AS c0, round(on_ * w[2] / t, 8) AS c1, round(on_ * w[3] / t, 8) AS c2, round(on_ * w[4] / t, 8) AS c3, round(on_ * (w[2] / t + w[3] / t + w[4] / t), 8) AS oil FROM s""",
    "tile_instances": f"""WITH RECURSIVE {_PIXELS}, g AS (SELECT *, (tile * 8 + y) * 8 + x AS id FROM p WHERE v >= 0),
reach(id, tile, other, x, y) AS (SELECT id, tile, id, x, y FROM g UNION SELECT reach.id, g.tile, g.id, g.x, g.y FROM reach JOIN g ON g.tile = reach.tile AND abs(g.x - reach.x) + abs(g.y - reach.y) = 1),
label AS (SELECT id, min(other) AS instance FROM reach GROUP BY id), named AS (SELECT g.*, instance, max(v) OVER (PARTITION BY instance) AS top FROM g JOIN label USING (id))
SELECT tile, instance, count(*) AS n, round(max(v), 7) AS best, round(avg(v), 7) AS mean, min(x)::INT AS x0, max(x)::INT AS x1, min(y)::INT AS y0, max(y)::INT AS y1 FROM named WHERE top >= 0.2 AND v >= 0.05 GROUP BY tile, instance""",
    "zonal_stats": f"""WITH {_PIXELS}, s AS (SELECT label, (x + y) % 4 AS cls, sum(v) AS s FROM p GROUP BY label, (x + y) % 4)
SELECT label, count(*) AS n, round(avg(v), 7) AS mean, round(quantile_cont(v, 0.5), 7) AS median, round(max(v), 7) AS top, round(sum(v), 4) AS total, (SELECT cls FROM s WHERE s.label = p.label ORDER BY round(s, 9) DESC, cls LIMIT 1)::INT AS best_class FROM p GROUP BY label""",
    "channel_stack": """WITH e AS (SELECT vec_id, i, abs(embedding[i + 1]::DOUBLE) AS a, abs(embedding[i + 33]::DOUBLE) AS b FROM (SELECT *, unnest(range(0, 32)) AS i FROM embeddings)),
s AS (SELECT *, least(255, floor(a / (max(a) OVER (PARTITION BY vec_id) / 255))) AS vv FROM e) SELECT vec_id, i::INT AS pixel, vv::BIGINT AS vv, round(vv / 255, 8) AS unit, round(b, 7) AS aux FROM s""",
    "mask_likeness": """WITH m AS (SELECT vec_id AS id, vec_id // 25 AS scene, label % 3 AS cls, i, 1 / (1 + exp(-8 * embedding[i]::DOUBLE)) AS u FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings))
SELECT a.id AS a, b.id AS b, round(2 * sum(sqrt(a.u * b.u)) / sum(a.u + b.u), 7) AS dice FROM m a JOIN m b ON a.scene = b.scene AND a.cls = b.cls AND a.i = b.i AND a.id < b.id GROUP BY a.id, b.id""",
}
