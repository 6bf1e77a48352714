"""Statistics of rasters from their pixels: sixteen figures for each band, percentiles exact.

Pixels are counted by value first, on the map side as well, so that what is shuffled by raster is its histogram of distinct values and
not its pixels; a raster that holds a third of all pixels is counted by many tasks. The figures come from running sums over that
histogram, which are streamed.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.plans import tables

#: Figures in the order that a statistics service has them.
FIGURES = ["min", "max", "mean", "count", "sum", "std", "median", "majority", "minority", "unique", "histogram", "valid_percent", "masked_pixels", "valid_pixels", "percentile_2", "percentile_98"]


def counted(pixels: DataFrame, by: list[str], nodata: float | None = None) -> DataFrame:
    """(by, value, n) of pixels (by, value): how often each value stands; null, NaN and nodata as one null value. Histograms of parts of
    a raster are put together by summing n."""
    v = F.col("value").cast("double")
    masked = F.isnan(v) if nodata is None else F.isnan(v) | (v == nodata)
    return pixels.select(*by, F.when(~masked, v + 0.0).alias("value")).groupBy(*by, "value").agg(F.count("*").alias("n"))


def _bin(v: Column, low: Column, high: Column, bins: int) -> Column:
    """Number of the bin of a value, the last one closed; edges as they are worked out decide, not the quotient."""
    edge = lambda i: low + i * ((high - low) / bins)
    guess = F.least(F.lit(bins - 1), F.floor((v - low) / ((high - low) / bins)))
    return F.when(v < edge(guess), guess - 1).when((guess < bins - 1) & (v >= edge(guess + 1)), guess + 1).otherwise(guess)


def described(histogram: DataFrame, by: list[str], bins: int = 10) -> DataFrame:
    """by and FIGURES of a histogram (by, value, n), each value once; histogram is (counts, edges).

    Percentiles lie between the two nearest values as a straight line does; of values that stand equally often the smallest is majority or
    minority. std is that of all pixels and not of a sample. Where all values are equal the bins reach half below and above. A band with masked pixels
    only has null figures and counts of 0.
    """
    all_, up_to = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid = F.when(F.col("value").isNotNull(), F.col("n"))
    rows = histogram.withColumns({"_total": F.sum(valid).over(all_), "_sum": F.sum(F.col("value") * F.col("n")).over(all_), "_low": F.min("value").over(all_), "_high": F.max("value").over(all_), "_upto": F.sum(valid).over(up_to)})
    same = F.col("_low") == F.col("_high")
    rows = rows.withColumns({"_mean": F.col("_sum") / F.col("_total"), "_from": F.when(same, F.col("_low") - 0.5).otherwise(F.col("_low")), "_to": F.when(same, F.col("_high") + 0.5).otherwise(F.col("_high"))})
    rows = rows.withColumn("_bin", F.when(F.col("value").isNotNull(), _bin(F.col("value"), F.col("_from"), F.col("_to"), bins)))

    def percentile(p: float) -> Column:
        at = (F.col("_total") - 1) * p / 100
        nth = lambda k: F.min(F.when(F.col("_upto") > k, F.col("value")))
        low, high, part = nth(F.floor(at)), nth(F.ceil(at)), F.max(at - F.floor(at))
        return low + (high - low) * part

    total = F.coalesce(F.sum(valid), F.lit(0))
    masked = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    of_bin = F.array(*[F.coalesce(F.sum(F.when(F.col("_bin") == i, F.col("n"))), F.lit(0)) for i in range(bins)])
    edges = F.array(*[F.max("_from") + i * ((F.max("_to") - F.max("_from")) / bins) for i in range(bins)], F.max("_to"))
    square = F.col("n") * (F.col("value") - F.col("_mean")) * (F.col("value") - F.col("_mean"))
    figures = {
        "min": F.min("value"), "max": F.max("value"), "mean": F.max("_mean"), "count": total, "sum": F.max("_sum"), "std": F.sqrt(F.sum(square) / F.sum(valid)), "median": percentile(50),
        "majority": F.min_by("value", F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value")))), "minority": F.min_by("value", F.when(F.col("value").isNotNull(), F.struct("n", "value"))),
        "unique": F.count("value"), "histogram": F.when(F.count("value") > 0, F.struct(of_bin.alias("counts"), edges.alias("edges"))), "valid_percent": F.round(100 * total / (total + masked), 2),
        "masked_pixels": masked, "valid_pixels": total, "percentile_2": percentile(2), "percentile_98": percentile(98),
    }
    return rows.groupBy(*by).agg(*[figures[f].alias(f) for f in FIGURES])


def merged_counts(histograms: DataFrame, by: list[str]) -> DataFrame:
    """One histogram for each group of several: a mosaic's from its tiles', say."""
    return histograms.groupBy(*by, "value").agg(F.sum("n").alias("n"))


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bands for each scene, pixels of one value in some, nodata (0) in others."""
    l = tables.table(spark, sf_dir, "lineitem")
    value = F.floor(F.col("l_extendedprice") / 100) % 997 * (F.col("l_suppkey") % 10 > 0).cast("int") + F.col("l_suppkey") % 10 - F.when(F.col("l_suppkey") % 10 == 0, 0).otherwise(1)
    return l.select(F.col("l_suppkey").cast("long").alias("scene"), F.when(F.col("l_linenumber") % 2 == 0, "vh").otherwise("vv").alias("band"), (F.col("l_partkey") % 5).cast("long").alias("tile"), value.alias("value"))


def _rounded(rows: DataFrame, by: list[str]) -> DataFrame:
    text = lambda a, n: F.array_join(F.transform(a, lambda x: F.format_string(n, x)), " ")
    exact = ("min", "max", "sum", "majority", "minority")
    plain = {f: F.round(f, 6) for f in ("mean", "std", "median", "percentile_2", "percentile_98")} | {f: F.col(f).cast("long") for f in exact}
    own = [plain.get(f, F.col(f)).alias(f) for f in FIGURES if f != "histogram"]
    return rows.select(*by, *own, text("histogram.counts", "%d").alias("bins"), F.round(F.element_at("histogram.edges", 2), 6).alias("second_edge"))


def raster_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each band of each scene."""
    return _rounded(described(counted(_pixels(spark, sf_dir), ["scene", "band"], 0), ["scene", "band"]), ["scene", "band"])


def mosaic_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each band of all scenes, from the histograms of their tiles."""
    tiles = counted(_pixels(spark, sf_dir), ["scene", "tile", "band"], 0)
    return _rounded(described(merged_counts(tiles, ["band"]), ["band"]), ["band"])


QUERIES = {f.__name__: f for f in (raster_statistics, mosaic_statistics)}


def _sql(by: str) -> str:
    """The figures from the pixels themselves."""
    return f"""WITH p AS (SELECT {by}, nullif(v, 0) AS v FROM (SELECT l_suppkey::BIGINT AS scene, CASE WHEN l_linenumber % 2 = 0 THEN 'vh' ELSE 'vv' END AS band,
    CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE floor(l_extendedprice / 100)::BIGINT % 997 + l_suppkey % 10 - 1 END AS v FROM lineitem)),
a AS (SELECT {by}, min(v) AS low, max(v) AS high, count(*) AS size, count(v) AS valid FROM p GROUP BY ALL),
c AS (SELECT {by}, v, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY ALL), m AS (SELECT {by}, arg_max(v, (n, -v)) AS majority, arg_min(v, (n, v)) AS minority FROM c GROUP BY ALL),
e AS (SELECT *, CASE WHEN low = high THEN low - 0.5 ELSE low END::DOUBLE AS f, CASE WHEN low = high THEN high + 0.5 ELSE high END::DOUBLE AS t FROM a),
b AS (SELECT {by}, string_agg(n::VARCHAR, ' ' ORDER BY i) AS bins FROM (SELECT {by}, i, (SELECT count(*) FROM p WHERE {" AND ".join(f"p.{c} = e.{c}" for c in by.split(", "))} AND v >= f + i * ((t - f) / 10) AND (i = 9 OR v < f + (i + 1) * ((t - f) / 10))) AS n FROM e, range(0, 10) AS r(i) WHERE valid > 0) AS x GROUP BY {by})
SELECT {by}, low::BIGINT AS min, high::BIGINT AS max, (SELECT 0)::BIGINT + valid AS count, round(avg(v), 6) AS mean, sum(v)::BIGINT AS sum, round(stddev_pop(v), 6) AS std, round(median(v), 6) AS median, any_value(majority)::BIGINT AS majority, any_value(minority)::BIGINT AS minority,
    count(DISTINCT v) AS unique, round(100 * valid / size, 2) AS valid_percent, size - valid AS masked_pixels, valid AS valid_pixels, round(quantile_cont(v, 0.02), 6) AS percentile_2, round(quantile_cont(v, 0.98), 6) AS percentile_98, any_value(bins) AS bins, round(any_value(f + (t - f) / 10), 6) AS second_edge
FROM p JOIN e USING ({by}) LEFT JOIN m USING ({by}) LEFT JOIN b USING ({by}) GROUP BY {by}, low, high, size, valid"""


ORACLES = {"raster_statistics": _sql("scene, band"), "mosaic_statistics": _sql("band")}
