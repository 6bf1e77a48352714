"""Places near each other, by the cells of a grid that the surroundings of one side cover."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import geometry as geo

#: Rows of one place that stand in one row, about.
BUNCH = 1000


def surroundings(lon: Column, lat: Column, metres: float, size: float) -> Column:
    """The cells (gx, gy) of `size` degrees that may hold a place at most `metres` away: as many to the sides as the latitude asks for, all
    around where a pole is that near, and over the 180th meridian. A cell stands once."""
    my = metres / geo.METRES_Y
    cosine = F.cos(F.radians(F.least(F.lit(90.0), F.abs(lat) + my)))
    mx = F.when(cosine * 180 * geo.METRES_X <= metres, 180.0).otherwise(metres / geo.METRES_X / cosine)
    at = lambda v: F.floor(v / size)
    around = lambda x: F.pmod(x, F.lit(round(360 / size)))
    xs = F.array_distinct(F.transform(F.sequence(at(lon - mx), at(lon + mx)), around))
    ys = F.sequence(at(lat - my), at(lat + my))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(x.alias("gx"), y.alias("gy")))))


def cell(lon: Column, lat: Column, size: float) -> Column:
    return F.struct(F.pmod(F.floor(lon / size), F.lit(round(360 / size))).alias("gx"), F.floor(lat / size).alias("gy"))


def near_places(left: DataFrame, right: DataFrame, metres: float, size: float) -> DataFrame:
    """Pairs of rows (lon, lat ...) less than `metres` apart on the sphere; columns get the prefixes a_ and b_, metres is the distance. 360 has to be a
    multiple of `size`.

    Rows of right that share a place are one row until its distances are known, some BUNCH of them together: many rows at few places cost what their
    pairs cost to write, and no distance each.
    """
    named = [f"b_{c}" for c in right.columns]
    rest = [c for c in right.columns if c not in ("lon", "lat")]
    spot = right.select("lon", "lat", F.struct(*rest).alias("rest")).where("lon is not null and lat is not null")
    bunches = spot.groupBy("lon", "lat").agg(F.ceil(F.count("*") / BUNCH).alias("bunches"))
    right = spot.join(bunches, ["lon", "lat"]).groupBy("lon", "lat", F.pmod(F.xxhash64("rest"), "bunches").alias("bunch")).agg(F.collect_list("rest").alias("rest")).drop("bunch")
    a = left.withColumnsRenamed({c: f"a_{c}" for c in left.columns}).withColumn("cell", cell(F.col("a_lon"), F.col("a_lat"), size))
    b = right.withColumnsRenamed({c: f"b_{c}" for c in right.columns}).withColumn("cell", F.explode(surroundings(F.col("b_lon"), F.col("b_lat"), metres, size)))
    apart = geo.haversine(F.col("a_lon"), F.col("a_lat"), F.col("b_lon"), F.col("b_lat"))
    near = a.join(b, "cell").withColumn("metres", apart).where(F.col("metres") < metres).drop("cell").withColumn("rest", F.explode("b_rest"))
    return near.select(*[f"a_{c}" for c in left.columns], *[F.col(c) if c in ("b_lon", "b_lat") else F.col(f"rest.{c[2:]}").alias(c) for c in named], "metres")
