"""Shapes in the planes of map projections: measures in the zone around a shape, and background classes by masks on grids of their own."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import geometry as geo
from tidewatch.functions import projections as pj
from tidewatch.operators import overlays
from tidewatch.plans import tables

#: Sides of the cells on which shapes and masks meet, in degrees and in metres. A part of a mask touches at most as many cells as
#: the earth has: some 65,000 and, on a polar grid, 15,000.
CELL_DEGREES, CELL_METRES = 1.0, 100_000.0


def in_zone(outlines: DataFrame) -> DataFrame:
    """outlines (ring ...) with epsg, the zone around the middle of the ring's box, and plane, the ring in its metres.

    Both are null beyond 80 degrees south and 84 degrees north, and for null and empty rings.
    """
    code = pj.zone_of_box(geo.box(F.col("ring")))
    return outlines.withColumn("epsg", code).withColumn("plane", F.when(F.col("epsg").isNotNull(), pj.projected(F.col("ring"), lambda p: pj.to_zone(p, F.col("epsg")))))


def plane_measures(rows: DataFrame) -> DataFrame:
    """rows (plane ...) with plane_area and plane_length: square metres and metres as the plane shows them, null where plane is."""
    length = geo.total(geo.edges(F.col("plane")), lambda s: F.hypot(s["bx"] - s["ax"], s["by"] - s["ay"]))
    known = F.size("plane") > 0
    return rows.withColumn("plane_area", F.when(known, F.abs(geo.planar_area(F.col("plane"))))).withColumn("plane_length", F.when(known, length))


def _cells(box: Column, cell: float) -> Column:
    steps = lambda low, high: F.sequence(F.floor(low / cell), F.floor(high / cell))
    rows = lambda x: F.transform(steps(box["miny"], box["maxy"]), lambda y: F.struct(x.alias("x"), y.alias("y")))
    return F.flatten(F.transform(steps(box["minx"], box["maxx"]), rows))


def _cell_ring(cell: Column, size: float) -> Column:
    at = lambda i, j: F.struct(((cell["x"] + i) * F.lit(size)).alias("x"), ((cell["y"] + j) * F.lit(size)).alias("y"))
    return F.array(at(0, 0), at(1, 0), at(1, 1), at(0, 1))


def _cut(sides: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether a side has a point within a box, its border left out: no line along the box or the side parts them."""

    def within(s: Column) -> Column:
        turns = F.array(*[(s["bx"] - s["ax"]) * (y - s["ay"]) - (s["by"] - s["ay"]) * (x - s["ax"]) for x in (x0, x1) for y in (y0, y1)])
        beside = (F.greatest(s["ax"], s["bx"]) <= x0) | (F.least(s["ax"], s["bx"]) >= x1) | (F.greatest(s["ay"], s["by"]) <= y0) | (F.least(s["ay"], s["by"]) >= y1)
        return ~beside & (F.array_min(turns) < 0) & (F.array_max(turns) > 0)

    return F.exists(sides, within)


def _filled(sides: Column, cell: Column, size: float) -> Column:
    """Whether a cell lies in a polygon: no side goes through it, and its middle is inside."""
    x0, y0 = cell["x"] * F.lit(size), cell["y"] * F.lit(size)
    x1, y1 = (cell["x"] + 1) * F.lit(size), (cell["y"] + 1) * F.lit(size)
    return ~_cut(sides, x0, y0, x1, y1) & geo.contains(sides, (x0 + x1) / 2, (y0 + y1) / 2)


def meeting(outlines: DataFrame, mask: DataFrame, cell: float, same: list[str] = (), most: int = 255) -> DataFrame:
    """The distinct ids of outlines (id, ring, the columns `same`) that have a point in common with a shape of mask (shape, the
    columns `same`), borders included; both in one plane. Nulls in `same` meet nothing, nor do null and empty shapes.

    Equal masks count once. They are cut into parts of at most `most` corners, and parts meet outlines on cells, so that neither a mask with a
    million corners nor one as large as an ocean is compared whole. A cell that lies in a part is itself all that its outlines have to meet, however
    many masks lie over each other there; an outline whose first corner is in such a cell meets it without a comparison.
    """
    whole = tables.dealt(mask.where("size(shape) > 0").select(*same, "shape").distinct(), *same, "shape")
    parts = overlays.subdivided(whole, most).select(*same, F.col("shape")[0].alias("rings"))
    sided = F.flatten(F.transform("rings", geo.edges))
    right = parts.select(*same, sided.alias("m_sides"), geo.box(F.col("rings")[0]).alias("m_box"))
    right = right.select(*same, "m_sides", "m_box", F.explode(_cells(F.col("m_box"), cell)).alias("cell"))
    right = tables.settled(right.withColumn("filled", _filled(F.col("m_sides"), F.col("cell"), cell)))
    full = tables.settled(right.where("filled").select(*same, "cell").distinct())
    ring = _cell_ring(F.col("cell"), cell)
    right = right.where("not filled").drop("filled").join(full, [*same, "cell"], "left_anti").unionByName(full.select(*same, geo.edges(ring).alias("m_sides"), geo.box(ring).alias("m_box"), "cell"))
    first = F.struct(*[F.floor(F.col("ring")[0][c] / cell).alias(c) for c in "xy"])
    left = outlines.where("size(ring) > 0").select("id", *same, "ring", first.alias("cell"))
    left = left.join(full.withColumn("sure", F.lit(True)), [*same, "cell"], "left")
    rest = left.where("sure is null").select("id", *same, geo.edges(F.col("ring")).alias("sides"), geo.box(F.col("ring")).alias("box"))
    rest = rest.select("id", *same, "sides", "box", F.explode(_cells(F.col("box"), cell)).alias("cell"))
    both = rest.join(right, [*same, "cell"])
    a, b = F.col("box"), F.col("m_box")
    near = (a["minx"] <= b["maxx"]) & (b["minx"] <= a["maxx"]) & (a["miny"] <= b["maxy"]) & (b["miny"] <= a["maxy"])
    found = both.where(near).where(geo.distance(F.col("sides"), F.col("m_sides")) == 0).select("id").distinct()
    return left.where("sure").select("id").union(found).distinct()


def background(outlines: DataFrame, land: DataFrame, ice: DataFrame, to_ice: Callable[[Column], Column] | None, same: list[str] = ()) -> DataFrame:
    """outlines (id, ring ...; ids unique) with background: LAND where an outline touches a shape of land (shape; degrees), otherwise
    SEA_ICE where it touches one of ice (shape, the columns `same`, a day say), else null.

    `to_ice` takes a place in degrees to the plane of the ice masks; None: they are in degrees. Outlines are taken to the plane of the masks
    and not the other way round, as a mask around a pole has no ring in degrees. Only outlines that aren't on land are held against the ice.
    """
    on_land = meeting(outlines, land, CELL_DEGREES).withColumn("on_land", F.lit(True))
    rows = tables.settled(outlines.join(on_land, "id", "left"))
    plane = rows.where("on_land is null").drop("on_land")
    plane = plane.withColumn("ring", pj.projected(F.col("ring"), to_ice)) if to_ice else plane
    on_ice = meeting(plane, ice, CELL_METRES if to_ice else CELL_DEGREES, same).withColumn("on_ice", F.lit(True))
    rows = rows.join(on_ice, "id", "left")
    return rows.withColumn("background", F.when(F.col("on_land"), "LAND").when(F.col("on_ice"), "SEA_ICE")).drop("on_land", "on_ice")


def background_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    """How many rows of each group have each background."""
    return rows.groupBy(*by).agg(*[F.count_if(F.col("background") == c).alias(c.lower()) for c in ("LAND", "SEA_ICE")], F.count_if(F.col("background").isNull()).alias("open_water"))


def zone_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone, area and length of each outline in its metres."""
    rows = plane_measures(in_zone(tables.outlines(spark, sf_dir)))
    return rows.select("id", "epsg", F.round("plane_area", 0).alias("area"), F.round("plane_length", 3).alias("length"))


def corners_in_zones(outlines: DataFrame) -> DataFrame:
    """(id, k, epsg, x, y, east_x, east_y, off_mm) of the corners of outlines (id long, ring): place in the zone around each, in that zone's neighbour to the east, and by how many
    whole millimetres the way back is off. All but id and k are null where there is no zone. A batch of rings is projected at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rings = b.column("ring")
            sizes = np.nan_to_num(rings.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
            p = rings.flatten()
            lon, lat = (p.field(c).to_numpy(zero_copy_only=False).astype(float) for c in "xy")
            codes = pj.zones(lon, lat)
            no = codes == 0
            own, east = pj.to_zones(lon, lat, codes), pj.to_zones(lon, lat, codes + 1)
            back = pj.from_zones(*own, codes)
            off = np.floor(111_320_000 * np.hypot(back[0] - lon, back[1] - lat))
            k = np.arange(len(lon)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns = [b.column("id").take(pa.array(np.repeat(np.arange(len(b)), sizes))), pa.array(k), pa.array(codes.astype(np.int32), mask=no), *(pa.array(m, mask=no) for m in (*own, *east)), pa.array(np.where(no, 0, off).astype(np.int64), mask=no)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "k", "epsg", "x", "y", "east_x", "east_y", "off_mm"])

    return outlines.select("id", "ring").mapInArrow(run, "id long, k long, epsg int, x double, y double, east_x double, east_y double, off_mm long")


def zone_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: corners of the outlines in the zone around each corner and the zone's neighbour to the east, and by how many whole millimetres the way back is off."""
    rows = corners_in_zones(tables.outlines(spark, sf_dir))
    return rows.select("id", "k", "epsg", *[F.round(c, 3).alias(c) for c in ("x", "y", "east_x", "east_y")], "off_mm")


def _arctic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, day, ring): a box of each order between 55 and 89 degrees of latitude."""
    key = F.col("o_orderkey")
    o = tables.table(spark, sf_dir, "orders").select(key.alias("id"), (key % 3).alias("day"), (-179 + (key * 6007 % 35801) / 100).alias("lon"), (55 + (key * 7001 % 33907) / 1000).alias("lat"), (0.05 + key % 5 / 25).alias("w"))
    corner = lambda i, j: pj.place(F.col("lon") + i * F.col("w"), F.col("lat") + j * F.col("w") / 2)
    return o.select("id", "day", F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1)).alias("ring"))


def _boxes(size: Column) -> Column:
    corner = lambda i, j: pj.place(F.col("x") + i * size, F.col("y") + j * size)
    return F.array(F.array(F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)))).alias("shape")


def _arctic_masks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Land in degrees and ice of three days in metres of the polar grid: boxes of each supplier."""
    key = F.col("s_suppkey")
    s = tables.table(spark, sf_dir, "supplier").select(key.alias("key"), (key % 3).alias("day"))
    land = s.select((-178 + F.col("key") * 613 % 351).alias("x"), (56 + F.col("key") * 7 % 31).alias("y"))
    ice = s.select("day", (-3_600_000 + F.col("key") * 700_001 % 7_000_000).alias("x"), (-3_500_000 + F.col("key") * 900_007 % 6_900_000).alias("y"), (60_000 + F.col("key") * 37 % 11 * 30_000).alias("size"))
    return land.select(_boxes(F.lit(1.5))), ice.select("day", _boxes(F.col("size")))


def arctic_background(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of the Arctic as land or as sea ice of their day, by masks in degrees and in metres of a polar grid."""
    return background(_arctic(spark, sf_dir), *_arctic_masks(spark, sf_dir), pj.to_polar, ["day"]).select("id", "background")


def arctic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many outlines of a day are land, sea ice and neither."""
    return background_counts(background(_arctic(spark, sf_dir), *_arctic_masks(spark, sf_dir), pj.to_polar, ["day"]), ["day"])


def polar_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: corners of the Arctic outlines on the northern grid, of their mirror images on the southern one, and back."""
    rows = _arctic(spark, sf_dir).select("id", F.posexplode("ring").alias("k", "p"))
    rows = rows.withColumn("north", pj.to_polar(F.col("p"))).withColumn("south", pj.to_polar(pj.place(F.col("p.x"), -F.col("p.y")), 3031))
    rows = rows.withColumn("a", pj.from_polar(F.col("north"))).withColumn("b", pj.from_polar(F.col("south"), 3031))
    place = lambda p, n: [F.round(f"{p}.{c}", n) for c in "xy"]
    names = ("north_x", "north_y", "south_x", "south_y", "lon", "lat", "south_lon", "south_lat")
    found = [*place("north", 2), *place("south", 2), *place("a", 7), *place("b", 7)]
    return rows.select("id", F.col("k").cast("long").alias("k"), *[c.alias(n) for c, n in zip(found, names, strict=True)])


QUERIES = {f.__name__: f for f in (zone_measures, zone_places, arctic_background, arctic_counts, polar_places)}

# The SQL takes latitudes to the conformal sphere by tangents and powers, and adds up the series as rows of complex powers of one sine and cosine.
_E = pj.E
_CONFORMAL = f"tan(pi() / 4 + radians(lat) / 2) * pow((1 - {_E!r} * sin(radians(lat))) / (1 + {_E!r} * sin(radians(lat))), {_E / 2!r})"


def _zone_sql(rows: str) -> str:
    """rows (lon, lat, code ...) with e and n."""
    c = pj.TO_PLANE
    k = pj.SCALE * pj.RECTIFYING
    add = lambda of: " + ".join(f"{v!r} * {of(2 * j)}" for j, v in enumerate(c, 1))
    return f"""SELECT *, 500000 + {k!r} * (eta + {add(lambda m: f"cos({m} * xi) * (exp({m} * eta) - exp(-{m} * eta)) / 2")}) AS e,
        CASE WHEN code > 32700 THEN 10000000 ELSE 0 END + {k!r} * (xi + {add(lambda m: f"sin({m} * xi) * (exp({m} * eta) + exp(-{m} * eta)) / 2")}) AS n
    FROM (SELECT *, atan2(t, cos(lam)) AS xi, 0.5 * ln((1 + b) / (1 - b)) AS eta
        FROM (SELECT *, 2 * sin(lam) / (w + 1 / w) AS b, (w - 1 / w) / 2 AS t FROM (SELECT *, {_CONFORMAL} AS w, radians(lon - (code % 100 * 6 - 183)) AS lam FROM ({rows})) AS z1) AS z2) AS z3"""


_CODE = "CASE WHEN {y} >= 0 THEN 32600 ELSE 32700 END + 1 + floor(({x} + 180) / 6)::INT"
_RING = f"WITH c AS ({tables.CORNERS})"
_ARCTIC = """SELECT o_orderkey AS id, o_orderkey % 3 AS day, -179 + (o_orderkey * 6007 % 35801) / 100 AS lon0, 55 + (o_orderkey * 7001 % 33907) / 1000 AS lat0, 0.05::DOUBLE + o_orderkey % 5 / 25 AS w FROM orders"""
_ARCTIC_CORNERS = f"SELECT id, day, k, lon0 + CASE WHEN k IN (0, 3) THEN -w ELSE w END AS lon, lat0 + CASE WHEN k < 2 THEN -w ELSE w END / 2 AS lat FROM ({_ARCTIC}) AS q, range(0, 4) AS r(k)"


def _polar_sql(rows: str, code: int) -> str:
    """rows (lon, lat ...; the latitude's absolute value) with px and py."""
    side, meridian, scale = pj._polar(code)
    return f"SELECT *, {scale!r} / ({_CONFORMAL}) * sin(radians(lon - {meridian})) AS px, {-side} * {scale!r} / ({_CONFORMAL}) * cos(radians(lon - {meridian})) AS py FROM ({rows}) AS p0"


# Boxes in degrees meet as intervals do; a projected box and a box of the grid, both convex, meet unless a side of either keeps them apart.
_BACKGROUND = f"""WITH o AS MATERIALIZED ({_ARCTIC}), c AS MATERIALIZED ({_polar_sql(_ARCTIC_CORNERS, 3413)}),
s AS (SELECT s_suppkey AS key, s_suppkey % 3 AS day, -178 + s_suppkey * 613 % 351 AS x, 56 + s_suppkey * 7 % 31 AS y,
    -3600000 + s_suppkey * 700001 % 7000000 AS ix, -3500000 + s_suppkey * 900007 % 6900000 AS iy, 60000 + s_suppkey * 37 % 11 * 30000 AS size FROM supplier),
land AS (SELECT DISTINCT id FROM o JOIN s ON lon0 - w <= x + 1.5 AND lon0 + w >= x AND lat0 - w / 2 <= y + 1.5 AND lat0 + w / 2 >= y),
e AS (SELECT a.id, a.day, a.k, a.px AS ax, a.py AS ay, b.px - a.px AS dx, b.py - a.py AS dy FROM c a JOIN c b ON a.id = b.id AND b.k = (a.k + 1) % 4),
b AS (SELECT id, day, min(px) AS x0, max(px) AS x1, min(py) AS y0, max(py) AS y1 FROM c GROUP BY id, day),
m AS (SELECT b.id, s.key, s.ix, s.iy, s.size FROM b JOIN s ON b.day = s.day AND x0 <= ix + size AND x1 >= ix AND y0 <= iy + size AND y1 >= iy),
f AS (SELECT m.id, m.key, e.k, unnest([dx * (iy - ay) - dy * (ix - ax), dx * (iy - ay) - dy * (ix + size - ax), dx * (iy + size - ay) - dy * (ix - ax), dx * (iy + size - ay) - dy * (ix + size - ax)]) AS turn FROM m JOIN e ON m.id = e.id),
ice AS (SELECT DISTINCT id FROM (SELECT id, key, bool_and(reach) AS met FROM (SELECT id, key, k, max(turn) >= 0 AS reach FROM f GROUP BY id, key, k) AS g GROUP BY id, key) AS h WHERE met),
r AS (SELECT id, day, CASE WHEN id IN (SELECT id FROM land) THEN 'LAND' WHEN id IN (SELECT id FROM ice) THEN 'SEA_ICE' END AS background FROM o)"""

ORACLES = {
    "zone_measures": f"""{_RING}, b AS (SELECT id, {_CODE.format(x="(min(x) + max(x)) / 2", y="(min(y) + max(y)) / 2")} AS code FROM c GROUP BY id),
p AS ({_zone_sql("SELECT c.id, c.k, c.n AS corners, c.x AS lon, c.y AS lat, b.code FROM c JOIN b ON c.id = b.id")}),
f AS (SELECT id, e AS fe, n AS fn FROM p WHERE k = 0), q AS (SELECT p.id, p.k, corners, code, e - fe AS e, n - fn AS n FROM p JOIN f ON p.id = f.id)
SELECT a.id, any_value(a.code) AS epsg, round(abs(sum(a.e * b.n - b.e * a.n)) / 2, 0) AS area, round(sum(sqrt(pow(b.e - a.e, 2) + pow(b.n - a.n, 2))), 3) AS length
FROM q a JOIN q b ON a.id = b.id AND b.k = (a.k + 1) % a.corners GROUP BY a.id""",
    "zone_places": f"""{_RING}, p AS (SELECT id, k, x AS lon, y AS lat, {_CODE.format(x="x", y="y")} AS code FROM c),
a AS ({_zone_sql("SELECT * FROM p")}), b AS ({_zone_sql("SELECT id, k, lon, lat, code + 1 AS code FROM p")})
SELECT a.id, a.k, a.code AS epsg, round(a.e, 3) AS x, round(a.n, 3) AS y, round(b.e, 3) AS east_x, round(b.n, 3) AS east_y, 0::BIGINT AS off_mm FROM a JOIN b ON a.id = b.id AND a.k = b.k""",
    "arctic_background": _BACKGROUND + " SELECT id, background FROM r",
    "arctic_counts": _BACKGROUND + " SELECT day, count(*) FILTER (background = 'LAND') AS land, count(*) FILTER (background = 'SEA_ICE') AS sea_ice, count(*) FILTER (background IS NULL) AS open_water FROM r GROUP BY day",
    "polar_places": f"""WITH n AS ({_polar_sql(_ARCTIC_CORNERS, 3413)}), s AS ({_polar_sql(_ARCTIC_CORNERS, 3031)})
SELECT n.id, n.k, round(n.px, 2) AS north_x, round(n.py, 2) AS north_y, round(s.px, 2) AS south_x, round(s.py, 2) AS south_y, round(n.lon, 7) AS lon, round(n.lat, 7) AS lat, round(n.lon, 7) AS south_lon, round(-n.lat, 7) AS south_lat FROM n JOIN s ON n.id = s.id AND n.k = s.k""",
}
