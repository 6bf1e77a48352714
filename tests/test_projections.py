"""Projections against published places and round trips, and background classes by masks on a polar grid."""

import math

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import projections as pj
from tidewatch.operators import overlays, reprojection

SHAPE = overlays.SHAPE


def box(x0, y0, x1, y1):
    return [{"x": float(x), "y": float(y)} for x, y in ((x1, y0), (x1, y1), (x0, y1), (x0, y0))]


def masks(spark, *rings):
    return spark.createDataFrame([([[r]],) for r in rings], f"shape {SHAPE}")


def outlines(spark, *rings):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rings)], "id long, ring array<struct<x: double, y: double>>")


def places(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "x double, y double").select(F.struct("x", "y").alias("p"))


@pytest.mark.parametrize("lon, lat, code, x, y", [(-79.387139, 43.642567, 32617, 630084.30, 4833438.59), (0.0, 0.0, 32631, 166021.44, 0.0), (-45.0, -0.0001, 32723, 500000.0, 9999988.95)])
def test_published_places_of_zones(spark, lon, lat, code, x, y):
    p = places(spark, [(lon, lat)])
    z = p.select(pj.zone(F.col("p.x"), F.col("p.y")).alias("z"), pj.to_zone(F.col("p"), F.lit(code)).alias("q")).first()
    assert z.z == code
    assert z.q.x == pytest.approx(x, abs=0.01) and z.q.y == pytest.approx(y, abs=0.01)


def test_meridian_arcs_are_those_of_the_ellipsoid(spark):
    """On a zone's meridian the northing is the scaled arc; Simpson's rule over the radius of curvature gives it apart from any series."""
    lats = [5.0, 33.3, 60.0, 83.9]
    got = places(spark, [(3, v) for v in lats]).select(pj.to_zone(F.col("p"), F.lit(32631)).alias("q")).collect()
    e2 = pj.E**2
    radius = lambda v: pj.A * (1 - e2) / (1 - e2 * math.sin(v) ** 2) ** 1.5
    for lat, r in zip(lats, got, strict=True):
        n, h = 2000, math.radians(lat) / 2000
        arc = h / 3 * sum(radius(i * h) * (1 if i in (0, n) else 4 if i % 2 else 2) for i in range(n + 1))
        assert r.q.y == pytest.approx(0.9996 * arc, abs=1e-4) and r.q.x == pytest.approx(500000, abs=1e-6)


def test_round_trips_within_a_millimetre(spark):
    rows = [(lon, lat) for lon in (-180, -179.99, -3, 0, 5.9, 6, 174, 179.999) for lat in (-80, -45.5, -1e-9, 0, 12, 71.3, 84)]
    p, z = F.col("p"), F.col("z")
    d = places(spark, rows).withColumn("z", pj.zone(p["x"], p["y"]))
    for of in (pj.from_zone(pj.to_zone(p, z), z), pj.from_zone(pj.to_zone(p, z + F.when(z % 100 == 60, -1).otherwise(1)), z + F.when(z % 100 == 60, -1).otherwise(1)), pj.from_polar(pj.to_polar(p)), pj.from_polar(pj.to_polar(p, 3031), 3031)):
        for r in d.select("p", of.alias("q")).collect():
            metres = 111320 * math.hypot(((r.q.x - r.p.x + 180) % 360 - 180) * math.cos(math.radians(r.p.y)), r.q.y - r.p.y)
            assert metres < 1e-3, r


def test_polar_grid(spark):
    """True scale on the standard parallel, the grid's meridian downwards, the pole in the middle."""
    a, b, pole = [r.q for r in places(spark, [(-45, 70), (45, 70), (12, 90)]).select(pj.to_polar(F.col("p")).alias("q")).collect()]
    e2, s = pj.E**2, math.sin(math.radians(70))
    radius = pj.A * math.cos(math.radians(70)) / math.sqrt(1 - e2 * s * s)
    # a parallel of true scale is as long on the grid as on the earth, and so has its radius
    assert a.x == pytest.approx(0, abs=1e-6) and a.y == pytest.approx(-radius, abs=1e-5)
    assert b.x == pytest.approx(-a.y, abs=1e-6) and b.y == pytest.approx(0, abs=1e-6)
    assert (pole.x, pole.y) == pytest.approx((0, 0), abs=1e-6)


def test_zones_end(spark):
    rows = [(180, 10), (-180, 10), (179.99, 10), (0, 84.01), (0, -80.01), (0, 84), (0, -80)]
    got = places(spark, rows).select(pj.zone(F.col("p.x"), F.col("p.y")).alias("z")).collect()
    assert [r.z for r in got] == [32601, 32601, 32660, None, None, 32631, 32731]


def test_measures_in_a_zone(spark):
    """A kilometre's square at the meridian; nulls, empty rings and places without a zone have no measures."""
    side = pj.from_zone
    d = spark.createDataFrame([(499500.0, 6000000.0)], "x double, y double")
    corner = lambda i, j: side(F.struct((F.col("x") + i).alias("x"), (F.col("y") + j).alias("y")), F.lit(32631))
    d = d.select(F.lit(0).cast("long").alias("id"), F.array(corner(0, 0), corner(1000, 0), corner(1000, 1000), corner(0, 1000)).alias("ring"))
    d = d.union(outlines(spark, None, [], box(0, 85, 1, 86)).select((F.col("id") + 1).alias("id"), "ring"))
    got = {r.id: r for r in reprojection.plane_measures(reprojection.in_zone(d)).collect()}
    assert got[0].epsg == 32631 and got[0].plane_area == pytest.approx(1e6, abs=0.01) and got[0].plane_length == pytest.approx(4000, abs=1e-4)
    assert all(got[i].epsg is None and got[i].plane_area is None and got[i].plane_length is None for i in (1, 2, 3))


def classes(spark, rings, land, ice, to_ice=None):
    rows = reprojection.background(outlines(spark, *rings), land, ice, to_ice)
    return [r.background for r in rows.orderBy("id").collect()]


def test_sea_ice_where_land_is_clear_and_land_first(spark):
    ring = box(0, 0, 1, 1)
    assert classes(spark, [ring], masks(spark, box(10, 10, 11, 11)), masks(spark, box(0.5, 0.5, 1.5, 1.5))) == ["SEA_ICE"]
    assert classes(spark, [ring], masks(spark, ring), masks(spark, ring)) == ["LAND"]
    # a border in common is enough
    assert classes(spark, [ring, box(3, 3, 4, 4)], masks(spark, box(1, 0, 2, 1)), masks(spark)) == ["LAND", None]


def test_masks_on_a_polar_grid(spark):
    """In the mask's plane the outline is clear of it, though a ring of the mask's corners in degrees would cover it."""
    far, land = masks(spark, box(-2_000_000, 0, 0, 2_000_000)), masks(spark, box(10, 10, 11, 11))
    ring = box(-160.2, 64.7, -159.8, 65.1)
    within = outlines(spark, box(-1_800_000, 500_000, -1_700_000, 600_000)).select(F.transform("ring", lambda p: pj.from_polar(p)).alias("ring")).first().ring
    within = [c.asDict() for c in within]
    assert classes(spark, [ring, within], land, far, pj.to_polar) == [None, "SEA_ICE"]
    naive = far.select(F.transform("shape", lambda g: F.transform(g, lambda r: F.transform(r, lambda p: pj.from_polar(p)))).alias("shape"))
    assert classes(spark, [ring], land, naive) == ["SEA_ICE"]


def test_holes_many_corners_nulls_and_days(spark):
    """A mask of 3,000 corners with a hole: what is in the hole is clear. Null and empty rings are neither; a mask is of its day alone."""
    at = lambda r, k: {"x": r * math.cos(2 * math.pi * k / 3000), "y": r * math.sin(2 * math.pi * k / 3000)}
    wheel = spark.createDataFrame([([[[at(5, k) for k in range(3000)], [at(2, -k) for k in range(3000)]]],), (None,), ([],)], f"shape {SHAPE}")
    rings = [box(-1, -1, 1, 1), box(-1, -1, 1, 3), box(3, 0, 3.5, 0.5), box(6, 6, 7, 7), None, [], box(-8, -8, 8, 8)]
    assert classes(spark, rings, masks(spark), wheel) == [None, "SEA_ICE", "SEA_ICE", None, None, None, "SEA_ICE"]
    rows = outlines(spark, box(0, 0, 1, 1), box(0, 0, 1, 1), box(0, 0, 1, 1)).withColumn("day", F.when(F.col("id") < 2, F.col("id")))
    got = reprojection.background(rows, masks(spark), masks(spark, box(0, 0, 1, 1)).withColumn("day", F.lit(1).cast("long")), None, ["day"])
    assert [r.background for r in got.orderBy("id").collect()] == [None, "SEA_ICE", None]
    assert {tuple(r) for r in reprojection.background_counts(got, ["day"]).collect()} == {(0, 0, 0, 1), (1, 0, 1, 0), (None, 0, 0, 1)}
