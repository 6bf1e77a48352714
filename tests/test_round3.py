"""Cases that the review of the third round brought up."""

import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import polygons, records, tuning

DATA = "/root/testdata/sf0.001"


def test_places_next_to_the_ocean_border_lie_where_the_sql_has_them(spark):
    """Places on the third side: differences of its corners are taken in decimals, which have no rounding."""
    lat = np.array([39.5 + k / 100 for k in range(307)])
    places = spark.createDataFrame([("S1A_IW_GRDH_1SDV_20240101T000000_0", 9.5 + i / 100, float(y)) for i in range(401) for y in lat], "scene_id string, lon double, lat double")
    got = {(r.lon, r.lat) for r in records.relevant(places, records._ocean()).where("matters").collect()}
    ring = [(Decimal(str(x)), Decimal(str(y))) for x, y in records.OCEAN]

    def inside(x, y):
        n = 0
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            n += (float(ay) > y) != (float(by) > y) and x < float(bx - ax) * (y - float(ay)) / float(by - ay) + float(ax)
        return n % 2 == 1

    assert got == {(9.5 + i / 100, float(y)) for i in range(401) for y in lat if inside(9.5 + i / 100, float(y))}


def test_places_just_as_far_apart_as_one_place_may_be(spark):
    """Where the distance is SAME_PLACE but for rounding, the root of the sum of squares decides."""
    steps = [(p, q) for p in range(-10, 11) for q in range(-10, 11) if p * p + q * q == 100]
    found = [(a / 2000, (a - p - 2) / 2000 + 0.001, c / 2000, (c - q) / 2000) for p, q in steps for a in range(101) for c in range(103) if 0 <= a - p - 2 <= 100 and 0 <= c - q <= 102]
    c = spark.createDataFrame([(i, 1, 1, x, y, 1.0) for i, (x, _, y, _) in enumerate(found)], "slick int, type int, ext_id int, x double, y double, score double")
    t = spark.createDataFrame([(i, 1, 2, x, y) for i, (_, x, _, y) in enumerate(found)], "slick int, type int, ext_id int, x double, y double")
    got = {r.slick for r in tuning.labelled(c, t).where("truth and ext_id = 1").collect()}
    assert got == {i for i, (x, u, y, v) in enumerate(found) if math.sqrt((x - u) ** 2 + (y - v) ** 2) <= 0.005}


def test_neighbours_of_other_scenes_count(spark):
    """Pairs and counts are those of all outlines of a class, also where a block of 250 ends."""
    pairs = polygons.outline_neighbours(spark, DATA)
    assert pairs.where(F.floor(F.col("a") / 250) != F.floor(F.col("b") / 250)).count() > 0
    met = {r.id: r.overlaps for r in polygons.overlap_counts(spark, DATA).collect()}
    assert sum(met.values()) == 2 * pairs.where("metres = 0").count()


def test_many_overlays_at_once_are_those_one_by_one():
    from tidewatch.functions import overlay as ov

    r = np.random.default_rng(5)

    def star(at):
        n = r.integers(5, 9)
        t = np.sort(r.uniform(0, 2 * np.pi, n))
        return np.stack([np.cos(t), np.sin(t)], 1) * r.uniform(0.4, 1, n)[:, None] + at

    rings = [star(r.uniform(-1, 1, 2)) for _ in range(300)]
    rings += [np.rint(3 * x) / 3 for x in rings[:60]] + [x[[0, 2, 1, *range(3, len(x))]] for x in rings]
    one = [ov.repaired([x]) for x in rings]
    many = ov.repairs([[x] for x in rings])
    assert [[p.tolist() for q in s for p in q] for s in one] == [[p.tolist() for q in s for p in q] for s in many]
    other = one[7:] + one[:7]
    for single, together in ((ov.difference, ov.differences), (ov.intersection, ov.intersections)):
        assert [ov.area(x) for x in together(one, other)] == pytest.approx([ov.area(single(a, b)) for a, b in zip(one, other)], abs=1e-9)
    groups = [[*a, *b, *a] for a, b in zip(one, other)] + [[]]
    assert [ov.area(x) for x in ov.unions(groups)] == pytest.approx([ov.area(ov.union(g)) for g in groups], abs=1e-9)


def test_small_groups_are_dissolved_in_one_round(spark, monkeypatch):
    """Groups of at most FAN_IN shapes need no second round of chunks, whatever cells they lie in: rows are written once."""
    from tidewatch.operators import overlays
    from tidewatch.plans import tables

    n, settled = [], tables.settled
    monkeypatch.setattr(tables, "settled", lambda df: n.append(1) or settled(df))
    assert overlays.united_merges(spark, DATA).count() > 0 and n == [1]


def test_grids_move_candidates_once(spark):
    """Ranks at all points equal those of windows, with ties, nulls and NaN, and no row is multiplied by the grid."""
    nan = float("nan")
    rows = [(k % 7, k * 5 % 11, k % 3 + 1, k % 4 == 0, (None, nan, 1.0, 2.0, 0.5)[k * k % 5], float(k % 3), float(k % 2)) for k in range(200)]
    c = spark.createDataFrame(rows, "slick int, source int, type int, truth boolean, temporal double, proximity double, parity double").dropDuplicates(["slick", "source", "truth"])
    weights = [0.0, 0.5, 3.0]
    found = tuning.weight_measures(c, weights)
    many = c.withColumn("w", F.explode(F.array(*map(F.lit, weights))))
    score = (F.col("w") * F.col("temporal") + 2 * F.col("proximity") + F.col("parity")) / (3 + F.col("w"))
    want = {r.w: (r.mean_rank, r.top3) for r in tuning.rank_measures(tuning.ranked(many, score, ["w", "slick"]), ["w"]).collect()}
    assert {r.w: (r.mean_rank, r.top3) for r in found.collect()} == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan


def test_a_cell_within_a_mask_is_met_without_comparing_masks(spark):
    """A hundred masks over each other are one row of each cell that they fill; outlines at their border are still compared."""
    from tidewatch.operators import reprojection

    square = lambda x, y, n: [{"x": float(x + i), "y": float(y + j)} for i, j in ((0, 0), (n, 0), (n, n), (0, n))]
    mask = spark.createDataFrame([([[square(10 - k / 1000, 10 - k / 1000, 3.5)]],) for k in range(100)], "shape array<array<array<struct<x: double, y: double>>>>")
    at = [(0, 11.5, 11.5), (1, 13.45, 13.45), (2, 13.55, 13.55), (3, 9.85, 9.85), (4, 9.7, 9.7), (5, 13.1, 20.0)]
    outlines = spark.createDataFrame([(i, square(x, y, 0.1)) for i, x, y in at], "id int, ring array<struct<x: double, y: double>>")
    got = reprojection.meeting(outlines, mask, 1.0)
    assert {r.id for r in got.collect()} == {0, 1, 3}


def test_shared_areas_of_many_pairs(spark):
    """Equal to those one by one; and suppression takes scenes many at a time, without a call for each."""
    r = np.random.default_rng(2)
    star = lambda n: np.stack([np.cos(t := np.sort(r.uniform(0, 6.28, n))), np.sin(t)], 1) * r.uniform(0.4, 1, n)[:, None] + r.uniform(-0.5, 0.5, 2)
    a, b = np.stack([star(7) for _ in range(200)]), np.stack([star(6) for _ in range(200)])
    assert polygons.overlap_areas(a, b) == pytest.approx([polygons.overlap_area(p, q) for p, q in zip(a, b)], abs=1e-12)
    assert "FlatMapGroups" not in polygons.suppressed_outlines(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
