"""Cases that the third round's findings brought up: steps whose work grew faster than their input, or stood in one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import cells
from tidewatch.operators import filters, graph, overlays, polygons
from tidewatch.plans import tables, views

DATA = "/root/testdata/sf0.001"


def stars(n, seed=3):
    r = np.random.default_rng(seed)
    return [np.stack([np.cos(t := np.sort(r.uniform(0, 6.28, k))), np.sin(t)], 1) * r.uniform(0.3, 1, k)[:, None] for k in r.integers(3, 30, n)]


def flat(rings):
    return np.concatenate([[0], np.cumsum([len(r) for r in rings])]), *np.concatenate(rings).T


def test_outlines_are_dealt_over_all_cores(spark):
    """A table of one file is one task when it is read, not when its outlines are worked on."""
    assert tables.outlines(spark, DATA).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_envelopes_of_many_rings():
    rings = [*stars(300), np.array([(1.0, 2.0)]), np.array([(1.0, 2.0), (1.0, 2.0)]), np.array([(0.0, 0.0), (1.0, 1.0), (3.0, 3.0)])]
    found = polygons.envelopes(*flat(rings))
    for r, e in zip(rings[:300], found):
        assert polygons._shoelace(e) == pytest.approx(polygons._shoelace(polygons.envelope(r)))
    assert (found[300:302] == (1, 2)).all() and polygons._shoelace(found[302]) == pytest.approx(0)


def test_far_corners_of_many_rings():
    rings = [*stars(300), np.array([(1.0, 2.0)])]
    corner, far = polygons.far_corners(*flat(rings))
    for r, k, d in zip(rings, corner, far):
        want = polygons.extrema(r, r.mean(0)[None, :], 2)
        assert k[: len(want)].tolist() == [c for c, _ in want] and d[: len(want)] == pytest.approx([x for _, x in want])
    assert corner[-1].tolist() == [0, -1]


def test_boxes_stand_on_levels_where_others_are(spark):
    """A small box is of no use on its own level where all others are on a coarser one."""
    box = lambda k, n: (k, (0.01 * k, 0.0, 0.01 * k + n, n))
    schema = "id int, wide struct<minx: double, miny: double, maxx: double, maxy: double>"
    small, large = (spark.createDataFrame([box(k, n) for k in range(9)], schema).withColumn("level", polygons._level(F.col("wide"))) for n in (0.02, 0.09))
    assert {r.at for r in polygons._celled(small, large).select("cell.at").collect()} == {1}


def test_places_that_share_a_spot_are_one_row_until_their_distance_is_known(spark):
    a = spark.createDataFrame([(k, 10 + k % 3 * 0.01, 50.0) for k in range(30)], "id long, lon double, lat double")
    b = spark.createDataFrame([(k, 10 + k % 2 * 0.01, 50.0) for k in range(2500)], "id long, lon double, lat double")
    near = cells.near_places(a, b, 1000.0, 0.04)
    got = near.select("a_id", "b_id").collect()
    assert len(got) == len(set(got)) and set(got) == {(i, j) for i in range(30) for j in range(2500) if abs(i % 3 - j % 2) <= 1}
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan


def test_structures_at_one_spot_count_once(spark):
    """Of many structures at one place none multiplies the detections around it."""
    d = spark.createDataFrame([(k, 5.0002 + k % 10 * 1e-5, 50.0002, 40.0, 0.001, 0.999) for k in range(50)] + [(99, 5.01, 50.01, 40.0, 0.001, 0.999)], "id long, lon double, lat double, length_m double, match_score double, presence double")
    s = spark.createDataFrame([(k, 5.0 + (k % 2) * 5, 50.0, 1) for k in range(400)], "structure long, lon double, lat double, confidence int")
    found = views.dark_detections(d, s)
    assert [r.id for r in found.collect()] == [99]
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_outlines_beside_a_shape_are_neither_met_nor_held(spark):
    f = filters.Filter(["id", "ring"], ring="ring")
    square = lambda x, y: [{"x": x + i, "y": y + j} for i, j in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))]
    rows = spark.createDataFrame([(1, square(0.5, 0.5)), (2, square(9.0, 0.0)), (3, square(-1.0, 0.0)), (4, None), (6, square(-5.0, -5.0))], "id int, ring array<struct<x: double, y: double>>")
    meets, within = (f.column(f"S_{op}(ring, POLYGON((0 0, 3 0, 3 3, 0 3, 0 0)))", spark) for op in ("INTERSECTS", "WITHIN"))
    got = {r.id: (r.m, r.w) for r in rows.select("id", meets.alias("m"), within.alias("w")).collect()}
    assert got[1] == (True, True) and got[2] == got[6] == (False, False) and got[3] == (True, False)
    assert "forall" in rows.where(meets)._jdf.queryExecution().optimizedPlan().toString()


def test_few_neighbours_are_taken_off_at_once(spark, monkeypatch):
    """The same is left as where what is common to each pair is put together first."""
    monkeypatch.setattr(overlays, "dissolved", lambda *a: pytest.fail("few neighbours need no rounds"))
    once = {r.id: r.area for r in overlays.unmasked_outlines(spark, DATA).collect()}
    monkeypatch.undo()
    monkeypatch.setattr(overlays, "FEW_CORNERS", 0)
    assert once == pytest.approx({r.id: r.area for r in overlays.unmasked_outlines(spark, DATA).collect()}, abs=0.002)


def test_window_starts_are_those_of_a_search():
    from tidewatch.llm import repeats

    r = np.random.default_rng(1)
    for _ in range(50):
        off = np.concatenate([[0], np.cumsum(r.choice([0, 1, 199, 200, 201, 400], 9))])
        s = np.arange(max(0, off[-1] - 199))
        row = np.searchsorted(off, s, "right") - 1
        ok = s + 200 <= off[row + 1]
        got = repeats._window_starts(off, 200)
        assert got[0].tolist() == s[ok].tolist() and got[1].tolist() == row[ok].tolist()


def test_lone_outlines_take_no_part_in_rounds(spark, monkeypatch):
    """What has no neighbour is neither a vertex of the graph nor dissolved."""
    seen, ends = [], []
    once, linked = polygons.dissolved, polygons.components
    monkeypatch.setattr(polygons, "dissolved", lambda rows, by: seen.append(rows.groupBy("component").count().where("count = 1").count()) or once(rows, by))
    monkeypatch.setattr(polygons, "components", lambda v, e: ends.append(v.count()) or linked(v, e))
    rows = polygons.stitched_groups(spark, DATA)
    several = rows.where("parts > 1").agg(F.sum("parts")).first()[0]
    assert seen == [0] and ends == [several] and rows.where("parts = 1").count() > 0


def test_lineage_takes_few_rounds_and_no_task_gets_a_crowd(spark, monkeypatch):
    """A chain of 40 steps is doubled six times; rows of the ids that most starts reach go to all tasks."""
    rounds = []
    once = graph.met
    monkeypatch.setattr(graph, "met", lambda *a: rounds.append(1) or once(*a))
    chain = spark.range(1, 41).select("id", (F.col("id") - 1).alias("pre"))
    got = graph.lineage(spark.range(41), chain)
    assert {(r.start, r.id): r.paths for r in got.collect()} == {(i, j): 1 for i in range(41) for j in range(i + 1)}
    assert len(rounds) == 12
    monkeypatch.undo()
    monkeypatch.setattr(graph, "CROWDED", 5)
    rows = spark.createDataFrame([(k, 0 if k % 2 else k) for k in range(2, 60)], "k long, id long")
    both = graph.met(rows, spark.createDataFrame([(k, f"r{k}") for k in range(50)], "id long, text string"), "id")
    assert sorted((r.k, r.id, r.text) for r in both.collect()) == [(k, i, f"r{i}") for k in range(2, 60) for i in [0 if k % 2 else k] if i < 50]
    assert "Broadcast" in both._jdf.queryExecution().executedPlan().toString()
