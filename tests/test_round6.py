"""Scenes of several blocks of tiles against brute force, and how much is run for them; places in zones by batches; migrations by bounded partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import overlay as ov
from tidewatch.functions import projections as pj
from tidewatch.operators import instances, migration, reprojection
from tidewatch.plans import tables

TILE = "scene long, row long, col long, tile long, values array<double>"


def jobs_of(spark, name, run):
    """What run() gives, and how many jobs it took."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def tiles_of(spark, scenes):
    rows, tile = [], 0
    for k, v in scenes.items():
        for r in range(v.shape[0] // 8):
            for c in range(v.shape[1] // 8):
                rows.append((k, r, c, tile, v[r * 8 : r * 8 + 8, c * 8 : c * 8 + 8].ravel().tolist()))
                tile += 1
    return spark.createDataFrame(rows, TILE)


def connected(on):
    """Lists of cells (y, x) that sides connect."""
    left, out = set(map(tuple, np.argwhere(on).tolist())), []
    while left:
        todo, part = [left.pop()], []
        while todo:
            y, x = todo.pop()
            part.append((y, x))
            for q in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if q in left:
                    left.remove(q)
                    todo.append(q)
        out.append(part)
    return out


def arrays(polygon):
    return [np.array([(p.x, p.y) for p in ring]) for ring in polygon]


def painted(polygon, shape):
    """The cells in a polygon, by a ray from the middle of each."""
    rings, (y, x) = arrays(polygon), np.mgrid[0 : shape[0], 0 : shape[1]] + 0.5
    on = np.zeros(shape, int)
    for r in rings:
        for p, q in zip(r, np.roll(r, -1, 0), strict=True):
            on += ((p[1] > y) != (q[1] > y)) & (x < p[0])
    return on % 2 == 1


@pytest.fixture(scope="module")
def scenes():
    rng = np.random.default_rng(7)
    many = rng.random((72, 136))
    many[rng.random(many.shape) < 0.04] = 0.0
    few = np.zeros((80, 72))
    few[3:75, 3:70] = 0.6  # over four blocks, with a hole over their corner and holes that meet at a corner
    few[60:66, 62:67] = 0.3
    few[20:22, 20:22] = few[22:24, 22:24] = 0.01
    few[40, 40] = 0.99
    return {4: many, 9: few}


def test_instances_over_blocks_are_those_of_the_scene(spark, scenes):
    tiles = tiles_of(spark, scenes)
    number = {}
    for r in tiles.drop("values").collect():
        for k in range(64):
            number[r.scene, r.row * 8 + k // 8, r.col * 8 + k % 8] = r.tile * 64 + k
    want = {}
    for scene, v in scenes.items():
        for cells in connected(v >= 0.4):
            kept = [c for c in cells if v[c] >= 0.5]
            if kept and max(v[c] for c in cells) >= 0.97:
                want[scene, min(number[scene, *c] for c in cells)] = kept
    got = instances.scene_instances(tiles, 0.4, 0.5, 0.97).collect()
    assert {(r.scene, r.instance) for r in got} == set(want) and len(got) == len(want) > 20
    for r in got:
        v, kept = scenes[r.scene], want[r.scene, r.instance]
        values = [v[c] for c in kept]
        assert (r.n, r.best) == (len(kept), max(values)) and r.mean == pytest.approx(np.mean(values)) and r.median == pytest.approx(np.median(np.round(values, 6)))
        mask = np.zeros(v.shape, bool)
        mask[tuple(zip(*kept, strict=True))] = True
        parts = [painted(p, v.shape) for p in r.shape]
        assert sorted(sorted(map(tuple, np.argwhere(p).tolist())) for p in parts) == sorted(map(sorted, connected(mask)))
        for p in map(arrays, r.shape):
            assert ov.signed_area(p[0]) > 0 and all(ov.signed_area(h) < 0 for h in p[1:]) and all(len(set(map(tuple, h.tolist()))) == len(h) for h in p)


@pytest.mark.parametrize("distance", [0.4, 1.5, 9.2])
def test_polygons_by_gaps_go_as_shapes_say(spark, scenes, distance):
    """What of a polygon lies near a gap, by its cells against the whole polygon and the gaps' buffer."""
    rng = np.random.default_rng(3)
    v = np.where(rng.random((24, 24)) < 0.55, 0.2, 0.9)
    v[rng.random(v.shape) < (0.03 if distance < 5 else 0.002)] = 0.0
    v[:5, 20:] = 0.0
    tiles = tiles_of(spark, {1: v})
    found = instances.scene_instances(tiles, 0.5, 0.5, 0.5)
    near = ov.buffered(instances.contours(v == 0), distance)
    want = {}
    for r in found.collect():
        kept = [p for p in map(arrays, r.shape) if ov.area(ov.differences([[p]], [near])[0]) >= 0.5 * ov.area([p]) - 1e-4]
        if kept:
            want[r.instance] = sorted(ov.area([p]) for p in kept)
    got = instances.away_from_gaps(found, tiles, distance).collect()
    assert {r.instance: sorted(ov.area([arrays(p)]) for p in r.shape) for r in got} == want and want and (distance < 1 or len(want) < found.count())


def test_scenes_are_no_globes(spark):
    """A polygon 360 cells from a gap isn't near it; and what isn't over a block's border takes no rounds."""
    v = np.full((8, 376), 0.2)
    v[:, :4] = 0.0
    v[2:5, 361:364] = 0.9
    tiles = tiles_of(spark, {1: v})
    got, jobs = jobs_of(spark, "no globes", lambda: instances.away_from_gaps(instances.scene_instances(tiles, 0.5, 0.5, 0.5), tiles, 1.5).collect())
    assert [r.n for r in got] == [9] and jobs <= 30


def test_places_in_zones_by_batches_are_the_columns(spark):
    """Corners all over the earth, over the 180th meridian and beyond the zones, by batches and by column expressions; whole rings at a time."""
    rng = np.random.default_rng(5)
    rings = [(i, [(float(x), float(y)) for x, y in zip(rng.uniform(-180, 180, n), rng.uniform(-82, 86, n), strict=True)]) for i, n in enumerate((7, 0, 40, 1, 500))]
    rings += [(9, None), (10, [(0.0, 0.0), (3.0, 0.0), (179.999, 60.0), (-180.0, -80.0), (6.0, 84.0), (6.0, 84.001)])]
    rows = spark.createDataFrame(rings, "id long, ring array<struct<x: double, y: double>>").coalesce(1)
    place = F.col("p")
    want = rows.select("id", F.posexplode("ring").alias("k", "p")).withColumn("epsg", pj.zone(F.col("p.x"), F.col("p.y")))
    want = want.withColumn("own", pj.to_zone(place, F.col("epsg"))).withColumn("east", pj.to_zone(place, F.col("epsg") + 1)).select("id", "k", "epsg", "own.x", "own.y", F.col("east.x").alias("east_x"), F.col("east.y").alias("east_y")).collect()
    got = {(r.id, r.k): r for r in reprojection.corners_in_zones(rows).collect()}
    assert len(got) == len(want) == 554 and {r.epsg for r in want} == {r.epsg for r in got.values()}
    for r in want:
        other = got[r.id, r.k]
        assert (other.epsg, other.off_mm) == (r.epsg, None if r.epsg is None else 0)
        for c in ("x", "y", "east_x", "east_y"):
            assert other[c] == (None if r.epsg is None else pytest.approx(r[c], abs=1e-7))


def test_zone_places_is_made_by_batches(spark):
    """No corner is projected as a row of its own in the plan."""
    plan = reprojection.zone_places(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "atanh" not in plan.lower() and "generate" not in plan.lower()


def test_shuffles_grow_with_rows(spark, monkeypatch):
    """Partitions for a table's rows, and the session's own number afterwards, also after an error."""
    monkeypatch.setattr(tables, "ROWS", 100)
    own = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError), tables.shuffled_for(spark, 1001):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "11" == str(tables.parts_for(spark, 1))
        raise ZeroDivisionError
    assert spark.conf.get("spark.sql.shuffle.partitions") == own and tables.parts_for(spark, 5) == int(own)


def test_migrations_shuffle_to_partitions_for_their_links(spark, monkeypatch):
    """No task gets more of the links the more there are: the largest shuffle has a partition for each ROWS of them, and results are the same."""
    sf = "/root/testdata/sf0.001"
    rows = lambda: sorted(map(tuple, migration.migration_links(spark, sf).collect()), key=str)
    want = rows()
    monkeypatch.setattr(tables, "ROWS", 500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("migration", "migration")
    try:
        assert rows() == want
        status = spark.sparkContext.statusTracker()
        stages = {k for j in status.getJobIdsForGroup("migration") for k in status.getJobInfo(j).stageIds}
        assert max(i.numTasks for i in map(status.getStageInfo, stages) if i) >= len(want) // 500
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
