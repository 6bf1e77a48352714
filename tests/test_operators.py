"""Every query of the operators against its SQL, and the operators on small cases with known answers."""

import glob
import math
import json
import os
import struct
import zipfile

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import geometry as geo
from tidewatch.operators import centerline, graph, polygons, ranking, surface, trajectory, tuning, workflow
from tidewatch.plans import registry
from tidewatch.sources import readers

DATA = "/root/testdata/sf0.001"
NAMES = sorted(n for m in registry.MODULES for n in m.QUERIES)
#: Held against brute force below, as they have no SQL.
NO_SQL = {"slick_centerlines", "slick_ends", "track_scores", "suppressed_outlines", "simplified_outlines", "suppressed_masks", "coordinate_ascent"}


def plain(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, float):
        return f"{value + 0.0:.9g}"
    return str(value)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    got = registry.queries()[name](spark, DATA)
    found = got.collect()
    assert found
    if name in NO_SQL:
        return
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = c.execute(registry.oracles()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, found) == rows(names, want.fetchall())


def test_all_have_sql_or_brute_force():
    assert NO_SQL == {n for n in NAMES if n not in registry.oracles()}


def square(x0, y0, x1, y1):
    return [{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]


def test_suppression_keeps_three_two_three():
    """Boxes in a row, the third over both others by an eighth; one has no shape."""
    scene = pd.DataFrame({"ord": [0, 1, 2, 3], "ring": [square(0, 0, 10, 10), square(10, 10, 20, 20), square(5, 5, 15, 15), None], "confidence": [0.95, 0.9, 0.85, 0.99], "cls": [1, 1, 2, 1]})
    for most, n in ((0.5, 3), (0.1, 2), (0.9, 3)):
        got = polygons.suppressed(scene, most, 1, False)
        assert len(got) == n and got["overlaps"].tolist() == [2, 2, 2][:n]
    assert len(polygons.suppressed(scene, 0.1, 1, True)) == 3 and len(polygons.suppressed(scene, 0.1, 3, False)) == 0
    inside = pd.DataFrame({"ord": [0, 1], "ring": [square(0, 0, 10, 10), square(1, 1, 3, 3)], "confidence": [0.1, 0.9], "cls": [1, 1]})
    assert polygons.suppressed(inside, 0.5, 0, False)["ord"].tolist() == [0]


def test_overlap_area_equals_sampling():
    r = np.random.default_rng(1)
    for _ in range(20):
        a, b = (np.stack([np.cos(t), np.sin(t)], 1) * r.uniform(0.4, 1, 7)[:, None] + r.uniform(-0.3, 0.3, 2) for t in (np.sort(r.uniform(0, 2 * np.pi, 7)) for _ in range(2)))
        p = r.uniform(-1.5, 1.5, (20000, 2))
        inside = lambda ring: sum(((s[1] > p[:, 1]) != (e[1] > p[:, 1])) & (p[:, 0] < s[0] + (e[0] - s[0]) * (p[:, 1] - s[1]) / (e[1] - s[1] + 1e-300)) for s, e in zip(ring, np.roll(ring, -1, 0), strict=True)) % 2 == 1
        assert abs(polygons.overlap_area(a, b) - 9 * (inside(a) & inside(b)).mean()) < 0.06
        assert polygons.meet(a, b) == (polygons.overlap_area(a, b) > 0)


def test_suppressed_outlines_by_definition(spark):
    """Each scene's outcome again, by the definition over all pairs."""
    o = polygons.tables.outlines(spark, DATA).where("id < 300").toPandas()
    got = {r.id for r in polygons.suppressed_outlines(spark, DATA).where("id < 300").collect()}
    ring = {r.id: np.array([(p["x"], p["y"]) for p in r.ring]) for r in o.itertuples()}
    conf, stay = dict(zip(o.id, o.confidence, strict=True)), set(o.id)
    for i in sorted(ring):
        for j in sorted(ring):
            if i < j and i // 50 == j // 50 and i in stay and j in stay:
                both = polygons.overlap_area(ring[i], ring[j])
                si, sj = (polygons._shoelace(ring[k]) for k in (i, j))
                if both / (si + sj - both) > 0.1:
                    stay.discard(i if conf[i] <= conf[j] else j)
                elif both > si / 2:
                    stay.discard(i)
                elif both > sj / 2:
                    stay.discard(j)
    assert got == stay and len(stay) < 300


def test_simplified_stays_within_tolerance():
    r = np.random.default_rng(2)
    line = np.cumsum(r.normal(0, 1, (200, 2)), 0)
    short = polygons.simplified(line, 2.0)
    assert 2 < len(short) < 200 and (short[0] == line[0]).all() and (short[-1] == line[-1]).all()

    def far(p):
        out = []
        for s, e in zip(short, short[1:], strict=False):
            u = np.clip((p - s) @ (e - s) / ((e - s) @ (e - s)), 0, 1)
            out.append(np.hypot(*(p - s - u * (e - s))))
        return min(out)

    assert max(map(far, line)) <= 2.0
    assert len(polygons.simplified(line, 1e9)) == 2 and len(polygons.simplified(line, 0.0)) == 200


def test_envelope_and_frechet():
    e = polygons.envelope(np.array([(0, 0), (4, 4), (3, 5), (-1, 1), (1, 2)], float))
    sides = np.hypot(*(np.roll(e, -1, 0) - e).T)
    assert np.allclose(sorted(sides), sorted([32**0.5, 2**0.5] * 2))
    a, b = np.array([(0, 0), (1, 0), (2, 0)], float), np.array([(0, 1), (1, 3), (2, 1)], float)
    assert polygons.frechet(a, b) == 3.0 and polygons.frechet(a, a) == 0.0
    assert polygons.extrema(np.array([(0, 0), (9, 0), (0, 5)], float), np.array([(0.0, 0.0)]), 2) == [(1, 9.0), (2, 5.0)]


def rectangle(x, y, w, h):
    return np.array([(x, y), (x + w, y), (x + w, y + h), (x, y + h)], float)


def test_centerlines_of_rectangles():
    """The line runs along the longer side and into a corner at each end, as the exact skeleton does; gaps are closed, small parts left out."""
    (line, area), = centerline.centerlines([rectangle(0, 0, 400, 50)], 10)
    length = np.hypot(*np.diff(line, axis=0).T).sum()
    assert abs(length - (350 + 2 * math.hypot(25, 25))) < 5 and abs(area - 20000) < 20 and np.ptp(line[:, 1]) <= 50
    assert len(centerline.centerlines([rectangle(0, 0, 400, 50), rectangle(440, 0, 400, 50)], 40)) == 1 and len(centerline.centerlines([rectangle(0, 0, 400, 50), rectangle(440, 0, 400, 50)], 5)) == 2
    assert len(centerline.centerlines([rectangle(0, 0, 400, 50), rectangle(900, 0, 10, 10)], 5)) == 1
    long, wide = (centerline.aspect_ratio_factor(centerline.centerlines([r], 5)) for r in (rectangle(0, 0, 1000, 20), rectangle(0, 0, 100, 100)))
    assert long > 0.9 > 0.1 > wide


def test_morphology_by_definition():
    r = np.random.default_rng(7)
    m = np.zeros((24, 30), bool)
    m[6:18, 6:24] = r.random((12, 18)) < 0.15
    at = np.argwhere(m)
    y, x = np.mgrid[:24, :30]
    want = (((y[..., None] - at[:, 0]) ** 2 + (x[..., None] - at[:, 1]) ** 2) <= 9).any(-1)
    assert (centerline.grown(m, 3) == want).all()
    assert (centerline.closed(m, 3) >= m).all() and (centerline.opened(want, 3) <= want).all()
    parts = centerline.labels(want)
    assert ((parts > 0) == want).all() and centerline.labels(centerline.thinned(want)).max() == parts.max()


def test_longest_path_equals_brute_force():
    r = np.random.default_rng(8)
    for _ in range(20):
        n = 25
        graph = {i: {} for i in range(n)}
        for i in range(1, n):
            if i != 12:  # two trees
                j = int(r.integers(12, i)) if i > 12 else int(r.integers(i))
                graph[i][j] = graph[j][i] = float(r.uniform(1, 5))
        d = np.full((n, n), np.inf)
        for i in graph:
            d[i, i] = 0
            for j, w in graph[i].items():
                d[i, j] = w
        for k in range(n):
            d = np.minimum(d, d[:, k, None] + d[None, k])
        path = centerline.longest_path(graph)
        assert np.isclose(sum(graph[a][b] for a, b in zip(path, path[1:], strict=False)), d[np.isfinite(d)].max())


def walk(d, start, confirm):
    """The walk as it is told: on while nearer, or while one of the next few is not farther than the best."""
    best, at = d[start], start
    step = -1 if start and d[start - 1] < best else 1
    while 0 <= at + step < len(d):
        at += step
        if d[at] < best:
            best = d[at]
        elif all(d[k] > best for k in (at + i * step for i in range(1, confirm + 1)) if 0 <= k < len(d)):
            return at, best
    return at, best


def test_turning_point_equals_walk():
    r = np.random.default_rng(3)
    for _ in range(300):
        d = np.abs(np.cumsum(r.normal(0, 1, int(r.integers(1, 60)))) + r.normal(0, 3))
        s = int(r.integers(len(d)))
        assert trajectory.turning_point(d, s, 4) == walk(d, s, 4)


def test_tracks_of_odd_vessels(spark):
    """One ping; pings without course; two at one time; nothing in the window."""
    h, at = trajectory.HOUR, trajectory.IMAGE
    pings = [(1, 1, at - h, 5.0, 6.0, 10.0, 90.0), (2, 2, at - 2 * h, 0.0, 0.0, None, None), (2, 3, at - h, 3600.0, 0.0, 5.0, None), (2, 4, at, 3600.0, 7200.0, None, None), (3, 5, at - h, 0.0, 0.0, 1.0, 0.0), (3, 6, at - h, 9.0, 9.0, 1.0, 0.0), (3, 7, at, 9.0, 1861.0, 1.0, 0.0), (4, 8, at - 20 * h, 0.0, 0.0, 1.0, 0.0)]
    got = trajectory.tracks(spark.createDataFrame(pings, "ssvid long, id long, t long, x double, y double, speed double, course double")).collect()
    by = {v: sorted((r.t - at, r.x, r.y, r.extrapolated, r.shown) for r in got if r.ssvid == v) for v in (1, 2, 3, 4)}
    assert by[1] == [(-8 * h, 5.0, 6.0, True, True), (-h, 5.0, 6.0, True, True), (6 * h, 5.0, 6.0, True, False)] and not by[4]
    two = {t: (x, y, e) for t, x, y, e, _ in by[2]}
    assert two[-2 * h] == (0.0, 0.0, True) and two[-8 * h] == (-6 * 3600.0, 0.0, True) and two[-h][2] is False
    assert np.allclose(two[h][:2], (3600, 14400)) and max(two) == h and len(two) == 541
    three = {t: (x, y) for t, x, y, _, _ in by[3]}
    assert np.allclose(three[0], (9, 1861)) and all(np.isfinite(v).all() for v in three.values())


def test_slick_ends_by_definition(spark):
    track = trajectory.tracks(trajectory.tables.pings(spark, DATA))
    points = {}
    for r in track.collect():
        points.setdefault(r.ssvid, []).append((r.t, r.x, r.y))
    lines = trajectory._lines(spark, DATA)
    got = {(r.ssvid, r.line): r for r in trajectory.ends_on_track(track, lines).collect()}
    assert len(got) == lines.count()
    for r in lines.collect():
        p = np.array(sorted(points[r.ssvid]))
        d = [np.hypot(p[:, 1] - x, p[:, 2] - y) for x, y in ((r.ax, r.ay), (r.bx, r.by))]
        start = int(np.abs(p[:, 0] - trajectory.IMAGE).argmin())
        ends = [walk(x, start, 10) for x in d]
        head = 0 if p[ends[0][0], 0] > p[ends[1][0], 0] else 1
        g = got[r.ssvid, r.line]
        assert (g.head, g.t_head, g.t_tail) == (head, p[ends[head][0], 0], p[d[1 - head].argmin(), 0])
        assert np.isclose(g.d_head, ends[head][1]) and np.isclose(g.d_tail, d[1 - head].min()) and np.isclose(g.d_image, d[head][start])


def test_components_equal_brute_force(spark):
    r = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)]
    up = {i: i for i in range(450)}
    for _ in range(450):
        before = dict(up)
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
        if up == before:
            break
    got = graph.components(spark.range(450), spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x.id: x.component for x in got} == up
    assert graph.components(spark.range(3), spark.createDataFrame([], "a long, b long")).count() == 3


def test_numbers_follow_the_order(spark):
    d = spark.range(500).select((F.col("id") * 37 % 500).alias("v"), (F.col("id") % 3).alias("w"))
    got = ranking.numbered(d, [F.desc("w"), F.asc("v")], "n", 7).collect()
    assert [(r.w, r.v) for r in sorted(got, key=lambda r: r.n)] == sorted(((r.w, r.v) for r in got), key=lambda x: (-x[0], x[1])) and sorted(r.n for r in got) == list(range(1, 501))


def test_masks_stay_by_definition(spark):
    from tidewatch.operators import raster

    m = raster._masks(spark, DATA).toPandas()
    m = m[(m.score > 0.1) & (m["mask"].map(max) > 0.7)]
    want = set()
    for _, g in m.groupby(["scene", "cls"]):
        stays = []
        for r in sorted(g.itertuples(), key=lambda r: (-r.score, r.id)):
            u = np.array(r.mask)
            if all(2 * np.sqrt(u * v).sum() / (u + v).sum() <= 0.945 for v in stays):
                stays.append(u)
                want.add(r.id)
    assert {r.id for r in raster.suppressed_masks(spark, DATA).collect()} == want and 0 < len(want) < len(m)


def test_ascent_ends_on_the_ridge():
    seen = []
    value = lambda p: seen.append(p) or -abs(p["a"] - 3) - abs(p["b"] + 1)
    assert tuning.ascend(value, {"a": 0, "b": 0}, {"a": [1, 3, 5], "b": [-1, 1]}) == ({"a": 3, "b": -1}, 0)


def test_classifier_needs_all_features(spark):
    r = np.random.default_rng(5)
    data = [(*map(float, x), float(x[0] > 0.5)) for x in r.random((200, 8))]
    d = spark.createDataFrame(data, ", ".join(f"{c} double" for c in (*surface.FEATURES, "label")))
    got = surface.classified(d, d).select("slick_confidence", "label").collect()
    assert all(0 <= x.slick_confidence <= 1 for x in got) and np.mean([(x.slick_confidence > 0.5) == x.label for x in got]) > 0.9
    with pytest.raises(ValueError, match="fill_factor"):
        surface.classified(d, d.withColumn("fill_factor", F.lit(None).cast("double")))


def test_surface(spark):
    d = spark.createDataFrame([(1, 10.0, 50.0, "2024-01-01", "Ab"), (2, 20.0, 40.0, "2024-02-01", None), (3, 15.0, 45.0, "2024-03-01", "ab GT")], "id long, lon double, lat double, ts string, name string").withColumn("ts", F.col("ts").cast("timestamp"))
    ids = lambda **q: [r.id for r in surface.items(d, sortby="id", **q)[0].collect()]
    assert ids(bbox="21,39,14,46") == [2, 3] and ids(datetime="2024-02-01T00:00:00Z/..") == [2, 3] and ids(datetime="../2024-01-15") == [1] and ids(datetime="2024-03-01") == [3]
    assert ids(filter="id GT 1 AND name = 'ab GT'") == [3] and ids(filter="LOWER(name) LIKE 'a%' OR name IS NULL", limit=2, offset=1) == [2, 3] and ids(id=2) == [2]
    assert surface.items(d, limit=2, offset=2)[1].first() == (3, 1)
    for bad in ({"limit": 50_001}, {"offset": -1}, {"nothing": 1}):
        with pytest.raises(ValueError):
            surface.items(d, **bad)
    assert surface.restricted('["a", "b"]') == surface.restricted("a,b") == ["a", "b"] and surface.restricted(None) == []
    assert surface.collection("a", ["a"], "k", "k") == "a" and surface.collection("c", ["a"], None, "k") == "c"
    with pytest.raises(PermissionError):
        surface.collection("a", ["a"], None, "k")
    assert len(surface.analyzers(None)) == 4 and surface.analyzers([]) == [] and surface.analyzers(["DARK"]) == ["DARK"] and surface.queued_flags([]) is None
    with pytest.raises(ValueError, match="X"):
        surface.analyzers(["X"])


def test_changes_of_tables(spark):
    t = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "id long, name string, n long")
    with pytest.raises(AttributeError, match="size"):
        workflow.updated(t, "id", 1, size=3)
    assert workflow.updated(t, "id", 1, n=3).where("id = 1").first().n == 3
    log = spark.createDataFrame([], "id long, trigger_type string, scene_count long, filtered_scene_count long, trigger_logs string")
    log, first = workflow.audit(log, "SNS_TOPIC", 3, 1)
    log, second = workflow.audit(log, "HISTORICAL_RUN", 2, 2, "u")
    assert (first, second, log.count()) == (1, 2, 2)
    with pytest.raises(ValueError):
        workflow.audit(log, "OTHER", 1, 1)


def test_geojson_and_masks(spark, tmp_path):
    ring = [[0, 0], [0, 2], [2, 2], [2, 0], [0, 0]]
    features = [{"type": "Feature", "properties": {"GEONAME": "A", "SOVEREIGN1": "x", "SOVEREIGN2": None, "SOVEREIGN3": "y"}, "geometry": {"type": "Polygon", "coordinates": [ring, [[0.5, 0.5], [1, 1], [1, 0.5], [0.5, 0.5]]]}},
                {"type": "Feature", "properties": {"GEONAME": "B"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}}, {"type": "Feature", "properties": {"GEONAME": "C"}, "geometry": None}]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = {r.name: r for r in readers.areas(spark, str(tmp_path / "a.geojson")).collect()}
    assert set(got) == {"A", "B"} and got["A"].sovereigns == ["x", "y"] and len(got["A"].rings) == 1 and len(got["A"].rings[0]) == 4 and [len(r) for r in got["B"].rings] == [4, 3]
    m = readers.mask_ring(spark, str(tmp_path / "a.geojson")).select(geo.planar_area(F.col("ring")).alias("a")).first()
    assert m.a == 4.0
    out = spark.createDataFrame([(1, [square(0, 0, 1, 1)])], f"id long, rings {readers.RINGS}")
    readers.write_geojson(out, str(tmp_path / "out"))
    back = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    assert back["properties"] == {"id": 1} and back["geometry"]["coordinates"] == [[[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]]


def shp(polys):
    body = b""
    for n, rings in enumerate(polys):
        flat = [p for r in rings for p in r]
        starts = np.cumsum([0, *[len(r) for r in rings]])[:-1]
        content = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(flat)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in flat) if rings else struct.pack("<i", 0)
        body += struct.pack(">2i", n + 1, len(content) // 2) + content
    return struct.pack(">i", 9994) + b"\0" * 20 + struct.pack(">i", (100 + len(body)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + body


def test_shapefiles(spark, tmp_path):
    ring = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (0.0, 0.0)]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/a.shp", shp([[ring], [], [ring, ring]]))
        z.writestr("x/a.dbf", b"")
    got = readers.shapefile(spark, str(tmp_path / "a.zip")).orderBy("shape").collect()
    assert [[len(r) for r in x.rings] for x in got] == [[3], [], [3, 3]]
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("readme", b"")
    with pytest.raises(Exception, match="not one"):
        readers.shapefile(spark, str(tmp_path / "b.zip")).collect()


def test_other_sources(spark, tmp_path):
    (tmp_path / "v.csv").write_text('# words\n# locale:{"code": "es", "fallback": "en"}\nentity,locale,name\n1,es,"uno, dos"\n# skipped\n2,es,\n')
    d, locales = readers.commented_csv(spark, str(tmp_path / "v.csv"), ["entity", "locale", "name"])
    assert [tuple(r) for r in d.orderBy("entity").collect()] == [("1", "es", "uno, dos"), ("2", "es", None)] and locales == [{"code": "es", "fallback": "en"}]
    with pytest.raises(ValueError):
        readers.commented_csv(spark, str(tmp_path / "v.csv"), ["entity", "name"])
    got = readers.paged(spark, lambda first, n: [{"id": i} for i in range(first, min(first + n, 57))], 57, "id long").collect()
    assert sorted(r.id for r in got) == list(range(57))
    tiles = spark.createDataFrame([(json.dumps([{"properties": {"structure_id": "7", "lat": 1.0, "lon": 2.0, "label": "oil", "structure_start_date": "1700000000000", "structure_end_date": ""}}, {"properties": {"structure_id": "", "structure_start_date": ""}}]),)], "features string")
    t = readers.tile_features(tiles, F.lit("2024-03-09 10:00:00").cast("timestamp")).orderBy("lat").collect()
    assert [str(x.structure_end_date) for x in t] == ["2024-03-01 00:00:00"] * 2 and t[0].structure_id is None and t[1].structure_id == 7 and t[0].structure_start_date is None
    s = spark.range(1).select(F.lit("S1A_IW_GRDH_1SDV_20240102T030405_x").alias("s"))
    one = s.select(readers.product_path(F.col("s")), readers.tile_address(F.lit("http://t"), F.col("s"), F.lit(9), F.lit(1), F.lit(2), 2), readers.aux_year(F.lit("2024-01-01").cast("timestamp"), 2022), readers.box_address(F.lit("http://t"), F.col("s"), [F.lit(1), F.lit(2), F.lit(3), F.lit(4)], 5, 6)).first()
    assert one[0].startswith("GRD/2024/1/2/IW/DV/S1A_IW") and one[1] == "http://t/tiles/WorldCRS84Quad/9/1/2@2x?sceneid=S1A_IW_GRDH_1SDV_20240102T030405_x&bands=vv" and one[2] == 2019 and "/crop/1,2,3,4/5x6.png" in one[3]
    readers.write_csv(d, str(tmp_path / "c"))
    readers.write_log(d, str(tmp_path / "l"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2 and json.loads(spark.read.text(str(tmp_path / "l")).orderBy("value").first().value)["entity"] == "1"
