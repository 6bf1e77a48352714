"""The relational catalogue: views, table functions, workflows and evaluation as declarative plans.

Each query is one SQL text over domain views (detections, sources, links, reviews, vessel pings ...) that are mapped from the
base tables; Spark gets it through `spark.sql`, and the oracle gets the same relational text, with `$name(...)` macros for
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Class ids, names and their parents.
CLASSES = """VALUES (1, 'NOT_OIL', CAST(NULL AS INT)), (2, 'ANTHRO', NULL), (3, 'NATURAL', NULL), (4, 'INFRA', 2), (5, 'VESSEL', 2),
    (6, 'OLD_VESSEL', 5), (7, 'REC_VESSEL', 5), (8, 'COIN_VESSEL', 7), (9, 'AMBIGUOUS', NULL), (10, 'LAND', 1), (11, 'SEA_ICE', 1), (12, 'ARTEFACT', 1)"""
# Mean and deviation of verified scores by source type (vessel, infrastructure, dark vessel).
COLLATION = "VALUES (1, 0.896764674670854e0, 0.19957953396172073e0), (2, 0.37974683544303794e0, 0.18987341772151897e0), (3, 0.6329113924050633e0, 0.2911392405063291e0)"

#: Domain views by name; each may use the base tables and those before it.
VIEWS = {
    "cls": f"SELECT id, short_name, supercls FROM ({CLASSES}) AS c(id, short_name, supercls)",
    "type_moments": f"SELECT type, mu, sd FROM ({COLLATION}) AS c(type, mu, sd)",
    "scene": "SELECT n_nationkey AS id, n_name AS scene_id, n_regionkey AS zone FROM nation",
    "run": "SELECT c_custkey AS id, c_nationkey AS scene, c_acctbal >= 0 AS success FROM customer",
    "slick": """SELECT o_orderkey AS id, o_orderdate AS ts, o_totalprice AS area, sqrt(o_totalprice) * 5 AS perimeter, sqrt(o_totalprice) * 2 AS length,
        o_orderstatus <> 'P' AS active, CAST(1 + o_orderkey % 12 AS INT) AS cls, o_custkey AS run, o_totalprice / 600000 AS confidence FROM orders""",
    "source": "SELECT s_suppkey AS id, CAST(s_suppkey AS STRING) AS ext_id, CAST(1 + s_suppkey % 3 AS INT) AS type, s_name AS name FROM supplier",
    "source_type": "SELECT id, name FROM (VALUES (1, 'VESSEL'), (2, 'INFRA'), (3, 'DARK')) AS t(id, name)",
    "link": """SELECT l_orderkey AS slick, l_suppkey AS source, l_linenumber AS link_rank, l_linestatus = 'O' AS active, (l_extendedprice - 38000e0) / 23000e0 AS score,
        CASE l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS hitl, l_shipdate AS ts, l_partkey AS part, l_quantity AS qty, l_discount AS disc, l_extendedprice AS price FROM lineitem""",
    "tag": """SELECT CAST(s_suppkey AS STRING) AS ext_id, CAST(1 + s_suppkey % 3 AS INT) AS type, CAST(4 + s_suppkey % 9 AS INT) AS tag FROM supplier WHERE s_suppkey % 2 = 0
        UNION ALL SELECT CAST(s_suppkey AS STRING), CAST(1 + s_suppkey % 3 AS INT), 20 FROM supplier WHERE s_suppkey % 4 = 0""",
    "review": "SELECT l_orderkey AS slick, CAST(1 + l_partkey % 12 AS INT) AS cls, l_shipdate AS ts, l_partkey AS id, l_suppkey AS reviewer FROM lineitem WHERE l_linenumber = 1",
    "aoi": """SELECT n_nationkey AS id, n_name AS name, CAST(1 + n_nationkey % 3 AS INT) AS type, -100e0 + 40e0 * (n_nationkey % 5) AS minx, -60e0 + 40e0 * (n_nationkey % 5) AS maxx,
        -50e0 + 20e0 * floor(n_nationkey / 5e0) AS miny, -30e0 + 20e0 * floor(n_nationkey / 5e0) AS maxy FROM nation""",
    "place": "SELECT id, -100e0 + (id * 37 % 2000) / 10e0 AS lon, -50e0 + (id * 53 % 1000) / 10e0 AS lat FROM slick",
    "slick_to_aoi": "SELECT p.id AS slick, a.id AS aoi, a.type, a.name FROM place p JOIN aoi a ON p.lon >= a.minx AND p.lon < a.maxx AND p.lat >= a.miny AND p.lat < a.maxy",
    "ping": """SELECT user_id AS ssvid, ts, event_id AS id, 10e0 + (user_id % 20) / 10e0 + (event_id % 977) / 10000e0 AS lon, 40e0 + (user_id % 15) / 10e0 + (event_id % 787) / 10000e0 AS lat,
        value % 30 AS speed, event_id * 36 % 360 * 1e0 AS course, event_type AS kind, value FROM events""",
    # a class and all below it; the only view that recurses
    "not_oil": "SELECT id FROM cls WHERE id = 1 UNION ALL SELECT c.id FROM cls c JOIN not_oil ON c.supercls = not_oil.id",
    "slick_base": "SELECT s.*, power(s.length, 2) / s.area / (4 * pi() * s.area / power(s.perimeter, 2)) AS linearity FROM slick s LEFT ANTI JOIN not_oil n ON s.cls = n.id WHERE s.active",
    "latest_review": "SELECT slick, cls, ts FROM (SELECT *, row_number() OVER (PARTITION BY slick ORDER BY ts DESC, id DESC, reviewer DESC) AS rn FROM review) AS r WHERE rn = 1",
    "slick_plus": """SELECT b.id, b.ts, b.area, b.cls, b.run, sc.scene_id, b.linearity, r.cls AS hitl_cls, c.short_name AS hitl_name, a.eez, a.iho, a.mpa, x.vessels, x.infra, x.dark, x.max_score,
        concat('https://example.org/slicks/', CAST(b.id AS STRING)) AS url
        FROM slick_base b JOIN run ON b.run = run.id JOIN scene sc ON run.scene = sc.id
        LEFT JOIN latest_review r ON r.slick = b.id LEFT JOIN cls c ON c.id = r.cls
        LEFT JOIN (SELECT slick, $agg(aoi, type = 1) AS eez, $agg(aoi, type = 2) AS iho, $agg(aoi, type = 3) AS mpa FROM slick_to_aoi GROUP BY slick) a ON a.slick = b.id
        LEFT JOIN (SELECT l.slick, $agg(s.id, s.type = 1) AS vessels, $agg(s.id, s.type = 2) AS infra, $agg(s.id, s.type = 3) AS dark, max(l.score) AS max_score
            FROM link l JOIN source s ON l.source = s.id WHERE l.active GROUP BY l.slick) x ON x.slick = b.id
        WHERE r.cls IS NULL OR r.cls NOT IN (SELECT id FROM not_oil)""",
    "score": "SELECT slick, source, type, hitl, max(score) AS score FROM (SELECT l.slick, l.source, s.type, l.hitl, l.score FROM link l JOIN source s ON l.source = s.id WHERE l.active) AS x GROUP BY slick, source, type, hitl",
    "truth": "SELECT slick, source, type, score, coalesce(hitl, false) AS truth FROM score",
}

#: What stands for a view in Spark: the same rows by an equi-join on grid cells, and by an anti join in place of NOT IN.
SPARK_VIEWS = {
    "slick_to_aoi": """SELECT p.id AS slick, a.id AS aoi, a.type, a.name FROM (SELECT *, floor(lon / 20e0) AS gx, floor(lat / 10e0) AS gy FROM place) p
        JOIN (SELECT *, explode(sequence(floor(miny / 10e0), floor(maxy / 10e0))) AS gy FROM (SELECT *, explode(sequence(floor(minx / 20e0), floor(maxx / 20e0))) AS gx FROM aoi)) a
        ON p.gx = a.gx AND p.gy = a.gy WHERE p.lon >= a.minx AND p.lon < a.maxx AND p.lat >= a.miny AND p.lat < a.maxy""",
    "slick_plus": VIEWS["slick_plus"].replace("WHERE r.cls IS NULL OR r.cls NOT IN (SELECT id FROM not_oil)", "LEFT ANTI JOIN not_oil o ON r.cls = o.id"),
}

#: Columns that the table functions over slick_plus give out.
FUNCTION_COLUMNS = "id, ts, area, scene_id, linearity, hitl_cls, hitl_name, eez, iho, mpa, vessels, infra, dark, max_score, url"
_HAVERSINE = "2 * 6371008.8e0 * asin(sqrt(least(1e0, power(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * power(sin(radians({b}.lon - {a}.lon) / 2), 2))))"
_NEAR = _HAVERSINE.format(a="a", b="b")
_SITES = "SELECT s_suppkey AS id, 5e0 + (s_suppkey * 7919 % 1000) / 2000e0 AS lon, 50e0 + (s_suppkey * 104729 % 1000) / 2000e0 AS lat FROM supplier"
_DETECTIONS = "SELECT c_custkey AS id, 5e0 + (c_custkey * 6007 % 10007) / 20014e0 AS lon, 50e0 + (c_custkey * 7001 % 10009) / 20018e0 AS lat, c_acctbal AS length_m FROM customer"
VIEWS |= {"supplier_places": _SITES, "customer_places": _DETECTIONS}
_CELLS = "SELECT dx, dy FROM (VALUES (-1), (0), (1)) AS i(dx), (VALUES (-1), (0), (1)) AS j(dy)"
_STEPS = """SELECT *, lead(ts) OVER w AS t1, lead(lon) OVER w AS lon1, lead(lat) OVER w AS lat1, lead(speed) OVER w AS speed1, lead(course) OVER w AS course1 FROM ping WINDOW w AS (PARTITION BY ssvid ORDER BY ts)"""

#: name: (operator ids and what it does, SQL).
QUERIES: dict[str, tuple[str, str]] = {
    "repeat_source": ("Q3 A1 J4 J5 W1 F2-F4: sources by runs, with the fan-out of tags and reviews before the sum", """
        WITH tagged AS (SELECT l.slick, l.link_rank, l.hitl, l.score, so.id AS source_id, so.ext_id, so.type, t.tag FROM link l, source so LEFT JOIN tag t ON t.ext_id = so.ext_id AND t.type = so.type WHERE l.source = so.id AND l.active AND coalesce(l.hitl, true)),
        counted AS (SELECT * FROM tagged WHERE coalesce(tag, 0) <> 12 AND type = 2 AND link_rank = 1 UNION ALL SELECT * FROM tagged WHERE coalesce(tag, 0) NOT IN (5, 6, 7, 12) AND type = 1 AND (coalesce(hitl, false) OR score > 0)),
        seen AS (SELECT s.id, s.run, s.area FROM slick s LEFT JOIN review h ON h.slick = s.id WHERE s.active AND s.cls NOT IN (SELECT id FROM not_oil) AND coalesce(h.cls, 0) NOT IN (SELECT id FROM not_oil)),
        agg AS (SELECT source_id, ext_id, type, count(DISTINCT run) AS run_count, round(sum(area), 2) / 1e6 AS total_area FROM counted JOIN seen ON seen.id = counted.slick GROUP BY source_id, ext_id, type)
        SELECT *, row_number() OVER (ORDER BY run_count DESC, total_area DESC, source_id) AS global_rank FROM agg"""),
    "repeat_source_dedup": ("T1: the same without fan-out, each detection counted once", """
        SELECT source_id, type, count(DISTINCT run) AS run_count, round(sum(area), 2) / 1e6 AS total_area FROM (
          SELECT DISTINCT so.id AS source_id, so.type, s.id, s.run, s.area FROM link l JOIN source so ON l.source = so.id JOIN slick s ON l.slick = s.id
          WHERE s.active AND l.active AND (l.hitl IS NULL OR l.hitl) AND s.cls NOT IN (SELECT id FROM not_oil)) AS x GROUP BY source_id, type HAVING count(DISTINCT run) > 1"""),
    "slick_plus": ("Q1 F2 J1-J3 A2 A3 P4 X1: detections with review, areas and sources", "SELECT id, ts, round(area, 6) AS area, cls, run, scene_id, round(linearity, 8) AS linearity, hitl_cls, hitl_name, eez, iho, mpa, vessels, infra, dark, round(max_score, 8) AS max_score, url FROM slick_plus"),
    "slick_plus_presplit": ("Q9: the earlier view, which excludes one class only", "SELECT s.id, s.cls, s.area, r.cls AS hitl_cls FROM slick s LEFT JOIN latest_review r ON r.slick = s.id WHERE s.active AND s.cls <> 1 AND (r.cls IS NULL OR r.cls <> 1)"),
    "source_plus": ("Q2 X1 O1: links with source, URL by type", """
        SELECT l.slick, so.id AS source, so.ext_id, st.name AS source_type, l.link_rank, round(l.score, 8) AS score, s.confidence AS slick_confidence,
          CASE so.type WHEN 1 THEN concat('https://example.org/sources/', so.ext_id) WHEN 2 THEN concat('https://example.org/?ext_id_name=', so.ext_id) END AS url
        FROM link l JOIN source so ON l.source = so.id JOIN slick s ON l.slick = s.id JOIN source_type st ON st.id = so.type WHERE l.active AND s.active ORDER BY l.slick DESC NULLS LAST, l.link_rank NULLS LAST"""),
    "slicks_by_source": ("Q5 J6 F4 F5: detections linked with any of some sources up to a rank", f"SELECT {FUNCTION_COLUMNS} FROM slick_plus p LEFT SEMI JOIN (SELECT slick FROM link WHERE active AND source IN (1, 2, 3) AND link_rank <= 2) AS l ON l.slick = p.id"),
    "slicks_by_aoi": ("Q6 J6: detections in some areas above a score", f"SELECT {FUNCTION_COLUMNS} FROM slick_plus p LEFT SEMI JOIN (SELECT slick FROM slick_to_aoi WHERE aoi IN (3, 7)) AS a ON a.slick = p.id WHERE p.max_score >= 0.5e0"),
    "slicks_by_aoi_or_source": ("Q4 T2: no area given; the sentinel OR binds looser than the rank test", f"SELECT {FUNCTION_COLUMNS} FROM slick_plus p LEFT SEMI JOIN (SELECT slick FROM link WHERE active AND ('1,5' = 'NULL' OR source IN (1, 5) AND link_rank <= 1)) AS l ON l.slick = p.id WHERE p.max_score >= 0e0"),
    "cls_subtree": ("Q8 G2: each class of the upper two levels with all below it", """
        WITH RECURSIVE n(id, supercls) AS (SELECT CAST(r_regionkey AS BIGINT), CAST(NULL AS BIGINT) FROM region UNION ALL SELECT 1000 + n_nationkey, n_regionkey FROM nation UNION ALL SELECT 1000000 + c_custkey, 1000 + c_nationkey FROM customer),
          t(root, id, supercls) AS (SELECT id, id, supercls FROM n WHERE id < 1000000 UNION ALL SELECT t.root, n.id, n.supercls FROM n JOIN t ON n.supercls = t.id) SELECT DISTINCT root, id, supercls FROM t"""),
    "slick_history": ("Q7 G3: lineage through precursors from every detection; what is reached twice counts twice", "WITH RECURSIVE p(id, pre) AS (SELECT id, CAST(floor(id / 2e0) AS BIGINT) FROM slick UNION ALL SELECT id, CAST(floor(id / 3e0) AS BIGINT) FROM slick WHERE id % 5 = 0 UNION ALL SELECT 0, 0 FROM region WHERE 1 = 0), h(id) AS (SELECT id FROM slick UNION ALL SELECT p.pre FROM h JOIN p ON p.id = h.id WHERE p.pre > 0) SELECT h.id, count(*) AS reached FROM h GROUP BY h.id"),
    "latest_review": ("J2 W8: the newest review of each detection", "SELECT slick, cls, ts FROM latest_review"),
    "not_oil_exclusion": ("F2 J22: anti join with a class subtree", "SELECT s.id, s.cls FROM slick s LEFT ANTI JOIN not_oil n ON s.cls = n.id WHERE s.active"),
    "slicks_of_scene": ("J23: detections of scenes above a confidence", "SELECT DISTINCT s.id, s.confidence FROM slick s JOIN run ON s.run = run.id JOIN scene sc ON run.scene = sc.id WHERE sc.id IN (3, 4) AND s.active AND s.confidence > 0.2e0 AND NOT EXISTS (SELECT 1 FROM not_oil n WHERE n.id = s.cls)"),
    "stale_deactivation": ("T6s: all active detections of scenes that run again become inactive", "SELECT id, active AND run NOT IN (SELECT id FROM run WHERE scene % 4 = 1) AS active FROM slick"),
    "deactivate_by_type": ("J25 J17: links of some source types become inactive", "SELECT l.slick, l.source, l.link_rank, l.active AND NOT coalesce(s.type IN (1, 3), false) AS active FROM link l LEFT JOIN source s ON s.id = l.source"),
    "retained_scores": ("J24: active links of types that don't run again", "SELECT l.slick, l.source, t.name AS type_name, round(max(l.score), 8) AS score FROM link l JOIN source s ON l.source = s.id JOIN source_type t ON t.id = s.type WHERE l.active AND t.name NOT IN ('VESSEL') GROUP BY l.slick, l.source, t.name"),
    "rerank_top8": ("V11 W3 W6 O3 T12: kept and fresh scores ranked together, the first eight active", """
        SELECT slick, source, fresh, new_rank, new_rank <= 8 AS active FROM (SELECT *, row_number() OVER (PARTITION BY slick ORDER BY score DESC NULLS LAST, source, fresh) AS new_rank FROM (
          SELECT slick, source, score, false AS fresh FROM score WHERE type <> 1 UNION ALL SELECT slick, source, score * 1.1e0, true FROM score WHERE type = 1 UNION ALL SELECT slick % 500 AS slick, source + 1000, score - 1, true FROM score WHERE type = 3) AS x) AS y WHERE new_rank <= 8 OR NOT fresh"""),
    "upsert_assoc": ("K1 K2 K3: insert or overwrite by key, the later batch wins", "SELECT slick, source, round(score, 8) AS score, batch FROM (SELECT *, row_number() OVER (PARTITION BY slick, source ORDER BY batch DESC, score DESC) AS rn FROM (SELECT slick, source, score, 0 AS batch FROM link WHERE slick % 3 <> 0 UNION ALL SELECT slick, source, score + 1, 1 FROM link WHERE slick % 5 = 0) AS u) AS x WHERE rn = 1"),
    "insert_missing": ("K1: rows whose key is new", "SELECT DISTINCT l.source + 50 AS ext_id FROM link l LEFT ANTI JOIN source s ON s.id = l.source + 50"),
    "dedup_map_audit": ("J16: a merge map must have no chains", "SELECT a.small_id, a.large_id AS via, b.large_id FROM (SELECT id AS small_id, id * 2 AS large_id FROM source WHERE id % 7 = 0) AS a JOIN (SELECT id AS small_id, id * 2 AS large_id FROM source WHERE id % 7 = 0) AS b ON a.large_id = b.small_id"),
    "dedup_merge": ("D4 A10 A11 W4 X11: links of merged sources, one for each pair by five keys, flags or-ed", """
        SELECT slick, target, source AS donor, any_active, any_hitl, kept_hitl FROM (SELECT *, bool_or(active) OVER g AS any_active, bool_or(coalesce(hitl, false)) OVER g AS any_hitl,
            CASE WHEN bool_or(coalesce(hitl, false)) OVER g THEN true WHEN bool_or(coalesce(NOT hitl, false)) OVER g THEN false END AS kept_hitl,
            row_number() OVER (PARTITION BY slick, target ORDER BY (CASE WHEN hitl THEN 0 WHEN hitl IS NULL THEN 1 ELSE 2 END), (CASE WHEN active THEN 0 ELSE 1 END), score DESC NULLS LAST, link_rank NULLS LAST, source, ts, part) AS pick
          FROM (SELECT l.*, CASE WHEN source % 7 = 0 THEN source - 1 ELSE source END AS target FROM link l) AS m WINDOW g AS (PARTITION BY slick, target)) AS x WHERE pick = 1"""),
    "dup_rank_audit": ("A12: keys that stand more than once", "SELECT slick, link_rank, count(*) AS n FROM link GROUP BY slick, link_rank HAVING count(*) > 1"),
    "exc_sync": ("G6 D7 F6: links of sources with an excluding tag are inactive", "SELECT l.slick, l.source, l.link_rank, l.part, l.active AND NOT EXISTS (SELECT 1 FROM source s JOIN tag t ON t.ext_id = s.ext_id AND t.type = s.type WHERE s.id = l.source AND t.tag = 6) AS active FROM link l"),
    "pending_dates": ("F13 O2 O9: dates that wait for a backfill, newest first", "SELECT DISTINCT CAST(CAST(s.ts AS DATE) AS STRING) AS day FROM slick s JOIN run r ON s.run = r.id WHERE r.success AND s.cls = 11 ORDER BY day DESC LIMIT 50"),
    "seaice_fallback_asof": ("S7: the newest mask not after a date", "SELECT CAST(d.day AS STRING) AS day, CAST(max(m.day) AS STRING) AS mask_day FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM ping) AS d JOIN (SELECT DISTINCT CAST(ts AS DATE) AS day FROM ping WHERE value > 489) AS m ON m.day <= d.day GROUP BY d.day"),
    "geom_part_stats": ("A4 P5 J18 C: parts of a geometry: count, largest and median area", "SELECT slick, count(*) AS parts, round(max(price), 6) AS largest, round($median(price), 6) AS median_area FROM link GROUP BY slick"),
    "shape_metrics": ("P2 P4 X9: compactness and linearity", "SELECT id, round(4 * pi() * area / power(perimeter, 2), 8) AS polsby_popper, round(power(length, 2) / area / (4 * pi() * area / power(perimeter, 2)), 8) AS linearity FROM slick"),
    "tile_grid": ("P20 X17: tiles of an offset grid over bounds", "SELECT x, y, -180e0 + (x - 1) * 180e0 / 512 + 0.33e0 * 180e0 / 512 AS minx, 90e0 - y * 180e0 / 512 + 0.33e0 * 180e0 / 512 AS maxy FROM (SELECT n_nationkey + 600 AS x FROM nation) AS a, (SELECT r_regionkey + 128 AS y FROM region) AS b"),
    "enveloping_tile": ("P22: the smallest tile with both corners", """
        SELECT id, max(z) AS z FROM (SELECT p.id, z.z, floor((p.lon + 180) / 180e0 * power(2, z.z)) AS x0, floor((p.lon + 180.4e0) / 180e0 * power(2, z.z)) AS x1, floor((90 - p.lat) / 180e0 * power(2, z.z)) AS y0, floor((90.3e0 - p.lat) / 180e0 * power(2, z.z)) AS y1
          FROM place p, (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10)) AS z(z)) AS t WHERE x0 = x1 AND y0 = y1 GROUP BY id"""),
    "utm_zone": ("P10: projection zone and hemisphere of a point", "SELECT id, CAST(floor((lon + 180) / 6) AS INT) + 1 AS zone, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + CAST(floor((lon + 180) / 6) AS INT) + 1 AS epsg FROM place"),
    "web_mercator": ("P10: forward spherical Mercator", "SELECT id, round(6378137e0 * radians(lon), 4) AS x, round(6378137e0 * ln(tan(pi() / 4 + radians(lat) / 2)), 4) + 0e0 AS y FROM place"),
    "aoi_membership": ("J8: detections in areas, by grid cell and exact test", "SELECT slick, aoi, type FROM slick_to_aoi"),
    "haversine_band_anti": ("J7 S3 F17 W2: unmatched detections without a structure within 100 m; of a structure's positions near any of them the most confident counts", f"""
        WITH d AS (SELECT c_custkey AS id, 5 + (c_custkey * 6007 % 10007) / 200140 AS lon, 50 + (c_custkey * 7001 % 10009) / 200180 AS lat, c_acctbal AS length_m, 1 - c_custkey % 9 / 500 AS presence FROM customer WHERE c_custkey % 13 < 10),
        s AS (SELECT s_suppkey // 2 AS structure, 5 + (s_suppkey * 7919 % 1000) / 20000 AS lon, 50 + (s_suppkey * 104729 % 1000) / 20000 AS lat, s_suppkey % 7 AS confidence FROM supplier),
        u AS (SELECT *, row_number() OVER (PARTITION BY structure ORDER BY confidence DESC, lon, lat) AS rn FROM (SELECT DISTINCT s.* FROM s JOIN d ON abs(s.lat - d.lat) < 0.001 AND abs(s.lon - d.lon) < 0.001) AS n)
        SELECT a.id, a.length_m FROM d a WHERE a.length_m > 30 AND a.presence > 0.99 AND NOT EXISTS (SELECT 1 FROM u b WHERE b.rn = 1 AND {_NEAR} < 100)"""),
    "radius_neighbours": ("J12 J13: structures within 2 km of each detection, by neighbouring grid cells", f"""
        SELECT a.id AS detection, b.id AS site, round({_NEAR}, 3) AS metres FROM (SELECT id, lon, lat, CAST(floor(lon / 0.04e0) AS BIGINT) AS cx, CAST(floor(lat / 0.04e0) AS BIGINT) AS cy FROM ({_DETECTIONS}) AS d) AS a
          JOIN (SELECT id, lon, lat, CAST(floor(lon / 0.04e0) AS BIGINT) + dx AS cx, CAST(floor(lat / 0.04e0) AS BIGINT) + dy AS cy FROM ({_SITES}) AS s, ({_CELLS}) AS c) AS b
          ON a.cx = b.cx AND a.cy = b.cy WHERE {_NEAR} < 2000"""),
    "vessel_extent": ("A5 W8: extent, top speed, first and last position of each vessel", "SELECT ssvid, min(lon) AS minx, max(lon) AS maxx, min(lat) AS miny, max(lat) AS maxy, max(speed) AS top_speed, min(ts) AS first_ts, max(ts) AS last_ts, min_by(lon, ts) AS first_lon, max_by(lon, ts) AS last_lon FROM ping GROUP BY ssvid"),
    "reach_prefilter": ("J14: vessels that can have reached a box", "SELECT ssvid FROM (SELECT ssvid, min(lon) AS minx, max(lon) AS maxx, min(lat) AS miny, max(lat) AS maxy, max(speed) * 0.514444444e0 * 3600 / 111320e0 AS reach FROM ping GROUP BY ssvid) AS v WHERE (maxx >= 10.5e0 AND minx <= 10.9e0 AND maxy >= 40.2e0 AND miny <= 40.6e0) OR (maxx + reach >= 10.5e0 AND minx - reach <= 10.9e0 AND maxy + reach >= 40.2e0 AND miny - reach <= 40.6e0)"),
    "segment_velocity": ("W7 V1: speed along each leg, zero for equal times", f"SELECT ssvid, id, CASE WHEN $epoch(t1) - $epoch(ts) = 0 THEN 0e0 ELSE round((lon1 - lon) * 111320e0 / ($epoch(t1) - $epoch(ts)), 8) END AS vx FROM ({_STEPS}) AS s WHERE t1 IS NOT NULL"),
    "closest_ping": ("J20: the position nearest in time to each image", "SELECT ssvid, min_by(id, struct_key) AS id FROM (SELECT ssvid, id, abs($epoch(ts) - $epoch(CAST('2024-01-15 06:00:00' AS TIMESTAMP))) * 1e6 + id / 1e6 AS struct_key FROM ping) AS p GROUP BY ssvid"),
    "point_scores": ("V9: weighted decay of angle and distance, the best for each point", "SELECT site, round(max(least(1e0, greatest(0e0, w * exp(-theta * 6.4e0) * exp(-d / 19200e0)))), 8) AS score FROM (SELECT CAST(part % 500 AS INT) AS site, (1 + disc) / 1.1e0 AS w, (qty % 10) / 10e0 AS theta, price AS d FROM link) AS x GROUP BY site"),
    "collated": ("V10: score by the mean and deviation of its source type", "SELECT s.slick, s.source, round((s.score - c.mu) / c.sd, 8) AS collated FROM score s JOIN type_moments c ON c.type = s.type"),
    "cumulative_share_80": ("W5: the longest parts that make up 80 %", "SELECT slick, part, link_rank FROM (SELECT slick, part, link_rank, sum(qty) OVER (PARTITION BY slick ORDER BY qty DESC, part, link_rank, price ROWS UNBOUNDED PRECEDING) - qty AS before, sum(qty) OVER (PARTITION BY slick) AS total FROM link) AS x WHERE before < 0.8e0 * total"),
    "cumulative_share_95": ("W5: the largest parts that make up 95 %", "SELECT slick, part, link_rank FROM (SELECT slick, part, link_rank, sum(qty) OVER (PARTITION BY slick ORDER BY qty DESC, part, link_rank, price ROWS UNBOUNDED PRECEDING) - qty AS before, sum(qty) OVER (PARTITION BY slick) AS total FROM link) AS x WHERE before < 0.95e0 * total"),
    "mosaic_last_wins": ("R1: pixels of overlapping tiles in one scene array, the last tile wins; a pixel that a tile has twice counts with its largest value", """
        SELECT scene, y, x, round(max_by(prob, tile), 8) AS prob, count(*) AS tiles FROM (
          SELECT part % 7 AS scene, part % 64 AS y, source % 64 AS x, slick * 8 + link_rank AS tile, max(score) AS prob FROM link
          GROUP BY part % 7, part % 64, source % 64, slick * 8 + link_rank) AS t GROUP BY scene, y, x"""),
    "edge_discard": ("R3: instances (as boxes) go whose area lies in the no-data margin by more than half", "SELECT id, round(share, 8) AS margin_share FROM (SELECT id, least(1e0, greatest(0e0, (lat + h / 2 - 40e0) / h)) AS share FROM (SELECT id, lat, 1e0 + id % 5 AS h FROM place) AS b) AS s WHERE share <= 0.5e0"),
    "arf": ("A9 F7: aspect ratio factor, length-weighted, and its gate", "SELECT slick, round(1 - exp((1 - x) / 16), 8) AS arf, 1 - exp((1 - x) / 16) <= 0.35e0 AS skip_vessels FROM (SELECT slick, sum(qty * qty * qty / (price / 1000)) / sum(qty) AS x FROM link GROUP BY slick) AS a"),
    "weighted_average": ("A7 A8: weighted mean with a fallback", "SELECT source, round(coalesce(sum(qty * score) / nullif(sum(qty), 0), avg(score)), 8) AS weighted, round(max(score), 8) AS best FROM link GROUP BY source"),
    "group_rollup": ("A6: median, mode, mean and maximum of a group", "SELECT l_suppkey AS source, round(quantile_cont(l_extendedprice, 0.5), 6) AS med, (SELECT min(m) FROM (SELECT k.l_linenumber AS m, count(*) AS n, max(count(*)) OVER () AS top FROM lineitem k WHERE k.l_suppkey = l.l_suppkey GROUP BY k.l_linenumber) AS x WHERE n = top) AS mode_rank, round(avg(l_quantity), 8) AS mean_qty, max(l_extendedprice) AS top FROM lineitem l GROUP BY l_suppkey"),
    "eval_metrics": ("A18 A19 N9: top-1 and top-3 rate, mean true and false score", """
        SELECT type, round(avg(CASE WHEN r = 1 THEN 1e0 ELSE 0e0 END), 8) AS top1, round(avg(CASE WHEN r <= 3 THEN 1e0 ELSE 0e0 END), 8) AS top3, round(avg(score), 8) AS true_score, round(avg(false_best), 8) AS false_score, count(*) AS n FROM (
          SELECT type, score, truth, row_number() OVER (PARTITION BY slick ORDER BY score DESC, source, truth) AS r, max(CASE WHEN NOT truth THEN score ELSE 0e0 END) OVER (PARTITION BY slick) AS false_best FROM truth) AS x WHERE truth GROUP BY type"""),
    "score_moments": ("A20 N17 T16: mean, population and sample deviation by type", "SELECT type, round(avg(score), 8) AS mean, round(stddev_pop(score), 8) AS sd_pop, round(stddev_samp(score), 8) AS sd_samp FROM truth WHERE truth GROUP BY type"),
    "true_rank": ("N1 W6: rank of the truth where a detection has just one", "SELECT slick, r FROM (SELECT slick, truth, row_number() OVER (PARTITION BY slick ORDER BY score DESC, source, truth) AS r, sum(CASE WHEN truth THEN 1 ELSE 0 END) OVER (PARTITION BY slick) AS n FROM truth) AS x WHERE truth AND n = 1"),
    "collation_grid": ("N2: mean rank and top-3 share over a grid of mean and deviation", """
        SELECT mu, sd, round(avg(r * 1e0), 8) AS mean_rank, round(avg(CASE WHEN r <= 3 THEN 1e0 ELSE 0e0 END), 8) AS top3 FROM (SELECT g.mu, g.sd, truth, row_number() OVER (PARTITION BY g.mu, g.sd, slick ORDER BY (CASE WHEN type = 1 THEN (score - g.mu) / g.sd ELSE score END) DESC, source, truth) AS r
          FROM truth, (SELECT mu, sd FROM (VALUES (0.2e0), (0.5e0), (0.8e0)) AS m(mu), (VALUES (0.1e0), (0.3e0)) AS s(sd)) AS g) AS x WHERE truth GROUP BY mu, sd"""),
    "optimizer_grid": ("N4: share of detections whose truth comes first, over a grid", """
        SELECT mu, round(sum(CASE WHEN truth THEN 1e0 ELSE 0e0 END) / count(*), 8) AS share FROM (SELECT g.mu, truth, row_number() OVER (PARTITION BY g.mu, slick ORDER BY (CASE WHEN type = 2 THEN score - g.mu ELSE score END) DESC, source, truth) AS r, max(CASE WHEN truth THEN 1 ELSE 0 END) OVER (PARTITION BY g.mu, slick) AS has
          FROM truth, (VALUES (-0.5e0), (0e0), (0.5e0), (1e0)) AS g(mu)) AS x WHERE r = 1 AND has = 1 GROUP BY mu"""),
    "rank_regressions": ("N15: truths that rank lower than before", "SELECT slick, source, old_rank, new_rank FROM (SELECT slick, source, truth, row_number() OVER (PARTITION BY slick ORDER BY score DESC, source, truth) AS old_rank, row_number() OVER (PARTITION BY slick ORDER BY score - type DESC, source, truth) AS new_rank FROM truth) AS x WHERE truth AND new_rank > old_rank"),
    "metrics_long": ("N16: wide metrics to long form", "SELECT slick, metric, round(v, 8) AS v FROM (SELECT slick, 'best' AS metric, max(score) AS v FROM truth GROUP BY slick UNION ALL SELECT slick, 'mean', avg(score) FROM truth GROUP BY slick) AS x"),
    "missing_truth": ("N6 J15: truths that no candidate met get score 0 and no rank", "SELECT DISTINCT t.slick, t.source, 0e0 AS score FROM truth t LEFT ANTI JOIN (SELECT slick, source FROM score WHERE score > 0) AS c ON c.slick = t.slick AND c.source = t.source WHERE t.truth"),
    "hard_negatives": ("N8 O6 O8: false candidates beside the truths", "SELECT slick, source, truth FROM truth WHERE truth UNION ALL SELECT f.slick, f.source, f.truth FROM truth f LEFT ANTI JOIN (SELECT slick, source FROM truth WHERE truth) AS t ON t.slick = f.slick AND t.source = f.source WHERE NOT f.truth AND f.score > 0.5e0"),
    "highest_false": ("N9: best false score of each detection, 0 without", "SELECT slick, round(coalesce(max(CASE WHEN NOT truth THEN score END), 0e0), 8) AS false_score FROM truth GROUP BY slick"),
    "scene_log_stats": ("A21 A22 S16 X13: a log rolled up by scene", "SELECT ssvid, count(CASE WHEN kind = 'click' THEN 1 END) AS clicks, count(CASE WHEN kind = 'view' THEN 1 END) AS views, max(CASE WHEN kind = 'purchase' THEN value END) AS top_purchase, min_by(kind, ts) AS first_kind FROM ping GROUP BY ssvid"),
    "log_payload": ("S16 X13: a field out of JSON payloads", "SELECT event_id, CAST($json(props, k) AS BIGINT) AS k FROM events"),
    "log_query": ("F14: log lines by time, text and severity", "SELECT id, kind FROM ping WHERE ts >= CAST('2024-01-10 00:00:00' AS TIMESTAMP) AND ts < CAST('2024-01-12 00:00:00' AS TIMESTAMP) AND lower(kind) LIKE '%c%' AND NOT kind = 'view' AND (CASE kind WHEN 'click' THEN 1 WHEN 'purchase' THEN 3 ELSE 2 END) >= 1 ORDER BY ts DESC, id"),
    "started_not_finished": ("N11 A23 O10: set difference", "SELECT ssvid, CAST(CAST(ts AS DATE) AS STRING) AS day FROM ping WHERE kind = 'signup' EXCEPT SELECT ssvid, CAST(CAST(ts AS DATE) AS STRING) FROM ping WHERE kind = 'purchase'"),
    "alert_counts_24h": ("F15 T5s: event types with more than one event in the last day", "SELECT t.kind, coalesce(c.n, 0) AS n, coalesce(c.n, 0) > 1 AS alert FROM (SELECT DISTINCT kind FROM ping) AS t LEFT JOIN (SELECT kind, count(*) AS n FROM ping WHERE ts > CAST('2024-01-29 00:00:00' AS TIMESTAMP) GROUP BY kind) AS c ON c.kind = t.kind"),
    "scene_filter": ("F1 X18: acquisitions of the wanted mode, resolution and polarization", "SELECT id FROM (SELECT id, CASE WHEN id % 3 = 0 THEN 'EW' ELSE 'IW' END AS mode, CASE WHEN id % 5 = 0 THEN 'M' ELSE 'H' END AS resolution, CASE WHEN id % 2 = 0 THEN 'DV' ELSE 'DH' END AS polarization FROM ping) AS s WHERE mode = 'IW' AND resolution = 'H' AND substr(polarization, 2, 1) = 'V'"),
    "task_ids": ("K6 X8 T2s: deterministic task ids, one row each", "SELECT DISTINCT concat('asa-', CAST(ssvid AS STRING), '-', substr($sha256(kind), 1, 10), '-', $ymd(ts)) AS task_id FROM ping"),
    "retry_backoff": ("T3s X5: days to the next try by the age of a scene", "SELECT id, CASE WHEN age < 7 THEN 1 WHEN age < 32 THEN 7 END AS days FROM (SELECT id, floor(($epoch(CAST('2024-02-20 00:00:00' AS TIMESTAMP)) - $epoch(ts)) / 86400e0) AS age FROM ping) AS a"),
    "api_items_page": ("F11 T17: bounding box, time range, filter, sort and page", "SELECT p.id, s.ts, p.lon, p.lat FROM place p JOIN slick s ON s.id = p.id WHERE p.lon BETWEEN least(10.9e0, 19.7e0) AND greatest(10.9e0, 19.7e0) AND p.lat BETWEEN least(42.3e0, 36.1e0) AND greatest(42.3e0, 36.1e0) AND s.area > 1000 ORDER BY s.ts DESC, p.id LIMIT 20 OFFSET 5"),
    "api_items_count": ("F11: numberMatched of a page", "SELECT count(*) AS number_matched FROM place p JOIN slick s ON s.id = p.id WHERE p.lon BETWEEN 10.9e0 AND 19.7e0 AND p.lat BETWEEN 36.1e0 AND 42.3e0 AND s.area > 1000"),
    "api_like": ("F11 X2: LIKE on lower case", "SELECT id, name FROM source WHERE lower(name) LIKE '%00001%'"),
    "version_filter": ("X6: versions compared by their parts", """
        SELECT id, v FROM (SELECT p_partkey AS id, concat(p_partkey % 3, '.', p_partkey % 13, '.', p_size % 11) AS v FROM part) AS t WHERE CAST($part(v, 1) AS INT) * 1000000 + CAST($part(v, 2) AS INT) * 1000 + CAST($part(v, 3) AS INT) > 1009009"""),
    "i18n_seed": ("D10 S11 F9: fields melted by entity and locale, rows without any left out", """
        SELECT entity, locale, max(name) AS name, max(description) AS description FROM (SELECT source AS entity, lang AS locale, CASE WHEN n_chars > 3000 THEN CAST(doc_id AS STRING) END AS name, CAST(NULL AS STRING) AS description FROM documents
          UNION ALL SELECT source, lang, NULL, CASE WHEN n_chars < 100 THEN CAST(n_chars AS STRING) END FROM documents) AS x WHERE name IS NOT NULL OR description IS NOT NULL GROUP BY entity, locale"""),
    "locale_chain": ("G4 K4: fallbacks of codes, in the order they resolve", """
        WITH RECURSIVE l(code, fallback) AS (SELECT p_partkey, nullif(CAST(floor(p_partkey / 3e0) AS BIGINT), 0) FROM part), t(code, depth) AS (SELECT code, 0 FROM l WHERE fallback IS NULL UNION ALL SELECT l.code, t.depth + 1 FROM l JOIN t ON l.fallback = t.code) SELECT code, depth FROM t"""),
    "map_class": ("J19: class by model index and name, an explicit one first", "SELECT s.id, coalesce(CASE WHEN s.id % 10 = 0 THEN 9 END, c.id) AS cls FROM slick s LEFT JOIN (VALUES (1, 'INFRA'), (2, 'NATURAL'), (3, 'VESSEL')) AS m(idx, short_name) ON m.idx = s.id % 4 LEFT JOIN cls c ON c.short_name = m.short_name"),
    "hitl_merge": ("D2 A13: detections merged into one with joined notes", "SELECT run, min(ts) AS first_ts, max(ts) AS last_ts, round(sum(area), 4) AS area, count(*) AS n, $join(id) AS precursors FROM slick WHERE active GROUP BY run"),
    "hitl_split": ("D3: a detection split in parts with lineage, the old one inactive", "SELECT s.id AS precursor, s.id * 10 + k.k AS id, round(s.area / 3, 6) AS area, true AS active FROM slick s, (VALUES (0), (1), (2)) AS k(k) WHERE s.cls = 9 UNION ALL SELECT CAST(NULL AS BIGINT), id, round(area, 6), false FROM slick WHERE cls = 9"),
    "pixel_stats": ("A17: mean, median and maximum of a tile's pixels", "SELECT vec_id, round(avg(CAST(p AS DOUBLE)), 6) AS mean, round($median(CAST(p AS DOUBLE)), 6) AS med, round(max(CAST(p AS DOUBLE)), 6) AS top FROM (SELECT vec_id, $explode(embedding) AS p FROM embeddings) AS x GROUP BY vec_id"),
    "mask_class": ("P17 A15: land before ice before none", "SELECT id, CASE WHEN lon < -60 THEN 'LAND' WHEN lat > 30 THEN 'SEA_ICE' END AS mask FROM place"),
    "global_bounds": ("A16: bounds of all", "SELECT min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy FROM place"),
    "availability": ("S4: newest date and presence", "SELECT CAST(CAST(max(ts) AS DATE) AS STRING) AS newest, count(*) > 0 AS some FROM ping"),
    "scan_get": ("S1 F10: equality scan of some columns", "SELECT id, ext_id, name FROM source WHERE type = 2 AND id = 13"),
    "ais_scan": ("S2: positions in time and box with identity", "SELECT p.ssvid, p.id, p.lon, p.lat, c.c_name AS shipname FROM ping p LEFT JOIN customer c ON c.c_custkey = p.ssvid WHERE p.ts BETWEEN CAST('2024-01-05 00:00:00' AS TIMESTAMP) AND CAST('2024-01-06 12:00:00' AS TIMESTAMP) AND p.lon BETWEEN 10.2e0 AND 11e0"),
    "superview": ("2.16 legacy view: joins with measures, sorted, limited", "SELECT s.id, sc.scene_id, round(4 * pi() * s.area / power(s.perimeter, 2), 8) AS pp, a.name AS aoi FROM slick s JOIN run r ON s.run = r.id JOIN scene sc ON r.scene = sc.id LEFT JOIN slick_to_aoi a ON a.slick = s.id AND a.type = 1 ORDER BY s.ts DESC, s.id LIMIT 10"),
}


def _macro(text: str, name: str, make) -> str:
    """Replaces $name(a, b, ...) with make(a, b, ...); arguments may hold balanced brackets."""
    while (at := text.find(f"${name}(")) >= 0:
        depth, args, k = 0, [""], at + len(name) + 2
        while depth or text[k] != ")":
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            if text[k] == "," and not depth:
                args.append("")
            else:
                args[-1] += text[k]
            k += 1
        text = text[:at] + make(*[a.strip() for a in args]) + text[k + 1 :]
    return text


MACROS = {
    # sorted array of what passes a filter, null if nothing does; as text, so that both engines compare it alike
    "agg": (lambda x, where: f"nullif(array_join(transform(sort_array(collect_set(CASE WHEN {where} THEN {x} END)), v -> CAST(v AS STRING)), ','), '')", lambda x, where: f"array_to_string(list_sort(list(DISTINCT {x}) FILTER ({where})), ',')"),
    "median": (lambda x: f"median({x})", lambda x: f"quantile_cont({x}, 0.5)"),
    "epoch": (lambda x: f"(unix_micros(CAST({x} AS TIMESTAMP)) / 1e6)", lambda x: f"(epoch_us({x}) / 1e6)"),
    "json": (lambda x, k: f"get_json_object({x}, '$.{k}')", lambda x, k: f"json_extract_string({x}, '$.{k}')"),
    "sha256": (lambda x: f"sha2({x}, 256)", lambda x: f"sha256({x})"),
    "ymd": (lambda x: f"date_format({x}, 'yyyyMMdd')", lambda x: f"strftime({x}, '%Y%m%d')"),
    "part": (lambda x, n: f"split_part({x}, '.', {n})", lambda x, n: f"split_part({x}, '.', {n})"),
    "join": (lambda x: f"array_join(transform(sort_array(collect_list({x})), v -> CAST(v AS STRING)), ',')", lambda x: f"array_to_string(list_sort(list({x})), ',')"),
    "explode": (lambda x: f"explode({x})", lambda x: f"unnest({x})"),
}


def _needed(text: str, views: dict[str, str], seen: dict[str, None] | None = None, of: str = "") -> dict[str, None]:
    """Domain views that a text uses, those they use first."""
    seen = {} if seen is None else seen
    for name, body in views.items():
        if name not in seen and name != of and re.search(rf"(?:\b(?:FROM|JOIN)|,)\s+{name}\b", text):
            _needed(body, views, seen, name)
            seen[name] = None
    return seen


def _macros(text: str, duckdb: bool) -> str:
    for name, makes in MACROS.items():
        text = _macro(text, name, makes[duckdb])
    return text


def render(text: str, dialect: str) -> str:
    """The full SQL of a query with its domain views as common table expressions; dialect is spark or duckdb."""
    bodies = VIEWS if dialect == "duckdb" else VIEWS | SPARK_VIEWS
    views = [f"{n}{'(id)' if n == 'not_oil' else ''} AS ({bodies[n]})" for n in _needed(text, bodies)]
    own = re.match(r"\s*WITH (RECURSIVE )?", text)
    if own:
        text = text[own.end() :]
    recursive = own and own[1] or any(v.startswith("not_oil(") for v in views)
    if views or own:
        text = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(views)}{',' if views and own else ''} {text}"
    text = _macros(text, dialect == "duckdb")
    return re.sub(r"\bLEFT (ANTI|SEMI) JOIN\b", r"\1 JOIN", text) if dialect == "duckdb" else text


def _sql(text: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    text = render(text, "spark")
    if "WITH RECURSIVE" in text:
        # what a recursion reaches grows with the input; the default limit of rows would end it with an error
        spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    for table in TABLES:
        if re.search(rf"\b{table}\b", text):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(text)


def view(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A domain view over the tables in sf_dir."""
    return _sql(f"SELECT * FROM {name}", spark, sf_dir)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query over the tables in sf_dir: by a plan of its own where there is one, else by its SQL."""
    from tidewatch.plans import frames, views  # they use the domain views from here

    plans = frames.FRAMES | views.FRAMES
    return plans[name](spark, sf_dir) if name in plans else _sql(QUERIES[name][1], spark, sf_dir)


def queries() -> dict:
    return {name: (lambda spark, sf_dir, name=name: run(name, spark, sf_dir)) for name in QUERIES}


def oracles() -> dict[str, str]:
    return {name: render(text, "duckdb") for name, (_, text) in QUERIES.items()}
