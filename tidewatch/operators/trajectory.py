"""Vessel tracks: a time grid with interpolated and extrapolated positions, the ends of a slick on a track, and scores.

Positions are in metres, times in microseconds. All but the walk along a track is column algebra; the walk is a small
helper over one track's points, of which there are as many as steps in the time window.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tidewatch.plans import tables

# Knots in metres a second; hours of track before and after an image, and how far positions go on after it.
KNOT = 0.514444444
HOURS_BEFORE, HOURS_AFTER, DETAIL_AFTER = 8, 6, 1
# Spread in metres an hour, grace in metres, reference times in seconds, exponents and weights of the scores.
SPREAD_RATE, GRACE = 3000.0, 500.0
REF_OVER, REF_UNDER = 600.0, 10000.0
SHARP_PARITY, SHARP_PROXIMITY, SHARP_TEMPORAL = 5.77, 5, 2
WEIGHTS = (1.0, 2.0, 1.0)

HOUR, MINUTE = 3_600_000_000, 60_000_000
#: The image that the registered queries are about: 2024-01-15 06:00:00.
IMAGE = 1_705_298_400_000_000


def _velocity(speed: Column, course: Column) -> tuple[Column, Column]:
    return speed * KNOT * F.sin(F.radians(course)), speed * KNOT * F.cos(F.radians(course))


def knots(pings: DataFrame) -> DataFrame:
    """pings (ssvid, id, t, x, y, speed, course) with velocities vx, vy and the next ping (t1, x1, y1, vx1, vy1).

    Without speed or course a ping has the slope to the next one, the last one that from the one before; a leg without
    duration has slope 0. n is the number of the vessel's pings, first and last are the times of its ends.
    """
    w = Window.partitionBy("ssvid").orderBy("t", "id")
    whole = Window.partitionBy("ssvid")
    rows = pings.withColumns({"n": F.count("*").over(whole), "first": F.min("t").over(whole), "last": F.max("t").over(whole)})
    rows = rows.withColumns({c + "1": F.lead(c).over(w) for c in ("t", "x", "y")})
    dt = (F.col("t1") - F.col("t")) / 1e6
    rows = rows.withColumns({f"s{c}": F.when(dt > 0, (F.col(c + "1") - F.col(c)) / dt).when(dt == 0, 0.0) for c in "xy"})
    rows = rows.withColumns({f"s{c}": F.coalesce(f"s{c}", F.lag(f"s{c}").over(w), F.lit(0.0)) for c in "xy"})
    vx, vy = _velocity(F.col("speed"), F.col("course"))
    known = vx.isNotNull() & ~F.isnan(vx)
    rows = rows.withColumns({"vx": F.when(known, vx).otherwise(F.col("sx")), "vy": F.when(known, vy).otherwise(F.col("sy"))})
    return rows.withColumns({c + "1": F.lead(c).over(w) for c in ("vx", "vy")}).drop("sx", "sy")


def tracks(pings: DataFrame, image: int = IMAGE) -> DataFrame:
    """(ssvid, t, x, y, extrapolated, shown): positions of each vessel at every minute from HOURS_BEFORE before the image and at its
    pings in that time, up to DETAIL_AFTER hours after it; shown are those up to the image.

    Between two pings they are on a cubic Bezier curve through both velocities, before the first and after the last on a
    straight line. A vessel with one ping has three rows at its place: at both ends of the whole grid and at the ping. The
    ping before a time is found in one pass over the vessel's pings and grid times in order; a vessel has as many as
    fit in the time window.
    """
    start, end = image - HOURS_BEFORE * HOUR, image + HOURS_AFTER * HOUR
    rows = knots(pings.where(F.col("t").between(start, end)))
    many, one = rows.where("n > 1"), rows.where("n = 1")
    grid = F.sequence(F.lit(start), F.lit(end), F.lit(MINUTE))
    times = many.groupBy("ssvid").agg(F.first("first").alias("first"), F.first("last").alias("last")).select("ssvid", "first", "last", F.explode(grid).alias("t"))
    times = times.union(many.select("ssvid", "first", "last", "t")).distinct().where(F.col("t") <= image + DETAIL_AFTER * HOUR)
    leg = F.struct("t", "x", "y", "vx", "vy", "t1", "x1", "y1", "vx1", "vy1")
    none = F.lit(None).cast("long")
    # a time stands before the pings of the same moment, so that the leg is that of the ping strictly before it
    mixed = times.select("ssvid", "t", F.lit(0).alias("kind"), none.alias("id"), "first", "last", F.lit(None).cast(rows.select(leg.alias("x")).schema["x"].dataType).alias("leg"))
    mixed = mixed.union(many.select("ssvid", "t", F.lit(1), "id", "first", "last", leg))
    by = Window.partitionBy("ssvid").orderBy("t", "kind", "id")
    before = F.last("leg", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first("leg", ignorenulls=True).over(by.rowsBetween(0, Window.unboundedFollowing))
    found = mixed.withColumns({"b": before, "a": after}).where("kind = 0")
    out = {}
    for c in "xy":
        p0, v0, p1, v1 = (F.col(f"b.{k}") for k in (c, "v" + c, c + "1", "v" + c + "1"))
        dt, s = (F.col("b.t1") - F.col("b.t")) / 1e6, (F.col("t") - F.col("b.t")) / 1e6
        u = s / dt
        curve = F.pow(1 - u, 3) * p0 + 3 * F.pow(1 - u, 2) * u * (p0 + v0 * dt / 3) + 3 * (1 - u) * F.pow(u, 2) * (p1 - v1 * dt / 3) + F.pow(u, 3) * p1
        out[c] = F.when(F.col("b").isNull(), F.col(f"a.{c}") + F.col(f"a.v{c}") * (F.col("t") - F.col("a.t")) / 1e6).when(F.col("b.t1").isNull(), p0 + v0 * s).otherwise(curve)
    found = found.select("ssvid", "t", *[v.alias(k) for k, v in out.items()], ((F.col("t") <= F.col("first")) | (F.col("t") >= F.col("last"))).alias("extrapolated"))
    still = one.select("ssvid", F.explode(F.array(F.least(F.lit(start), "t"), "t", F.greatest(F.lit(end), "t"))).alias("t"), "x", "y", F.lit(True).alias("extrapolated"))
    return found.union(still).withColumn("shown", F.col("t") <= image)


def turning_point(distance: np.ndarray, start: int, confirm: int = 10) -> tuple[int, float]:
    """Where a walk from `start` in the direction in which the distance shrinks ends, and the least distance met: it ends
    at a place that isn't nearer than the best when the next `confirm` are all farther too, or at the end of the track."""
    at, best = start, distance[start]
    step = -1 if start > 0 and distance[start - 1] < best else 1
    while 0 <= at + step < len(distance):
        at += step
        if distance[at] < best:
            best = distance[at]
            continue
        ahead = distance[at + 1 : at + 1 + confirm] if step > 0 else distance[max(at - confirm, 0) : at]
        if (ahead > best).all():
            break
    return at, float(best)


ENDS = StructType([StructField("head", IntegerType()), *[StructField(n, LongType() if n[0] == "t" else DoubleType()) for n in ("t_head", "d_head", "t_tail", "d_tail", "d_image", "length")]])


def _ends(image: int):
    @F.pandas_udf(ENDS)
    def ends(t: pd.Series, x: pd.Series, y: pd.Series, line: pd.DataFrame) -> pd.DataFrame:
        out = []
        for t_, x_, y_, ax, ay, bx, by in zip(t, x, y, line["ax"], line["ay"], line["bx"], line["by"], strict=True):
            t_ = np.asarray(t_)
            near = [np.hypot(np.asarray(x_) - px, np.asarray(y_) - py) for px, py in ((ax, ay), (bx, by))]
            at_image = int(np.abs(t_ - image).argmin())
            walks = [turning_point(d, at_image) for d in near]
            # the end that the vessel passes later is the head; of equal ones the first end is the tail
            head = 0 if t_[walks[0][0]] > t_[walks[1][0]] else 1
            i, d_head = walks[head]
            j = int(near[1 - head].argmin())
            lo, hi = min(i, j), max(i, j)
            length = float(np.hypot(np.diff(np.asarray(x_)[lo : hi + 1]), np.diff(np.asarray(y_)[lo : hi + 1])).sum()) if j < i else 0.0
            out.append((head, int(t_[i]), d_head, int(t_[j]), float(near[1 - head][j]), float(near[head][at_image]), length))
        return pd.DataFrame(out, columns=["head", "t_head", "d_head", "t_tail", "d_tail", "d_image", "length"])

    return ends


def ends_on_track(track: DataFrame, lines: DataFrame, image: int = IMAGE) -> DataFrame:
    """For each vessel of track (ssvid, t, x, y) and each of the lines (ssvid, line, ax, ay, bx, by) that may be its: which end is the
    head, and times and distances of head and tail on the track; d_image is the head's distance from the place at the
    image, length that of the track between tail and head (0 if the tail isn't before the head).

    Each end is walked to from the image in time; the tail is then taken anew to the nearest point of the whole track.
    """
    points = track.groupBy("ssvid").agg(F.sort_array(F.collect_list(F.struct("t", "x", "y"))).alias("p"))
    rows = lines.join(points, "ssvid")
    end = F.struct(*[F.col(c).cast("double").alias(c) for c in ("ax", "ay", "bx", "by")])
    return rows.select("ssvid", "line", "ax", "ay", "bx", "by", _ends(image)("p.t", "p.x", "p.y", end).alias("e")).select("ssvid", "line", "ax", "ay", "bx", "by", "e.*")


def scored(mapped: DataFrame, image: int = IMAGE) -> DataFrame:
    """mapped (t_head, d_head, t_tail, d_tail, d_image, length, line_length ...) with temporal, proximity, parity and total; rows whose total is 0 go.

    A tail in front of the vessel has no proximity; a head in front counts by its distance from the place at the image.
    """
    h_tail, h_head = ((F.lit(image) - F.col(c)) / HOUR for c in ("t_tail", "t_head"))

    def near(d: Column, reach: Column) -> Column:
        return F.exp(-F.pow(d / reach, SHARP_PROXIMITY))

    tail = F.when(h_tail <= 0, 0.0).otherwise(near(F.col("d_tail"), F.greatest(SPREAD_RATE * h_tail, F.lit(GRACE))))
    head = F.when(h_head <= 0, near(F.col("d_image"), F.lit(GRACE))).otherwise(near(F.col("d_head"), F.greatest(SPREAD_RATE * h_head, F.lit(GRACE))))
    temporal = F.exp(-F.pow(h_head * 3600 / F.when(h_head < 0, REF_OVER).otherwise(REF_UNDER), SHARP_TEMPORAL))
    parity = F.when((F.col("t_tail") == F.col("t_head")) | (F.col("length") <= 0), 0.0).otherwise(F.exp(-F.pow(F.log(F.col("line_length") / F.col("length")), 2) * SHARP_PARITY))
    out = mapped.withColumns({"temporal": temporal, "proximity": F.sqrt(tail * head), "parity": parity})
    total = sum(F.col(c) * w for c, w in zip(("temporal", "proximity", "parity"), WEIGHTS, strict=True)) / math.fsum(WEIGHTS)
    return out.withColumn("total", total).where("total > 0")


def coincidence(per_line: DataFrame) -> DataFrame:
    """per_line (ssvid, slick, weight, temporal, proximity, parity) brought together over a slick's centrelines: the best temporal
    score, and proximity and parity weighted by the lines' lengths."""
    mean = {c: F.coalesce(F.sum(F.col(c) * F.col("weight")) / F.nullif(F.sum("weight"), F.lit(0.0)), F.lit(0.0)) for c in ("proximity", "parity")}
    rows = per_line.groupBy("slick", "ssvid").agg(F.max("temporal").alias("temporal"), *[v.alias(k) for k, v in mean.items()])
    total = sum(F.col(c) * w for c, w in zip(("temporal", "proximity", "parity"), WEIGHTS, strict=True)) / math.fsum(WEIGHTS)
    return rows.withColumn("total", total).where("total > 0")


def truncated(track: DataFrame, cx: float, cy: float, radius: float, t0: int, t1: int) -> DataFrame:
    """The points of track in a circle and a time range."""
    return track.where(F.col("t").between(t0, t1) & (F.hypot(F.col("x") - cx, F.col("y") - cy) <= radius))


def track_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions on the time grid."""
    out = tracks(tables.pings(spark, sf_dir))
    return out.select("ssvid", ((F.col("t") - IMAGE) / 1e6).alias("offset_s"), F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), "extrapolated", "shown")


def track_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each interpolated track."""
    w = Window.partitionBy("ssvid").orderBy("t")
    rows = tracks(tables.pings(spark, sf_dir)).withColumn("leg", F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)))
    return rows.groupBy("ssvid").agg(F.round(F.coalesce(F.sum("leg"), F.lit(0.0)), 2).alias("metres"), F.count("*").alias("points"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slick's centreline near each vessel's first ping of the time window."""
    p = tables.pings(spark, sf_dir).where(F.col("t").between(IMAGE - HOURS_BEFORE * HOUR, IMAGE + HOURS_AFTER * HOUR))
    first = p.groupBy("ssvid").agg(F.min_by(F.struct("id", "x", "y"), "t").alias("f"))
    s = F.col("f.id") % 9 - 4
    return first.select("ssvid", F.col("f.id").alias("line"), (F.col("f.x") + s * 900).alias("ax"), (F.col("f.y") - s * 400).alias("ay"), (F.col("f.x") + s * 900 + 5000).alias("bx"), (F.col("f.y") + 1500 - s * 400).alias("by"))


def slick_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Head and tail of a slick on each vessel's track."""
    out = ends_on_track(tracks(tables.pings(spark, sf_dir)), _lines(spark, sf_dir))
    return out.select("ssvid", "line", "head", ((F.col("t_head") - IMAGE) / 1e6).alias("head_s"), F.round("d_head", 2).alias("d_head"), ((F.col("t_tail") - IMAGE) / 1e6).alias("tail_s"), F.round("d_tail", 2).alias("d_tail"), F.round("length", 2).alias("length"))


def track_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4-V8: scores of slicks against the interpolated tracks."""
    out = scored(ends_on_track(tracks(tables.pings(spark, sf_dir)), _lines(spark, sf_dir)).withColumn("line_length", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))))
    return out.select("ssvid", "line", *[F.round(c, 8).alias(c) for c in ("temporal", "proximity", "parity", "total")])


def vessel_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5-V8: temporal, proximity and parity scores from given times and distances of head and tail, brought together by slick."""
    l = tables.table(spark, sf_dir, "lineitem")
    t = lambda n, step: F.lit(IMAGE) - (F.col(n) % 400 - 60) * step * 1_000_000
    rows = l.select((F.col("l_orderkey") % 500).alias("slick"), F.col("l_suppkey").alias("ssvid"), F.col("l_quantity").alias("weight"), t("l_partkey", 40).alias("t_head"), t("l_orderkey", 90).alias("t_tail"), (F.col("l_extendedprice") / 40).alias("d_head"), (F.col("l_extendedprice") / 20).alias("d_tail"),
                    (F.col("l_quantity") * 12).alias("d_image"), (F.col("l_discount") * 60000).alias("length"), (F.col("l_quantity") * 100 + 500).alias("line_length"))
    out = coincidence(scored(rows))
    return out.select("slick", "ssvid", *[F.round(c, 8).alias(c) for c in ("temporal", "proximity", "parity", "total")])


def truncated_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the tracks in a circle of space and a range of time."""
    rows = truncated(tables.pings(spark, sf_dir), 900_000.0, 4_500_000.0, 60_000.0, IMAGE - 240 * HOUR, IMAGE + 48 * HOUR)
    return rows.select("ssvid", "id")


QUERIES = {f.__name__: f for f in (track_grid, track_lengths, slick_ends, track_scores, vessel_scores, truncated_tracks)}

_TRACK = f"""WITH p AS (SELECT ssvid, id, t - {IMAGE} AS t, x, y, speed * 0.514444444 * sin(radians(course)) AS wx, speed * 0.514444444 * cos(radians(course)) AS wy FROM ({tables.PINGS}) WHERE t - {IMAGE} BETWEEN -28800000000 AND 21600000000),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ssvid ORDER BY t, id) AS r, count(*) OVER (PARTITION BY ssvid) AS n FROM p),
leg AS (SELECT a.ssvid, a.r, CASE WHEN b.t = a.t THEN 0 ELSE (b.x - a.x) / ((b.t - a.t) / 1e6) END AS sx, CASE WHEN b.t = a.t THEN 0 ELSE (b.y - a.y) / ((b.t - a.t) / 1e6) END AS sy FROM ranked a JOIN ranked b ON a.ssvid = b.ssvid AND b.r = a.r + 1),
k AS (SELECT q.*, coalesce(q.wx, leg.sx) AS vx, coalesce(q.wy, leg.sy) AS vy FROM ranked q LEFT JOIN leg ON leg.ssvid = q.ssvid AND leg.r = least(q.r, q.n - 1)),
ends AS (SELECT ssvid, min(t) AS first, max(t) AS last, max(n) AS n FROM k GROUP BY ssvid),
moments AS (SELECT ssvid, unnest(range(-28800, 21601, 60)) * 1000000 AS t FROM ends WHERE n > 1 UNION SELECT ssvid, t FROM k WHERE n > 1),
m AS (SELECT ssvid, t FROM moments WHERE t <= 3600000000),
spot AS (SELECT m.ssvid, m.t, (SELECT count(*) FROM k WHERE k.ssvid = m.ssvid AND k.t < m.t) AS i FROM m),
pos AS (SELECT spot.ssvid, spot.t, a.t AS ta, a.x AS xa, a.y AS ya, a.vx AS vxa, a.vy AS vya, b.t AS tb, b.x AS xb, b.y AS yb, b.vx AS vxb, b.vy AS vyb, (spot.t - a.t) / (b.t - a.t) AS u, (b.t - a.t) / 1e6 AS d
    FROM spot LEFT JOIN k a ON a.ssvid = spot.ssvid AND a.r = spot.i LEFT JOIN k b ON b.ssvid = spot.ssvid AND b.r = spot.i + 1),
track AS (SELECT ssvid, t, CASE WHEN ta IS NULL THEN xb + vxb * (t - tb) / 1e6 WHEN tb IS NULL THEN xa + vxa * (t - ta) / 1e6
        ELSE (1 - u) ** 3 * xa + 3 * (1 - u) ** 2 * u * (xa + vxa * d / 3) + 3 * (1 - u) * u ** 2 * (xb - vxb * d / 3) + u ** 3 * xb END AS x,
    CASE WHEN ta IS NULL THEN yb + vyb * (t - tb) / 1e6 WHEN tb IS NULL THEN ya + vya * (t - ta) / 1e6
        ELSE (1 - u) ** 3 * ya + 3 * (1 - u) ** 2 * u * (ya + vya * d / 3) + 3 * (1 - u) * u ** 2 * (yb - vyb * d / 3) + u ** 3 * yb END AS y FROM pos
    UNION ALL SELECT ssvid, unnest([least(-28800000000, t), t, greatest(21600000000, t)]), x, y FROM k WHERE n = 1)
"""

ORACLES = {
    "track_grid": _TRACK + "SELECT track.ssvid, track.t / 1e6 AS offset_s, round(x, 2) AS x, round(y, 2) AS y, ends.n = 1 OR track.t <= ends.first OR track.t >= ends.last AS extrapolated, track.t <= 0 AS shown FROM track JOIN ends USING (ssvid)",
    "track_lengths": _TRACK + "SELECT ssvid, round(coalesce(sum(sqrt((x - px) ** 2 + (y - py) ** 2)), 0), 2) AS metres, count(*) AS points FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM track WINDOW w AS (PARTITION BY ssvid ORDER BY t)) GROUP BY ssvid",
    "vessel_scores": """WITH r AS (SELECT l_orderkey % 500 AS slick, l_suppkey AS ssvid, l_quantity AS w, (l_partkey % 400 - 60) * 40 / 3600 AS hh, (l_orderkey % 400 - 60) * 90 / 3600 AS ht,
    l_extendedprice / 40 AS dh, l_extendedprice / 20 AS dt, l_quantity * 12 AS d0, l_discount * 60000 AS tl, l_quantity * 100 + 500 AS cl FROM lineitem),
s AS (SELECT slick, ssvid, w, CASE WHEN hh < 0 THEN exp(-power(hh * 3600 / 600, 2)) ELSE exp(-power(hh * 3600 / 10000, 2)) END AS temporal,
    CASE WHEN ht <= 0 THEN 0 ELSE sqrt(exp(-power(dt / greatest(3000 * ht, 500), 5)) * CASE WHEN hh <= 0 THEN exp(-power(d0 / 500, 5)) ELSE exp(-power(dh / greatest(3000 * hh, 500), 5)) END) END AS proximity,
    CASE WHEN hh = ht OR tl = 0 THEN 0 ELSE exp(-5.77 * power(ln(cl / tl), 2)) END AS parity FROM r),
kept AS (SELECT * FROM s WHERE (temporal + 2 * proximity + parity) / 4 > 0),
a AS (SELECT slick, ssvid, max(temporal) AS temporal, sum(proximity * w) / sum(w) AS proximity, sum(parity * w) / sum(w) AS parity FROM kept GROUP BY slick, ssvid)
SELECT slick, ssvid, round(temporal, 8) AS temporal, round(proximity, 8) AS proximity, round(parity, 8) AS parity, round((temporal + 2 * proximity + parity) / 4, 8) AS total FROM a WHERE temporal + 2 * proximity + parity > 0""",
    "truncated_tracks": f"SELECT ssvid, id FROM ({tables.PINGS}) WHERE t >= {IMAGE} - 240 * 3600000000 AND t <= {IMAGE} + 48 * 3600000000 AND (x - 900000) ** 2 + (y - 4500000) ** 2 <= 60000 ** 2",
}
