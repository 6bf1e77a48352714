"""Measures and predicates of polygons as column expressions.

A ring is an array of corners (x, y), open (the first corner isn't repeated), in degrees unless a function says
metres. Everything here is higher-order functions over such arrays, so that it runs inside the JVM.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean radius of the earth in metres, and metres in a degree along a meridian and the equator.
RADIUS = 6371008.8
METRES_Y, METRES_X = 110540.0, 111320.0


def let(value: Column, of) -> Column:
    """of(value), with the value worked out once however often `of` uses it."""
    return F.transform(F.array(value), of)[0]


def edges(ring: Column) -> Column:
    """The sides of a ring: (ax, ay, bx, by)."""
    side = lambda p, q: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), q["x"].alias("bx"), q["y"].alias("by"))
    return let(ring, lambda r: F.transform(r, lambda p, i: side(p, r[(i + 1) % F.size(r)])))


def total(sides: Column, of) -> Column:
    return F.aggregate(sides, F.lit(0.0), lambda a, s: a + of(s))


def moved(ring: Column, degrees: Column) -> Column:
    """A ring moved along its parallels."""
    return F.transform(ring, lambda p: F.struct((p["x"] + degrees).alias("x"), p["y"].alias("y")))


def planar_area(ring: Column) -> Column:
    """Signed: positive for counter-clockwise rings. Relative to the first corner, so that small far-off rings lose no digits."""
    cross = lambda a, p, q: (p["x"] - a["x"]) * (q["y"] - a["y"]) - (q["x"] - a["x"]) * (p["y"] - a["y"])
    of = lambda r: F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), F.lit(0.0), lambda s, i: s + cross(r[0], r[i - 1], r[i])) / 2
    return let(ring, lambda r: F.when(F.size(r) > 2, of(r)).otherwise(0.0))


def spherical_area(ring: Column) -> Column:
    """Square metres on a sphere: a sum over the sides, off by less than a percent from the ellipsoid's."""
    return F.abs(total(edges(ring), lambda s: F.radians(s["bx"] - s["ax"]) * (2 + F.sin(F.radians(s["ay"])) + F.sin(F.radians(s["by"]))))) * RADIUS * RADIUS / 2


def haversine(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Metres between two places in degrees."""
    h = F.pow(F.sin(F.radians(by - ay) / 2), 2) + F.cos(F.radians(ay)) * F.cos(F.radians(by)) * F.pow(F.sin(F.radians(bx - ax) / 2), 2)
    return 2 * RADIUS * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def perimeter(ring: Column) -> Column:
    return total(edges(ring), lambda s: haversine(s["ax"], s["ay"], s["bx"], s["by"]))


def centroid(ring: Column) -> Column:
    """(x, y) of the area's centre on the plane of degrees; of a ring without area the mean of its corners."""
    cross = lambda s: s["ax"] * s["by"] - s["bx"] * s["ay"]

    def middle(r: Column, sides: Column, twice: Column) -> Column:
        mean = lambda c: F.aggregate(r, F.lit(0.0), lambda a, p: a + p[c]) / F.size(r)
        at = lambda c: F.when(twice == 0, mean(c)).otherwise(r[0][c] + total(sides, lambda s: (s["a" + c] + s["b" + c]) * cross(s)) / (3 * twice))
        return F.struct(at("x").alias("x"), at("y").alias("y"))

    # relative to the first corner, so that far-off small rings lose no digits
    near = lambda r: F.transform(r, lambda p: F.struct((p["x"] - r[0]["x"]).alias("x"), (p["y"] - r[0]["y"]).alias("y")))
    return let(ring, lambda r: let(edges(near(r)), lambda sides: let(total(sides, cross), lambda twice: middle(r, sides, twice))))


def box(ring: Column) -> Column:
    """(minx, miny, maxx, maxy)"""
    def of(r: Column) -> Column:
        c = lambda k: F.transform(r, lambda p: p[k])
        return F.struct(F.array_min(c("x")).alias("minx"), F.array_min(c("y")).alias("miny"), F.array_max(c("x")).alias("maxx"), F.array_max(c("y")).alias("maxy"))

    return let(ring, of)


def normalised(ring: Column) -> Column:
    """A ring without corners that repeat the one before, open and counter-clockwise; null if fewer than three are left or it has no area."""
    before = lambda r, i: r[(i + F.size(r) - 1) % F.size(r)]
    apart = lambda r: F.filter(r, lambda p, i: (p["x"] != before(r, i)["x"]) | (p["y"] != before(r, i)["y"]))
    turned = lambda r, area: F.when((F.size(r) >= 3) & (area != 0), F.when(area > 0, r).otherwise(F.reverse(r)))
    return let(let(ring, apart), lambda r: let(planar_area(r), lambda area: turned(r, area)))


def in_metres(ring: Column, latitude: Column) -> Column:
    """A ring on the local plane of a latitude."""
    return F.transform(ring, lambda p: F.struct((p["x"] * METRES_X * F.cos(F.radians(latitude))).alias("x"), (p["y"] * METRES_Y).alias("y")))


def contains(sides: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside, by the sides that a ray to the right crosses."""
    crossed = F.filter(sides, lambda s: ((s["ay"] > y) != (s["by"] > y)) & (x < (s["bx"] - s["ax"]) * (y - s["ay"]) / (s["by"] - s["ay"]) + s["ax"]))
    return F.size(crossed) % 2 == 1


def point_to_side(x: Column, y: Column, s: Column) -> Column:
    dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
    along = F.when(dx * dx + dy * dy == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - s["ax"]) * dx + (y - s["ay"]) * dy) / (dx * dx + dy * dy))))
    return F.hypot(x - s["ax"] - along * dx, y - s["ay"] - along * dy)


def point_distance(sides: Column, x: Column, y: Column) -> Column:
    """Metres from a point to a polygon of sides in metres, 0 inside."""
    return let(sides, lambda ss: F.when(contains(ss, x, y), 0.0).otherwise(F.array_min(F.transform(ss, lambda s: point_to_side(x, y, s)))))


def _side_distance(s: Column, t: Column) -> Column:
    turn = lambda ax, ay, bx, by, px, py: (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    over = (turn(s["ax"], s["ay"], s["bx"], s["by"], t["ax"], t["ay"]) * turn(s["ax"], s["ay"], s["bx"], s["by"], t["bx"], t["by"]) < 0) & (turn(t["ax"], t["ay"], t["bx"], t["by"], s["ax"], s["ay"]) * turn(t["ax"], t["ay"], t["bx"], t["by"], s["bx"], s["by"]) < 0)
    return F.when(over, 0.0).otherwise(F.least(point_to_side(s["ax"], s["ay"], t), point_to_side(s["bx"], s["by"], t), point_to_side(t["ax"], t["ay"], s), point_to_side(t["bx"], t["by"], s)))


def distance(a: Column, b: Column) -> Column:
    """Metres between two polygons of sides in metres, 0 if they meet or one holds the other."""
    inside = lambda p, q: contains(p, q[0]["ax"], q[0]["ay"]) | contains(q, p[0]["ax"], p[0]["ay"])
    least = lambda p, q: F.array_min(F.transform(p, lambda s: F.array_min(F.transform(q, lambda t: _side_distance(s, t)))))
    return let(a, lambda p: let(b, lambda q: F.when(inside(p, q), 0.0).otherwise(least(p, q))))


def clipped(ring: Column, axis: str, bound: Column, keep_above: bool) -> Column:
    """The part of a ring on one side of a line across an axis (Sutherland and Hodgman)."""
    inside = (lambda v: v >= bound) if keep_above else (lambda v: v <= bound)
    other = "y" if axis == "x" else "x"

    def corner(s: Column) -> Column:
        a, b = s["a" + axis], s["b" + axis]
        cut = s["a" + other] + (s["b" + other] - s["a" + other]) * (bound - a) / (b - a)
        at = {axis: bound, other: cut}
        crossing = F.struct(at["x"].cast("double").alias("x"), at["y"].cast("double").alias("y"))
        end = F.struct(s["bx"].alias("x"), s["by"].alias("y"))
        none = F.array().cast("array<struct<x: double, y: double>>")
        return F.concat(F.when(inside(a) != inside(b), F.array(crossing)).otherwise(none), F.when(inside(b), F.array(end)).otherwise(none))

    return F.flatten(F.transform(edges(ring), corner))


def polsby_popper(area: Column, length: Column) -> Column:
    return 4 * math.pi * area / F.pow(length, 2)
