"""Map projections of places on the WGS84 ellipsoid as column expressions: transverse Mercator in its zones, polar stereographic, and back.

A place is a struct (x, y): degrees of longitude and latitude, or metres. Column expressions run inside the JVM; zones have the same for arrays of places,
a batch at a time. The series are cut after the fourth or fifth power of the third flattening, which leaves less than a micrometre within a zone.
"""

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.geometry import let

# The ellipsoid's greater half axis and flattening; scale and origin of the zones.
A, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500_000.0, 10_000_000.0
# The latitudes that zones are defined for; standard parallel and meridian of the polar grids by their codes.
ZONES_SOUTH, ZONES_NORTH = -80.0, 84.0
POLAR = {3413: (70.0, -45.0), 3031: (-71.0, 0.0)}

E = math.sqrt(FLATTENING * (2 - FLATTENING))
N = FLATTENING / (2 - FLATTENING)
RECTIFYING = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
# Krueger's series from the conformal sphere to the plane and back, and from conformal to geodetic latitudes.
TO_PLANE = (
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180,
    13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440,
    61 * N**3 / 240 - 103 * N**4 / 140,
    49561 * N**4 / 161280,
)
FROM_PLANE = (
    N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360,
    N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440,
    17 * N**3 / 480 - 37 * N**4 / 840,
    4397 * N**4 / 161280,
)
TO_GEODETIC = (
    2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45 + 26 * N**5 / 45,
    7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45 + 2704 * N**5 / 315,
    56 * N**3 / 15 - 136 * N**4 / 35 - 1262 * N**5 / 105,
    4279 * N**4 / 630 - 332 * N**5 / 35,
    4174 * N**5 / 315,
)


def place(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def turned(degrees: Column) -> Column:
    """A longitude between -180 (included) and 180 degrees."""
    return degrees - 360 * F.floor((degrees + 180) / 360)


def _isometric(latitude: Column) -> Column:
    s = F.sin(F.radians(latitude))
    return F.atanh(s) - E * F.atanh(E * s)


def _geodetic(conformal: Column) -> Column:
    """Degrees of latitude from the conformal one in radians."""
    return F.degrees(sum((c * F.sin(2 * j * conformal) for j, c in enumerate(TO_GEODETIC, 1)), conformal))


def _series(p: Column, coefficients: tuple[float, ...], sign: int) -> Column:
    """p moved by the sum of c * sin(2j p), p being a complex number x + iy."""
    x = sum((sign * c * F.sin(2 * j * p["x"]) * F.cosh(2 * j * p["y"]) for j, c in enumerate(coefficients, 1)), p["x"])
    y = sum((sign * c * F.cos(2 * j * p["x"]) * F.sinh(2 * j * p["y"]) for j, c in enumerate(coefficients, 1)), p["y"])
    return place(x, y)


def zone(lon: Column, lat: Column) -> Column:
    """Code of the zone around a place, 326 or 327 and the number of six degrees; null beyond the latitudes of the zones."""
    number = (F.floor((turned(lon) + 180) / 6) + 1).cast("int")
    return F.when(lat.between(ZONES_SOUTH, ZONES_NORTH), F.when(lat >= 0, 32600 + number).otherwise(32700 + number))


def zone_of_box(box: Column) -> Column:
    """The zone of a box's middle: the one to measure a shape in."""
    return zone((box["minx"] + box["maxx"]) / 2, (box["miny"] + box["maxy"]) / 2)


def _meridian(code: Column) -> Column:
    return (code % 100) * 6 - 183.0


def _false_northing(code: Column) -> Column:
    return F.when(code > 32700, F.lit(FALSE_NORTHING)).otherwise(F.lit(0.0))


def to_zone(p: Column, code: Column) -> Column:
    """Easting and northing in metres of a place in degrees, in the zone of that code."""
    def sphere(q: Column) -> Column:
        tangent, lam = F.sinh(q["y"]), q["x"]
        return place(F.atan2(tangent, F.cos(lam)), F.asinh(F.sin(lam) / F.hypot(tangent, F.cos(lam))))

    start = place(F.radians(turned(p["x"] - _meridian(code))), _isometric(p["y"]))
    return let(let(let(start, sphere), lambda q: _series(q, TO_PLANE, 1)), lambda q: place(FALSE_EASTING + SCALE * RECTIFYING * q["y"], _false_northing(code) + SCALE * RECTIFYING * q["x"]))


def from_zone(p: Column, code: Column) -> Column:
    """The place in degrees of an easting and northing."""
    start = place((p["y"] - _false_northing(code)) / (SCALE * RECTIFYING), (p["x"] - FALSE_EASTING) / (SCALE * RECTIFYING))

    def degrees(q: Column) -> Column:
        return place(turned(_meridian(code) + F.degrees(F.atan2(F.sinh(q["y"]), F.cos(q["x"])))), _geodetic(F.asin(F.sin(q["x"]) / F.cosh(q["y"]))))

    return let(let(start, lambda q: _series(q, FROM_PLANE, -1)), degrees)


def zones(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    """zone() of many places; 0 where there is none."""
    number = (np.floor((lon - 360 * np.floor((lon + 180) / 360) + 180) / 6) + 1).astype(np.int64)
    return np.where((lat >= ZONES_SOUTH) & (lat <= ZONES_NORTH), np.where(lat >= 0, 32600, 32700) + number, 0)


def _waves(x: np.ndarray, y: np.ndarray, coefficients: tuple[float, ...], sign: int) -> tuple[np.ndarray, np.ndarray]:
    """_series() of many: sines of multiples of twice x by powers of one complex number, as exp(2iz) has them."""
    s, c, up = np.sin(2 * x), np.cos(2 * x), np.exp(2 * y)
    sh, ch = (up - 1 / up) / 2, (up + 1 / up) / 2
    sh = np.where(np.abs(y) < 0.05, np.sinh(2 * y), sh)
    outx, outy, p, q, a, b = x, y, s, c, sh, ch
    for c_ in coefficients:
        outx, outy = outx + sign * c_ * p * b, outy + sign * c_ * q * a
        p, q, a, b = p * c + q * s, q * c - p * s, a * ch + b * sh, b * ch + a * sh
    return outx, outy


def _from_meridian(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return codes % 100 * 6 - 183.0, np.where(codes > 32700, FALSE_NORTHING, 0.0)


def to_zones(lon: np.ndarray, lat: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """to_zone() of many places."""
    meridian, north = _from_meridian(codes)
    away = lon - meridian
    lam, s = np.radians(away - 360 * np.floor((away + 180) / 360)), np.sin(np.radians(lat))
    tangent = np.sinh(np.arctanh(s) - E * np.arctanh(E * s))
    c = np.cos(lam)
    x, y = _waves(np.arctan2(tangent, c), np.arcsinh(np.sin(lam) / np.hypot(tangent, c)), TO_PLANE, 1)
    return FALSE_EASTING + SCALE * RECTIFYING * y, north + SCALE * RECTIFYING * x


def from_zones(east: np.ndarray, north: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """from_zone() of many places."""
    meridian, false = _from_meridian(codes)
    x, y = _waves((north - false) / (SCALE * RECTIFYING), (east - FALSE_EASTING) / (SCALE * RECTIFYING), FROM_PLANE, -1)
    conformal = np.arcsin(np.sin(x) / np.cosh(y))
    lat = conformal + sum(c * np.sin(2 * j * conformal) for j, c in enumerate(TO_GEODETIC, 1))
    lon = meridian + np.degrees(np.arctan2(np.sinh(y), np.cos(x)))
    return lon - 360 * np.floor((lon + 180) / 360), np.degrees(lat)


def _polar(code: int) -> tuple[int, float, float]:
    """Side (1 north, -1 south), meridian, and metres for each unit of exp(-isometric latitude)."""
    parallel, meridian = POLAR[code]
    s = abs(math.sin(math.radians(parallel)))
    scale = A * math.cos(math.radians(parallel)) / math.sqrt(1 - E * E * s * s) * math.exp(math.atanh(s) - E * math.atanh(E * s))
    return (1 if parallel > 0 else -1), meridian, scale


def to_polar(p: Column, code: int = 3413) -> Column:
    """Metres on the polar grid of that code from a place in degrees; the other pole has no place there."""
    side, meridian, scale = _polar(code)
    out = lambda q: place(q["y"] * F.sin(q["x"]), -side * q["y"] * F.cos(q["x"]))
    return let(place(F.radians(p["x"] - meridian), scale * F.exp(-_isometric(side * p["y"]))), out)


def from_polar(p: Column, code: int = 3413) -> Column:
    """The place in degrees of metres on the polar grid of that code; the pole has the grid's meridian."""
    side, meridian, scale = _polar(code)
    angle = F.when((p["x"] == 0) & (p["y"] == 0), 0.0).otherwise(F.atan2(p["x"], -side * p["y"]))
    conformal = math.pi / 2 - 2 * F.atan(F.hypot(p["x"], p["y"]) / scale)
    return let(conformal, lambda c: place(turned(meridian + F.degrees(angle)), side * _geodetic(c)))


def projected(ring: Column, of: Callable[[Column], Column]) -> Column:
    """A ring with each corner projected; sides stay straight in the plane they are taken to."""
    return F.transform(ring, lambda p: of(p))
