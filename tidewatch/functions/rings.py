"""Rings and pairs of rings, a batch of Arrow rows at a time: measures on the WGS84 ellipsoid, and distances on a local plane.

Corners of all rows are one array of numbers, so that no ring is looked at by itself.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.functions.geometry import METRES_X, METRES_Y

# The ellipsoid's greater half axis and flattening.
A, FLATTENING = 6378137.0, 1 / 298.257223563
B, E2 = A * (1 - FLATTENING), FLATTENING * (2 - FLATTENING)


def corners(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the rows, x and y of all their corners; a null ring has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), flat.field("x").to_numpy(zero_copy_only=False), flat.field("y").to_numpy(zero_copy_only=False)


def picked(off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of some rows one after the other, and where their corners stand."""
    n = off[rows + 1] - off[rows]
    new = np.concatenate([[0], np.cumsum(n)])
    return new, np.arange(new[-1]) - np.repeat(new[:-1], n) + np.repeat(off[rows], n)


def following(off: np.ndarray) -> np.ndarray:
    """For each corner where the next one of its ring stands."""
    out = np.arange(1, off[-1] + 1)
    full = off[1:] > off[:-1]
    out[off[1:][full] - 1] = off[:-1][full]
    return out


def summed(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of the values of each row, 0 for rows without any."""
    out, full = np.zeros(len(off) - 1), off[1:] > off[:-1]
    if len(values):
        out[full] = np.add.reduceat(values, off[:-1][full])
    return out


def zone(latitude: np.ndarray) -> np.ndarray:
    """Square metres of the ellipsoid between the equator and a latitude, for each radian of longitude."""
    s, e = np.sin(np.radians(latitude)), E2**0.5
    return A * A * (1 - E2) / 2 * (s / (1 - E2 * s * s) + np.arctanh(e * s) / e)


def geodesic(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Metres along the ellipsoid between places in degrees (Vincenty's inverse); nearly opposite places don't settle and are null."""
    u, v = (np.arctan((1 - FLATTENING) * np.tan(np.radians(y))) for y in (ay, by))
    span = np.radians((bx - ax + 180) % 360 - 180)
    lam, su, cu, sv, cv = span.copy(), np.sin(u), np.cos(u), np.sin(v), np.cos(v)
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(rounds):
            sin_sigma = np.hypot(cv * np.sin(lam), cu * sv - su * cv * np.cos(lam))
            cos_sigma = su * sv + cu * cv * np.cos(lam)
            sigma = np.arctan2(sin_sigma, cos_sigma)
            sin_alpha = np.where(sin_sigma == 0, 0.0, cu * cv * np.sin(lam) / sin_sigma)
            cos2 = 1 - sin_alpha**2
            mid = np.where(cos2 == 0, 0.0, cos_sigma - 2 * su * sv / cos2)
            c = FLATTENING / 16 * cos2 * (4 + FLATTENING * (4 - 3 * cos2))
            was, lam = lam, span + (1 - c) * FLATTENING * sin_alpha * (sigma + c * sin_sigma * (mid + c * cos_sigma * (2 * mid**2 - 1)))
            if (np.abs(lam - was) < 1e-13).all():
                break
        k2 = cos2 * (A * A - B * B) / (B * B)
        p = 1 + k2 / 16384 * (4096 + k2 * (k2 * (320 - 175 * k2) - 768))
        q = k2 / 1024 * (256 + k2 * (k2 * (74 - 47 * k2) - 128))
        turn = q * sin_sigma * (mid + q / 4 * (cos_sigma * (2 * mid**2 - 1) - q / 6 * mid * (4 * sin_sigma**2 - 3) * (4 * mid**2 - 3)))
    out = np.where(sin_sigma == 0, 0.0, B * p * (sigma - turn))
    return np.where(np.abs(lam - was) < 1e-9, out, np.nan)


MEASURES = ("area", "perimeter", "cx", "cy")


def ring_measures(off: np.ndarray, x: np.ndarray, y: np.ndarray, wanted: Iterable[str] = MEASURES) -> dict[str, np.ndarray]:
    """Area and perimeter on the ellipsoid in metres, and the centre of the area on the plane of degrees; of a ring without area the mean of its corners. Only
    those that are wanted are worked out."""
    nxt = following(off)
    out = {}
    if "area" in wanted:
        out["area"] = np.abs(summed(np.radians(x[nxt] - x) * (zone(y) + zone(y[nxt])) / 2, off))
    if "perimeter" in wanted:
        out["perimeter"] = summed(geodesic(x, y, x[nxt], y[nxt]), off)
    if not {"cx", "cy"} & set(wanted):
        return out
    n = np.diff(off)
    first = np.repeat(off[:-1], n)
    dx, dy = x - x[first], y - y[first]
    ex, ey = dx[nxt], dy[nxt]
    cross = dx * ey - ex * dy
    twice = summed(cross, off)
    with np.errstate(divide="ignore", invalid="ignore"):
        for name, v, d, e in (("cx", x, dx, ex), ("cy", y, dy, ey)):
            start = np.full(len(n), np.nan)
            start[n > 0] = v[off[:-1][n > 0]]
            out[name] = np.where(twice == 0, summed(v, off) / n, start + summed((d + e) * cross, off) / (3 * twice))
    return out


def with_measures(rows: DataFrame, ring: str = "ring", wanted: dict[str, str] | None = None) -> DataFrame:
    """rows with measures of a column of rings: those that are wanted, under the given names, or all of MEASURES."""
    wanted = wanted or {c: c for c in MEASURES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = ring_measures(*corners(b.column(ring)), wanted)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(found[c], from_pandas=True) for c in wanted)], names=[*b.schema.names, *wanted.values()])

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), *(f"`{c}` double" for c in wanted.values())]))


def with_areas(rows: DataFrame, parts: str, name: str) -> DataFrame:
    """rows with the areas on the ellipsoid of a column of arrays of rings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(parts)
            sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
            found = pa.array(ring_measures(*corners(column.flatten()), ["area"])["area"])
            areas = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), found)
            yield pa.RecordBatch.from_arrays([*b.columns, areas], names=[*b.schema.names, name])

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), f"`{name}` array<double>"]))


def with_sides(rows: DataFrame, ring: str) -> DataFrame:
    """rows with sides: the lengths of a ring's sides in metres along the ellipsoid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, x, y = corners(b.column(ring))
            nxt = following(off)
            sides = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(geodesic(x, y, x[nxt], y[nxt]), from_pandas=True))
            yield pa.RecordBatch.from_arrays([*b.columns, sides], names=[*b.schema.names, "sides"])

    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "sides array<double>"]))


def _to_side(px, py, ax, ay, bx, by) -> np.ndarray:
    dx, dy = bx - ax, by - ay
    n = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(n == 0, 0.0, np.clip(((px - ax) * dx + (py - ay) * dy) / n, 0, 1))
    return np.hypot(px - ax - t * dx, py - ay - t * dy)


def _inside(px, py, ax, ay, bx, by) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        over = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
    return over.sum(-1) % 2 == 1


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of pairs of polygons, arrays (pair, corner, axis) on a plane; 0 where they meet or one holds the other. One corner is a point."""
    p, q = a[:, :, None], b[:, None, :]
    pe, qe = np.roll(a, -1, 1)[:, :, None], np.roll(b, -1, 1)[:, None, :]
    (ax, ay, bx, by), (cx, cy, dx, dy) = ((s[..., 0], s[..., 1], e[..., 0], e[..., 1]) for s, e in ((p, pe), (q, qe)))
    least = np.minimum(np.minimum(_to_side(ax, ay, cx, cy, dx, dy), _to_side(cx, cy, ax, ay, bx, by)).min((1, 2)), np.inf)
    turn = lambda ax, ay, bx, by, px, py: (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    over = (turn(ax, ay, bx, by, cx, cy) * turn(ax, ay, bx, by, dx, dy) < 0) & (turn(cx, cy, dx, dy, ax, ay) * turn(cx, cy, dx, dy, bx, by) < 0)
    sides = lambda r: (r[:, :, 0], r[:, :, 1], np.roll(r, -1, 1)[:, :, 0], np.roll(r, -1, 1)[:, :, 1])
    held = _inside(a[:, :1, 0], a[:, :1, 1], *sides(b)) | _inside(b[:, :1, 0], b[:, :1, 1], *sides(a))
    return np.where(over.any((1, 2)) | held, 0.0, least)


def pair_distances(a, b, shift: np.ndarray, latitude: np.ndarray) -> np.ndarray:
    """Metres between the rings of each pair, a moved by `shift` degrees, on the plane of a latitude. Pairs of as many corners are looked at together."""
    (aoff, ax, ay), (boff, bx, by) = a, b
    out, kx = np.full(len(aoff) - 1, np.nan), METRES_X * np.cos(np.radians(latitude))
    na, nb = np.diff(aoff), np.diff(boff)
    kinds, which = np.unique(np.stack([na, nb], 1), axis=0, return_inverse=True)
    for k, (m, n) in enumerate(kinds.tolist()):
        rows = np.flatnonzero(which.ravel() == k)
        step = max(1, 2_000_000 // max(1, m * n))
        for at in (rows[i : i + step] for i in range(0, len(rows), step)) if m and n else ():
            i, j = aoff[at][:, None] + np.arange(m), boff[at][:, None] + np.arange(n)
            plane = [np.stack([(vx + s) * kx[at][:, None], vy * METRES_Y], 2) for vx, vy, s in ((ax[i], ay[i], shift[at][:, None]), (bx[j], by[j], 0.0))]
            out[at] = apart(*plane)
    return out


def with_distance(pairs: DataFrame, keep: dict[str, str], a: str, b: str, shift: str, latitude: str) -> DataFrame:
    """(keep: name for column ..., metres) of pairs of rings, see pair_distances()."""
    kinds = dict(pairs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            metres = pair_distances(corners(batch.column(a)), corners(batch.column(b)), batch.column(shift).to_numpy(zero_copy_only=False), batch.column(latitude).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(metres, from_pandas=True)], names=[*keep.values(), "metres"])

    return pairs.select(*keep, a, b, shift, latitude).mapInArrow(run, ", ".join([*(f"{n} {kinds[c]}" for c, n in keep.items()), "metres double"]))
