"""Filters that callers of the query surface write, as columns: a closed list of operators, nothing else runs.

A filter is a tree in the JSON form of CQL2 ({"op": ..., "args": [...]}), or a text. Texts are read by Spark's own expression parser, and the
tree that it gives is translated node by node into the same operators; a node, a function or a column that isn't on the list is
an error, so that no function of Spark can be reached by its name.
"""

import functools
import operator
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import geometry as geo

# Words for signs, and the signs of comparisons.
WORDS = {"GT": ">", "GTE": ">=", "EQ": "=", "LT": "<", "LTE": "<=", "NEQ": "<>"}
COMPARE = {"=": operator.eq, "<>": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
ARITHMETIC = {"+": operator.add, "-": operator.sub, "*": operator.mul, "/": operator.truediv, "%": operator.mod}
#: Nodes of the parser's trees that are operators of the list.
NODES = {
    "And": "and", "Or": "or", "Not": "not", "EqualTo": "=", "LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">=",
    "Add": "+", "Subtract": "-", "Multiply": "*", "Divide": "/", "Remainder": "%", "UnaryMinus": "-", "IsNull": "isNull", "IsNotNull": "isNotNull", "Like": "like", "In": "in",
}
#: Functions that a text may name.
FUNCTIONS = {"lower": "casei", "casei": "casei", "upper": "upper", "between": "between", "s_intersects": "s_intersects", "s_within": "s_within", "t_intersects": "t_intersects", "t_after": "t_after", "t_before": "t_before", "t_during": "t_during", "timestamp": "timestamp", "date": "date", "interval_of": "interval", "and": "and", "or": "or", "not": "not", "like": "like", "in": "in", "isnull": "isNull", "isnotnull": "isNotNull"}
SHAPE = re.compile(r"\b(POLYGON\s*\(\([^()]*\)\)|POINT\s*\([^()]*\)|(?:BBOX|ENVELOPE)\s*\([^()]*\))", re.I)
DEEPEST = 200


class Filter:
    """Translates filters over given columns; point names the columns of a row's place, ring the one of its outline, if it has one."""

    def __init__(self, columns: list[str], point: tuple[str, str] = ("lon", "lat"), ring: str | None = None):
        self.columns, self.point, self.ring = set(columns), point, ring

    def column(self, given: str | dict, spark: SparkSession | None = None) -> Column:
        return self._column(given if isinstance(given, dict) else _tree(given, spark or SparkSession.active()), 0)

    def _column(self, node, depth: int) -> Column:
        if depth > DEEPEST:
            raise ValueError(f"a filter is nested {DEEPEST} deep at most")
        if not isinstance(node, dict):
            return F.lit(node)
        if "property" in node:
            if node["property"] not in self.columns:
                raise ValueError(f"no such column: {node['property']}")
            return F.col(node["property"])
        for kind in ("timestamp", "date"):
            if kind in node:
                return _time(node[kind]) if kind == "timestamp" else _time(node[kind]).cast("date")
        if set(node) != {"op", "args"}:
            raise ValueError(f"no operator: {sorted(node)}")
        op, args = node["op"], node["args"]
        if op in ("s_intersects", "s_within"):
            return self._meets(op, args)
        if op in ("t_intersects", "t_during", "t_after", "t_before"):
            return self._when(op, args, depth)
        if op == "in":
            given = args[1] if isinstance(args[1], list) else args[1:]
            return self._column(args[0], depth + 1).isin(*[self._column(x, depth + 1) for x in given])
        of = [self._column(x, depth + 1) for x in args]
        if op in ("and", "or") and of:
            return functools.reduce(operator.and_ if op == "and" else operator.or_, of)
        if op in COMPARE and len(of) == 2:
            return COMPARE[op](*of)
        if op == "-" and len(of) == 1:
            return -of[0]
        if op in ARITHMETIC and len(of) == 2:
            return ARITHMETIC[op](*of)
        if (make := {("not", 1): lambda a: ~a, ("isNull", 1): lambda a: a.isNull(), ("isNotNull", 1): lambda a: a.isNotNull(), ("like", 2): lambda a, b: F.like(a, b), ("between", 3): lambda a, b, c: a.between(b, c), ("casei", 1): F.lower, ("upper", 1): F.upper, ("timestamp", 1): lambda a: a.cast("timestamp"), ("date", 1): lambda a: a.cast("date")}.get((op, len(of)))):
            return make(*of)
        raise ValueError(f"no such operator: {op} of {len(of)}")

    def _meets(self, op: str, args: list) -> Column:
        """Whether a row's place or outline has a point in common with a shape, or lies in it."""
        if len(args) != 2 or not isinstance(args[0], dict) or "property" not in args[0]:
            raise ValueError(f"{op} takes a geometry and a shape")
        corners = _corners(args[1])
        shape = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in corners])
        sides = geo.edges(shape)
        if self.ring is None:
            x, y = map(F.col, self.point)
            if len(corners) == 1:
                return (x == corners[0][0]) & (y == corners[0][1])
            return geo.point_distance(sides, x, y) == 0
        own = geo.edges(F.col(self.ring))
        if op == "s_within":
            exact = F.forall(F.col(self.ring), lambda p: geo.contains(sides, p["x"], p["y"])) & ~_cross(own, sides)
        elif len(corners) == 1:
            exact = geo.point_distance(own, *map(F.lit, corners[0])) == 0
        else:
            exact = geo.distance(own, sides) == 0
        # a ring all on one side of the shape's box needs no comparison of sides
        beside = lambda c, v: F.forall(F.col(self.ring), lambda p: p[c] < min(v)) | F.forall(F.col(self.ring), lambda p: p[c] > max(v))
        xs, ys = zip(*corners, strict=True)
        return F.when((F.size(self.ring) > 0) & (beside("x", xs) | beside("y", ys)), F.lit(False)).otherwise(exact)

    def _when(self, op: str, args: list, depth: int) -> Column:
        at = self._column(args[0], depth + 1)
        span = args[1]
        ends = span["args"] if isinstance(span, dict) and span.get("op") == "interval" else span.get("interval") if isinstance(span, dict) else None
        if ends is not None:
            start, end = (None if x == ".." else _time(x) if isinstance(x, str) else self._column(x, depth + 1) for x in ends)
        else:
            start = end = self._column(span, depth + 1)
        if op == "t_after":
            return F.lit(False) if end is None else at > end
        if op == "t_before":
            return F.lit(False) if start is None else at < start
        held = (operator.gt, operator.lt) if op == "t_during" else (operator.ge, operator.le)
        return (F.lit(True) if start is None else held[0](at, start)) & (F.lit(True) if end is None else held[1](at, end))


def _cross(a: Column, b: Column) -> Column:
    turn = lambda ax, ay, bx, by, px, py: (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    sides = lambda s, t: turn(s["ax"], s["ay"], s["bx"], s["by"], t["ax"], t["ay"]) * turn(s["ax"], s["ay"], s["bx"], s["by"], t["bx"], t["by"]) < 0
    return F.exists(a, lambda s: F.exists(b, lambda t: sides(s, t) & sides(t, s)))


def _time(text: str) -> Column:
    return F.lit(text.rstrip("Zz").replace("T", " ")).cast("timestamp")


def _corners(shape: str | dict) -> list[tuple[float, float]]:
    """The corners of a polygon, a box or a point, as WKT or GeoJSON."""
    if isinstance(shape, dict):
        if "bbox" in shape:
            return _box(shape["bbox"])
        flat = {"Polygon": lambda c: c[0], "Point": lambda c: [c]}[shape["type"]](shape["coordinates"])
        points = [(float(p[0]), float(p[1])) for p in flat]
    else:
        kind, inside = re.fullmatch(r"(\w+)\s*\(+([^()]*)\)+", shape.strip()).groups()
        if kind.upper() in ("BBOX", "ENVELOPE"):
            return _box([float(x) for x in inside.split(",")])
        points = [tuple(map(float, p.split()[:2])) for p in inside.split(",")]
    return points[:-1] if len(points) > 1 and points[0] == points[-1] else points


def _box(b: list[float]) -> list[tuple[float, float]]:
    x0, y0, x1, y1 = b if len(b) == 4 else (b[0], b[1], b[3], b[4])
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def _tree(text: str, spark: SparkSession) -> dict:
    """The operators of a text, by Spark's parser of expressions."""
    parts = re.split(r"('(?:[^']|'')*')", text)
    signs = "".join(p if n % 2 else re.sub(r"\b(GTE|GT|EQ|LTE|LT|NEQ)\b", lambda m: WORDS[m[0].upper()], re.sub(r"\bINTERVAL\s*\(", "INTERVAL_OF(", SHAPE.sub(lambda m: f"'{m[0]}'", p), flags=re.I), flags=re.I) for n, p in enumerate(parts))
    return _node(spark._jsparkSession.sessionState().sqlParser().parseExpression(signs), 0)


def _node(node, depth: int) -> dict | str | int | float | bool | None:
    if depth > DEEPEST:
        raise ValueError(f"a filter is nested {DEEPEST} deep at most")
    kind, below = node.getClass().getSimpleName(), node.children()
    of = lambda: [_node(below.apply(i), depth + 1) for i in range(below.size())]
    if kind == "UnresolvedAttribute":
        if node.nameParts().size() != 1:
            raise ValueError(f"no such column: {node.sql()}")
        return {"property": node.nameParts().apply(0)}
    if kind == "Literal":
        return _value(node)
    if kind == "UnresolvedFunction":
        name = node.nameParts().apply(node.nameParts().size() - 1).lower()
        if node.nameParts().size() != 1 or name not in FUNCTIONS or node.isDistinct() or node.filter().isDefined():
            raise ValueError(f"no such function: {name}")
        return {"op": FUNCTIONS[name], "args": of()}
    if kind not in NODES:
        raise ValueError(f"no such operator: {kind}")
    return {"op": NODES[kind], "args": of()}


def _value(node):
    kind, value = node.dataType().typeName(), node.value()
    if value is None or kind in ("boolean", "integer", "long", "double", "float", "byte", "short"):
        return value
    if kind.startswith("decimal"):
        return float(value.toString())
    if kind == "string":
        return value.toString()
    if kind == "date":
        return {"date": node.sql().split("'")[1]}
    if kind.startswith("timestamp"):
        return {"timestamp": node.sql().split("'")[1]}
    raise ValueError(f"no such value: {node.sql()}")
