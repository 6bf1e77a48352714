"""The query surface of a collection: filter, box, time range, sort and page; access lists; which analysers run; a trained classifier."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.filters import Filter
from tidewatch.plans import tables

# Rows a query may ask for; the analysers.
MOST_ROWS = 50_000
ANALYZERS = {1: "AIS", 2: "INFRASTRUCTURE", 3: "DARK", 4: "NATURAL"}


def items(rows: DataFrame, limit: int = 10, offset: int = 0, bbox: str | None = None, datetime: str | None = None, filter: str | dict | None = None, sortby: str | None = None, **equal) -> tuple[DataFrame, DataFrame]:
    """The page of rows (lon, lat, ts ...) that a query asks for, and its one row of counts (number_matched, number_returned).

    bbox is four numbers, corners in any order; datetime one time, or a/b, either end of which may be ..; sortby names columns with
    + or -, nulls last; filter is a text or a tree, see filters.py; more names are columns that have to equal a value. A column that isn't there is an error, as are more than
    MOST_ROWS rows and a negative offset.
    """
    if not 0 <= limit <= MOST_ROWS or offset < 0:
        raise ValueError(f"limit is 0 to {MOST_ROWS}, offset 0 or more")
    unknown = [c for c in equal if c not in rows.columns]
    if unknown:
        raise ValueError(f"no such columns: {', '.join(unknown)}")
    if bbox:
        x0, y0, x1, y1 = map(float, bbox.split(","))
        rows = rows.where(F.col("lon").between(min(x0, x1), max(x0, x1)) & F.col("lat").between(min(y0, y1), max(y0, y1)))
    if datetime:
        start, _, end = datetime.partition("/")
        at = lambda t: F.lit(t.rstrip("Z")).cast("timestamp")
        if "/" not in datetime:
            rows = rows.where(F.col("ts") == at(start))
        else:
            rows = rows.where((F.lit(True) if start in ("", "..") else F.col("ts") >= at(start)) & (F.lit(True) if end in ("", "..") else F.col("ts") <= at(end)))
    if filter:
        rows = rows.where(Filter(rows.columns).column(filter, rows.sparkSession))
    for c, v in equal.items():
        rows = rows.where(F.col(c) == v)
    order = [F.desc_nulls_last(c[1:]) if c[0] == "-" else F.asc_nulls_last(c.lstrip("+")) for c in (sortby or "").split(",") if c]
    page = (rows.orderBy(*order) if order else rows).offset(offset).limit(limit)
    matched = F.count("*")
    counts = rows.agg(matched.alias("number_matched"), F.greatest(F.lit(0), F.least(F.lit(limit), matched - offset)).cast("long").alias("number_returned"))
    return page, counts


def restricted(text: str | None) -> list[str]:
    """A list of collections from JSON, or parted by commas."""
    if text is None:
        return []
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        return text.split(",")


def collection(name: str, excluded: list[str], key: str | None, secret: str | None) -> str:
    """name, if the caller may read it: of those that are excluded, only with the right key."""
    if name in excluded and key != secret:
        raise PermissionError(f"403: access to {name} is restricted")
    return name


def analyzers(run_flags: list[str] | None) -> list[str]:
    """The analysers that run: all without flags, none for an empty list; another name is an error."""
    if run_flags is None:
        return list(ANALYZERS.values())
    unknown = sorted(set(run_flags) - set(ANALYZERS.values()))
    if unknown:
        raise ValueError(f"no such analysers: {', '.join(unknown)}")
    return [a for a in ANALYZERS.values() if a in run_flags]


def queued_flags(run_flags: list[str] | None) -> list[str] | None:
    """Flags as a queued task has them: an empty list is left out there and so becomes all."""
    return run_flags or None


#: What the classifier of detections needs.
FEATURES = ("area", "polsby_popper", "fill_factor", "aspect_ratio_factor", "geometry_count", "largest_area", "median_area", "machine_confidence")


def classified(train: DataFrame, rows: DataFrame, trees: int = 20, seed: int = 7) -> DataFrame:
    """rows with slick_confidence: a random forest's probability of label 1, learnt from train (FEATURES and label). A null in any of the
    features is an error that names it."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    missing = rows.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in FEATURES]).first()
    empty = [c for c in FEATURES if missing[c]]
    if empty:
        raise ValueError(f"features without a value: {', '.join(empty)}")
    gather = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    model = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=trees, maxDepth=5, seed=seed).fit(gather.transform(train))
    out = model.transform(gather.transform(rows))
    return out.withColumn("slick_confidence", vector_to_array("probability")[1]).drop("_features", "rawPrediction", "probability", "prediction")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables.table(spark, sf_dir, "orders")
    lon, lat = -100 + (F.col("o_orderkey") * 37 % 2000) / 10, -50 + (F.col("o_orderkey") * 53 % 1000) / 10
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("ts"), lon.alias("lon"), lat.alias("lat"), F.col("o_totalprice").alias("area"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))


QUERY = {"limit": 40, "offset": 3, "bbox": "-10.5,60.3,80.7,-42.1", "datetime": "1994-01-01T00:00:00Z/..", "filter": "area GTE 150000 AND (LOWER(priority) LIKE '%gt urgent%' OR NOT status EQ 'P') AND priority IS NOT NULL", "sortby": "-area,id", "status": "O"}


def collection_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of a filtered collection."""
    return items(_places(spark, sf_dir), **QUERY)[0].select("id", "lon", "lat", "area", "priority", "status")


def collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """numbers matched and returned."""
    return items(_places(spark, sf_dir), **QUERY)[1]


#: Filters in both forms: a text with a shape and a time range, and a tree.
FILTERS = {
    "text": "S_INTERSECTS(geom, POLYGON((-60 -40, 70.5 -20, 40 45, -30 30, -60 -40))) AND T_INTERSECTS(ts, INTERVAL('1994-03-01T00:00:00Z', '..')) AND (CASEI(priority) LIKE '%urgent' OR area BETWEEN 200000 AND 250000.5) AND status IN ('O', 'P')",
    "tree": {"op": "and", "args": [{"op": "s_intersects", "args": [{"property": "geom"}, {"bbox": [-50, -30, 20, 35]}]}, {"op": "not", "args": [{"op": "=", "args": [{"property": "status"}, "F"]}]}, {"op": ">", "args": [{"op": "/", "args": [{"property": "area"}, 1000]}, 90]}, {"op": "t_before", "args": [{"property": "ts"}, {"timestamp": "1997-01-01T00:00:00Z"}]}]},
}


def filtered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections that each of the filters lets through."""
    rows = _places(spark, sf_dir)
    f = Filter([*rows.columns, "geom"])
    return rows.select("id", *[F.coalesce(f.column(x, spark), F.lit(False)).alias(n) for n, x in FILTERS.items()]).where("text or tree")


def filtered_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines that meet a polygon, and those within it."""
    rows = tables.outlines(spark, sf_dir)
    f = Filter(rows.columns, ring="ring")
    shape = "POLYGON((-149.9 -49.9, -148.6 -49.8, -147.7 -49.4, -148.2 -49.5, -149.7 -49.6, -149.9 -49.9))"
    rows = rows.withColumns({"meets": f.column(f"S_INTERSECTS(ring, {shape})", spark), "within": f.column(f"S_WITHIN(ring, {shape})", spark)})
    return rows.where("meets or within").select("id", "meets", "within")


QUERIES = {f.__name__: f for f in (collection_items, collection_counts, filtered_items, filtered_outlines)}
_WHERE = """FROM (SELECT o_orderkey AS id, o_orderdate AS ts, -100 + (o_orderkey * 37 % 2000) / 10 AS lon, -50 + (o_orderkey * 53 % 1000) / 10 AS lat, o_totalprice AS area, o_orderpriority AS priority, o_orderstatus AS status FROM orders)
WHERE lon >= -10.5 AND lon <= 80.7 AND lat >= -42.1 AND lat <= 60.3 AND ts >= TIMESTAMP '1994-01-01' AND area >= 150000 AND (lower(priority) LIKE '%gt urgent%' OR status <> 'P') AND priority IS NOT NULL AND status = 'O'"""
_PLACES = _WHERE.split("\n")[0].replace("FROM (", "", 1)[:-1]
_INSIDE = "(SELECT count(*) FROM (VALUES {sides}) AS s(ax, ay, ex, ey) WHERE (ay > {y}) <> (ey > {y}) AND {x} < (ex - ax) * ({y} - ay) / (ey - ay) + ax) % 2 = 1"


def _sides(text: str) -> str:
    p = [x.split() for x in text.split(", ")]
    return ", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for a, b in zip(p, p[1:], strict=False))


_CLIP = "-149.9 -49.9, -148.6 -49.8, -147.7 -49.4, -148.2 -49.5, -149.7 -49.6, -149.9 -49.9"
_CROSS = "sign((s.ex - s.ax) * (t.ay - s.ay) - (s.ey - s.ay) * (t.ax - s.ax)) * sign((s.ex - s.ax) * (t.ey - s.ay) - (s.ey - s.ay) * (t.ex - s.ax)) < 0 AND sign((t.ex - t.ax) * (s.ay - t.ay) - (t.ey - t.ay) * (s.ax - t.ax)) * sign((t.ex - t.ax) * (s.ey - t.ay) - (t.ey - t.ay) * (s.ex - t.ax)) < 0"
ORACLES = {
    "collection_items": f"SELECT id, lon, lat, area, priority, status {_WHERE} ORDER BY area DESC, id LIMIT 40 OFFSET 3",
    "collection_counts": f"SELECT count(*) AS number_matched, greatest(0, least(40, count(*) - 3)) AS number_returned {_WHERE}",
    "filtered_items": f"""SELECT id, text, tree FROM (SELECT id, {_INSIDE.format(sides=_sides("-60 -40, 70.5 -20, 40 45, -30 30, -60 -40"), x="lon", y="lat")} AND ts >= TIMESTAMP '1994-03-01' AND (lower(priority) LIKE '%urgent' OR area BETWEEN 200000 AND 250000.5) AND status IN ('O', 'P') AS text,
    lon BETWEEN -50 AND 20 AND lat BETWEEN -30 AND 35 AND status <> 'F' AND area / 1000 > 90 AND ts < TIMESTAMP '1997-01-01' AS tree FROM ({_PLACES})) WHERE text OR tree""",
    "filtered_outlines": f"""WITH c AS ({tables.CORNERS}), side AS (SELECT a.id, a.x AS ax, a.y AS ay, b.x AS ex, b.y AS ey FROM c a JOIN c b ON a.id = b.id AND b.k = (a.k + 1) % a.n),
t AS (FROM (VALUES {_sides(_CLIP)}) AS t(ax, ay, ex, ey)),
r AS (SELECT s.id, bool_or({_CROSS}) AS crossed FROM side s, t GROUP BY s.id),
p AS (SELECT id, bool_and({_INSIDE.format(sides=_sides(_CLIP), x="c.x", y="c.y")}) AS held, bool_or({_INSIDE.format(sides=_sides(_CLIP), x="c.x", y="c.y")}) AS any_in FROM c GROUP BY id)
SELECT id, crossed OR any_in AS meets, held AND NOT crossed AS within FROM r JOIN p USING (id) WHERE crossed OR any_in""",
}
