"""Readers of GeoJSON, zipped shapefiles, vector-tile features, commented CSV, paged archives and rasters' addresses; writers beside them.

Files are opened by Spark's readers only, so that any path of the cluster works. Rings are arrays of (x, y), open.
"""

import io
import json
import math
import struct
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RINGS = "array<array<struct<x: double, y: double>>>"


def geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """A row for each feature of GeoJSON files: the properties asked for (as a schema), gtype and rings (the outer rings of all parts, first part
    first), features without a geometry left out. Polygons and MultiPolygons are read, others have no rings."""
    feature = f"array<struct<type: string, properties: struct<{_fields(properties)}>, geometry: string>>"
    rows = spark.read.schema(f"type string, features {feature}").option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    shape = F.col("f.geometry")
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    ring = lambda r: F.slice(F.transform(r, point), F.lit(1), F.greatest(F.size(r) - 1, F.lit(0)))
    kind = F.get_json_object(shape, "$.type")
    one = F.from_json(F.get_json_object(shape, "$.coordinates"), "array<array<array<double>>>")
    many = F.from_json(F.get_json_object(shape, "$.coordinates"), "array<array<array<array<double>>>>")
    rings = F.when(kind == "Polygon", F.array(ring(one[0]))).when(kind == "MultiPolygon", F.transform(many, lambda p: ring(p[0])))
    return rows.where(shape.isNotNull()).select("f.properties.*", kind.alias("gtype"), rings.alias("rings"))


def _fields(schema: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (x.split() for x in schema.split(",")))


def areas(spark: SparkSession, path: str) -> DataFrame:
    """Areas of interest of a GeoJSON file: GEONAME, the sovereigns that are given as an array, and rings."""
    rows = geojson(spark, path, "GEONAME string, SOVEREIGN1 string, SOVEREIGN2 string, SOVEREIGN3 string")
    return rows.select(F.col("GEONAME").alias("name"), F.filter(F.array("SOVEREIGN1", "SOVEREIGN2", "SOVEREIGN3"), lambda x: x.isNotNull()).alias("sovereigns"), "rings")


def mask_ring(spark: SparkSession, path: str) -> DataFrame:
    """The first outer ring of the first feature of a GeoJSON mask, put right."""
    from tidewatch.functions.geometry import normalised

    rows = geojson(spark, path, "name string").where("rings is not null").withColumn("at", F.monotonically_increasing_id())
    return rows.agg(F.min_by(F.col("rings")[0], "at").alias("ring")).select(normalised(F.col("ring")).alias("ring"))


def shapes(data: bytes) -> list[list[list[tuple[float, float]]]]:
    """The polygons of a .shp file, each with its rings; null shapes have none."""
    out, at = [], 100
    while at + 12 <= len(data):
        (words,) = struct.unpack_from(">i", data, at + 4)
        (kind,) = struct.unpack_from("<i", data, at + 8)
        if kind in (5, 15, 25):
            parts, points = struct.unpack_from("<2i", data, at + 44)
            starts = [*struct.unpack_from(f"<{parts}i", data, at + 52), points]
            flat = struct.unpack_from(f"<{2 * points}d", data, at + 52 + 4 * parts)
            xy = list(zip(flat[::2], flat[1::2], strict=True))
            out.append([xy[a:b] for a, b in zip(starts, starts[1:], strict=False)])
        elif kind == 0:
            out.append([])
        else:
            raise ValueError(f"shape type {kind} is no polygon")
        at += 8 + 2 * words
    return out


def shapefile(spark: SparkSession, path: str) -> DataFrame:
    """(path, shape, rings) of the polygons of zipped shapefiles; a zip without just one .shp is an error. A file is read by one task."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    inside = [n for n in z.namelist() if n.lower().endswith(".shp")]
                    if len(inside) != 1:
                        raise ValueError(f"{name} holds {len(inside)} .shp files, not one")
                    found = shapes(z.read(inside[0]))
                yield pd.DataFrame({"path": name, "shape": range(len(found)), "rings": [[[{"x": x, "y": y} for x, y in (r[:-1] if r[0] == r[-1] else r)] for r in s] for s in found]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, f"path string, shape long, rings {RINGS}")


def tile_features(tiles: DataFrame, scene_start: Column) -> DataFrame:
    """Features of decoded vector tiles (features: JSON array of objects with properties): structure_id, lat, lon, label, start and end. An
    empty text is no time; times are milliseconds; an end that isn't given is the start of the scene's month."""
    kind = "array<struct<properties: struct<structure_id: string, lat: double, lon: double, label: string, structure_start_date: string, structure_end_date: string>>>"
    rows = tiles.withColumn("month", F.date_trunc("month", scene_start)).select("month", F.explode(F.from_json("features", kind)).alias("f")).select("month", "f.properties.*")
    at = lambda c: F.timestamp_millis(F.expr(f"try_cast(nullif({c}, '') AS bigint)"))
    return rows.select(F.expr("try_cast(structure_id AS bigint)").alias("structure_id"), "lat", "lon", "label", at("structure_start_date").alias("structure_start_date"), F.coalesce(at("structure_end_date"), F.col("month")).alias("structure_end_date"))


def commented_csv(spark: SparkSession, path: str, header: list[str]) -> tuple[DataFrame, list[dict]]:
    """The rows of a CSV whose first lines may be comments (#), and what its `# locale:{json}` lines hold; another header is an error.
    Comments and header are looked for among the lines of the file's head only."""
    text = spark.read.text(path).withColumnRenamed("value", "line")
    marks = [r.line for r in text.where("line like '#%'").limit(1000).collect()]
    first = text.where("line not like '#%' and trim(line) != ''").limit(1).collect()
    if not first or [c.strip() for c in first[0].line.split(",")] != header:
        raise ValueError(f"the header has to be {','.join(header)}")
    locales = [json.loads(m.split("locale:", 1)[1]) for m in marks if m.lstrip("# ").startswith("locale:")]
    schema = ", ".join(f"{c} string" for c in header)
    return spark.read.schema(schema).option("header", True).option("comment", "#").csv(path), locales


def paged(spark: SparkSession, fetch: Callable[[int, int], list[dict]], total: int, schema: str, size: int = 25) -> DataFrame:
    """The rows of an archive that gives `size` at a time: fetch(first, size) runs in tasks, a page each."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for page in b["id"]:
                if rows := fetch(int(page) * size, size):
                    yield pd.DataFrame(rows)

    pages = math.ceil(total / size)
    return spark.range(pages, numPartitions=max(1, min(pages, 1000))).mapInPandas(read, schema)


def tile_address(base: Column, scene_id: Column, z: Column, x: Column, y: Column, scale: int = 1, band: str = "vv") -> Column:
    """The address of a raster tile."""
    return F.concat(base, F.lit("/tiles/WorldCRS84Quad/"), z.cast("string"), F.lit("/"), x.cast("string"), F.lit("/"), y.cast("string"), F.lit(f"@{scale}x?sceneid="), F.url_encode(scene_id), F.lit(f"&bands={band}"))


def box_address(base: Column, scene_id: Column, box: list[Column], width: int, height: int, band: str = "vv") -> Column:
    """The address of a raster cut to a box."""
    return F.concat(base, F.lit("/crop/"), F.concat_ws(",", *[b.cast("string") for b in box]), F.lit(f"/{width}x{height}.png?sceneid="), F.url_encode(scene_id), F.lit(f"&bands={band}"))


def aux_year(scene_start: Column, newest: int, fallback: int = 2019) -> Column:
    """The year whose ship density is asked for: the scene's, or the fallback where there is none yet."""
    return F.when(F.year(scene_start) <= newest, F.year(scene_start)).otherwise(F.lit(fallback))


def product_path(scene_id: Column) -> Column:
    """Where a scene's product information lies."""
    day = F.to_date(F.substring(scene_id, 18, 8), "yyyyMMdd")
    part = lambda n: F.element_at(F.split(scene_id, "_"), n)
    return F.concat_ws("/", F.lit("GRD"), F.year(day).cast("string"), F.month(day).cast("string"), F.day(day).cast("string"), part(2), F.right(part(4), F.lit(2)), scene_id, F.lit("productInfo.json"))


def write_geojson(features: DataFrame, path: str) -> None:
    """features (rings and others) as files of one GeoJSON feature a line."""
    closed = F.transform("rings", lambda r: F.array(F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.array(p["x"], p["y"]))))
    shape = F.struct(F.lit("MultiPolygon").alias("type"), closed.alias("coordinates"))
    properties = F.struct(*[c for c in features.columns if c != "rings"])
    features.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), shape.alias("geometry"))).alias("value")).write.text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """rows as CSV files with a header."""
    rows.write.option("header", True).csv(path)


def write_log(rows: DataFrame, path: str) -> None:
    """rows as JSON lines, as logs have them."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(path)
