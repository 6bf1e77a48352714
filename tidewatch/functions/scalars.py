"""Scalar functions of the scene and log records, as column expressions."""

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans import tables


def scene_start(scene_id: Column) -> Column:
    """The moment that a scene id has from its 18th character on, as yyyyMMddTHHmmss; null if it has none."""
    return F.try_to_timestamp(F.substring(scene_id, 18, 15), F.lit("yyyyMMdd'T'HHmmss"))


def scene_fields(scene_id: Column) -> dict[str, Column]:
    """mode, resolution, polarization and the day of a scene id."""
    part = lambda n: F.try_element_at(F.split(scene_id, "_"), F.lit(n))
    return {"mode": part(2), "resolution": F.right(part(3), F.lit(1)), "polarization": F.right(part(4), F.lit(2)), "day": F.substring(scene_id, 18, 8)}


def iso_millis(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def year_day(t: Column) -> Column:
    return F.date_format(t, "yyyyDDD")


def log_link(service: Column, start: Column, end: Column) -> Column:
    """A link to the log lines of a service in a time range."""
    stamp = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    query = F.concat(F.lit('resource.type = "cloud_function" resource.labels.function_name = "'), service, F.lit('"'))
    # a space is %20 here, not a plus sign
    return F.concat(F.lit("https://logs.example.org/query;query="), F.replace(F.url_encode(query), F.lit("+"), F.lit("%20")), F.lit(";timeRange="), stamp(start), F.lit("%2F"), stamp(end))


def zoom_scale(size: Column) -> tuple[Column, Column]:
    """round(log2(x)) and round(x / 256), as integers."""
    return F.round(F.log2(size)).cast("long"), F.round(size / 256).cast("long")


def count_nonnulls(*columns: Column) -> Column:
    return sum((c.isNotNull().cast("int") for c in columns), F.lit(0))


def _scenes(spark: SparkSession, sf_dir: str):
    """Scene ids made of the events' times; some are cut short."""
    e = tables.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value", "props", "user_id")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (F.col("event_id") % n + 1).cast("int"))
    name = F.concat_ws("_", F.lit("S1A"), pick(3, "IW", "EW", "SM"), F.concat(F.lit("GRD"), pick(2, "H", "M")), F.concat(F.lit("1S"), pick(4, "DV", "DH", "SV", "SH")), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.col("event_id"))
    return e.withColumn("scene_id", F.when(F.col("event_id") % 11 == 0, F.substring(name, 1, 14)).otherwise(name))


def scene_decode(spark: SparkSession, sf_dir: str):
    """Fields and start of scene ids, the month's first day and whole seconds."""
    start = scene_start(F.col("scene_id"))
    rows = _scenes(spark, sf_dir).select("event_id", *[v.alias(k) for k, v in scene_fields(F.col("scene_id")).items()], start.alias("start"))
    return rows.select("event_id", "mode", "resolution", "polarization", "day", F.unix_timestamp("start").alias("start_s"), F.date_format(F.date_trunc("month", "start"), "yyyy-MM-dd").alias("month"))


def time_formats(spark: SparkSession, sf_dir: str):
    """Times as text: with milliseconds, by day of the year, in whole seconds."""
    return _scenes(spark, sf_dir).select("event_id", iso_millis(F.col("ts")).alias("iso"), year_day(F.col("ts")).alias("year_day"), F.date_format(F.date_trunc("second", "ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("seconds"))


def log_links(spark: SparkSession, sf_dir: str):
    """Links to log lines."""
    return _scenes(spark, sf_dir).select("event_id", log_link(F.concat("event_type", F.lit(" & more/x")), F.col("ts"), F.col("ts") + F.expr("INTERVAL 2 MINUTES")).alias("link"))


def rounded_scales(spark: SparkSession, sf_dir: str):
    """Computed columns by logarithm and division."""
    log, tiles = zoom_scale(F.col("value") * 100 + 3)
    return _scenes(spark, sf_dir).select("event_id", log.alias("zoom"), tiles.alias("tiles"))


def array_tests(spark: SparkSession, sf_dir: str):
    """First element or null, membership, distinct values and length of arrays."""
    tags = F.transform(F.sequence(F.lit(0).cast("long"), F.col("event_id") % 4 - 1), lambda i: (F.col("event_id") + i * 3) % 5)
    rows = _scenes(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 4 > 0, tags).otherwise(F.array().cast("array<bigint>")).alias("tags"))
    return rows.select("event_id", F.try_element_at("tags", F.lit(1)).alias("first"), F.array_contains("tags", F.lit(2).cast("long")).alias("has_two"), F.size(F.array_distinct("tags")).cast("long").alias("kinds"), F.size("tags").cast("long").alias("n"))


def saved_filters(spark: SparkSession, sf_dir: str):
    """Hash of a filter in canonical form, and how many of its parts are set."""
    a, b = F.when(F.col("event_id") % 3 > 0, F.col("event_type")), F.when(F.col("user_id") % 2 > 0, F.col("user_id").cast("string"))
    flags = F.array_join(F.array_sort(F.filter(F.array(a, b, F.lit("z")), lambda x: x.isNotNull())), ",")
    return _scenes(spark, sf_dir).select("event_id", F.sha2(flags, 256).alias("hash"), count_nonnulls(a, b).cast("long").alias("parts"))


QUERIES = {f.__name__: f for f in (scene_decode, time_formats, log_links, rounded_scales, array_tests, saved_filters)}

_SCENES = """WITH s AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN name[1:14] ELSE name END AS scene_id FROM (
    SELECT *, 'S1A_' || ['IW', 'EW', 'SM'][1 + event_id % 3] || '_GRD' || ['H', 'M'][1 + event_id % 2] || '_1S' || ['DV', 'DH', 'SV', 'SH'][1 + event_id % 4] || '_' || strftime(ts, '%Y%m%dT%H%M%S') || '_' || event_id AS name FROM events))
"""
ORACLES = {
    "scene_decode": _SCENES + """SELECT event_id, nullif(split_part(scene_id, '_', 2), '') AS mode, right(split_part(scene_id, '_', 3), 1) AS resolution, CASE WHEN event_id % 11 = 0 THEN right(split_part(scene_id, '_', 4), 2) ELSE right(split_part(scene_id, '_', 4), 2) END AS polarization, substr(scene_id, 18, 8) AS day,
        epoch(try_strptime(substr(scene_id, 18, 15), '%Y%m%dT%H%M%S'))::BIGINT AS start_s, strftime(date_trunc('month', try_strptime(substr(scene_id, 18, 15), '%Y%m%dT%H%M%S')), '%Y-%m-%d') AS month FROM s""",
    "time_formats": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(((epoch_us(ts) // 1000) % 1000)::VARCHAR, 3, '0') || 'Z' AS iso, strftime(ts, '%Y%j') AS year_day, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS seconds FROM events",
    "log_links": """SELECT event_id, 'https://logs.example.org/query;query=' || url_encode('resource.type = "cloud_function" resource.labels.function_name = "' || event_type || ' & more/x"') || ';timeRange=' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '%2F' || strftime(ts + INTERVAL 2 MINUTE, '%Y-%m-%dT%H:%M:%S.%fZ') AS link FROM events""",
    "rounded_scales": "SELECT event_id, round(log2(value * 100 + 3))::BIGINT AS zoom, round((value * 100 + 3) / 256)::BIGINT AS tiles FROM events",
    "array_tests": "SELECT event_id, t[1] AS first, list_contains(t, 2) AS has_two, len(list_distinct(t)) AS kinds, len(t) AS n FROM (SELECT event_id, list_transform(range(0, event_id % 4), lambda i: (event_id + i * 3) % 5) AS t FROM events)",
    "saved_filters": """SELECT event_id, sha256(array_to_string(list_sort(list_filter([a, b, 'z'], lambda x: x IS NOT NULL)), ',')) AS hash, (a IS NOT NULL)::BIGINT + (b IS NOT NULL)::BIGINT AS parts
        FROM (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS a, CASE WHEN user_id % 2 > 0 THEN user_id::VARCHAR END AS b FROM events)""",
}
