"""Merging sources that are one and the same, as a migration in seven stages with a gate: map, validate, seed, retarget, merge, rerank, audit.

Every stage is a table, written to the shared folder; nothing is changed in place. What has to be empty before the change (the map's faults)
and after it (the audits) is asked for in one query each. Only if all of it is empty are the new tables published: under the name
of the run, and then by a row that names this run as the current one. A reader sees the tables before or after, never between.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators.ranking import numbered
from tidewatch.operators.workflow import get_or_insert
from tidewatch.plans import tables

# Fixed value: the type of sources that are infrastructure.
INFRA = 2
#: What a reviewer left on a link besides the verdict itself.
REVIEW = ["hitl_confidence", "hitl_user", "hitl_time", "hitl_notes"]


class MigrationStopped(ValueError):
    """Faults of a map or of the migrated tables: how many rows each audit has."""

    def __init__(self, faults: dict[str, int]):
        super().__init__(", ".join(f"{k}: {n}" for k, n in sorted(faults.items())))
        self.faults = faults


@dataclass
class Staged:
    """The tables of a migration before they are published, and what its stages found."""

    sources: DataFrame
    details: DataFrame
    links: DataFrame
    resolved: DataFrame


def map_faults(mapping: DataFrame) -> DataFrame:
    """(fault, large_ext_id) of mapping (large_ext_id, small_ext_id): no id at all, an id mapped to itself, one mapped twice, one that
    others are mapped to and that is mapped further (a chain)."""
    m = mapping.select("large_ext_id", "small_ext_id")
    kinds = {
        "missing_id": m.where("large_ext_id is null or small_ext_id is null"),
        "own_target": m.where("large_ext_id = small_ext_id"),
        "mapped_twice": m.where("large_ext_id is not null").groupBy("large_ext_id").count().where("count > 1"),
        "chain": m.where("large_ext_id <> small_ext_id").join(m.select(F.col("small_ext_id").alias("large_ext_id")), "large_ext_id", "left_semi"),
    }
    out = None
    for kind, rows in kinds.items():
        rows = rows.select(F.lit(kind).alias("fault"), "large_ext_id")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def resolved(mapping: DataFrame, sources: DataFrame) -> DataFrame:
    """mapping with large_id and small_id, the sources (id, type, ext_id) of type INFRA that have these names, else null."""
    infra = sources.where(F.col("type") == INFRA)
    named = lambda c: infra.select(F.col("ext_id").alias(f"{c}_ext_id"), F.col("id").alias(f"{c}_id"))
    return mapping.join(named("large"), "large_ext_id", "left").join(named("small"), "small_ext_id", "left").select("large_ext_id", "small_ext_id", "large_id", "small_id")


def donors(pairs: DataFrame) -> DataFrame:
    """(ext_id, donor): targets that aren't there, and the smallest source to be merged into each."""
    return pairs.where("large_id is not null and small_id is null").groupBy(F.col("small_ext_id").alias("ext_id")).agg(F.min("large_id").alias("donor"))


def seeded(sources: DataFrame, details: DataFrame, missing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """sources and details (source_id ...) with the missing targets, their names for st_name if there is one, and their donors' details."""
    new = missing.select(F.lit(INFRA).cast(sources.schema["type"].dataType).alias("type"), "ext_id")
    rest = [c for c in sources.columns if c not in ("id", "type", "ext_id")]
    new = new.select("*", *[(F.col("ext_id") if c == "st_name" else F.lit(None)).cast(sources.schema[c].dataType).alias(c) for c in rest])
    grown = tables.settled(get_or_insert(sources, new, ["type", "ext_id"]))
    ids = grown.where(F.col("type") == INFRA).select("ext_id", F.col("id").alias("_new"))
    copies = details.join(missing.join(ids, "ext_id").select(F.col("donor").alias("source_id"), "_new"), "source_id")
    copies = copies.withColumn("source_id", F.col("_new")).select(*details.columns).join(details.select("source_id"), "source_id", "left_anti")
    return grown, details.unionByName(copies)


def _yes(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def retargeted(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links of sources that are merged away, at their targets, one for each (slick, source): the active one first, then the confirmed
    one, the best score, the latest, the first by rank and id. It is active or confirmed if any of them is."""
    moved = links.join(pairs.where("large_id is not null and small_id is not null").select(F.col("large_id").alias("source"), "small_id"), "source")
    # dealt before they are sorted by key, as a task that reads has as many rows as its file
    moved = moved.withColumn("source", F.col("small_id")).drop("small_id").repartition("slick")
    # min_by over a struct: nulls come first there, so each key that may be null has a flag before it
    last = lambda c, down: [F.col(c).isNull(), -F.col(c) if down else F.col(c)]
    order = F.struct(~_yes("active"), ~_yes("hitl_verification"), *last("score", True), F.col("create_time").isNull(), -F.unix_micros(F.col("create_time").cast("timestamp")), *last("link_rank", False), F.col("id"))
    best = moved.groupBy("slick", "source").agg(F.min_by(F.struct(*moved.columns), order).alias("b"), F.bool_or(_yes("active")).alias("any_active"), F.bool_or(_yes("hitl_verification")).alias("any_yes"))
    over = {"active": F.col("any_active"), "hitl_verification": F.when(F.col("any_yes"), True).otherwise(F.col("b.hitl_verification"))}
    return best.select(*[over.get(c, F.col(f"b.{c}")).alias(c) for c in links.columns])


def merged(links: DataFrame, moved: DataFrame, pairs: DataFrame) -> DataFrame:
    """links without those of merged sources, and with the moved ones: where (slick, source) is there already, it is active if either is, confirmed
    if either is, else denied if either is; what a reviewer left on a moved, confirmed link goes over. Others are added with new ids."""
    old = links.join(pairs.where("large_id is not null and small_id is not null").select(F.col("large_id").alias("source")), "source", "left_anti").select(*links.columns)
    taken = ["active", "hitl_verification", *REVIEW]
    new = moved.select("slick", "source", *[F.col(c).alias(f"_{c}") for c in taken])
    both = old.join(new, ["slick", "source"], "left")
    verdict = F.when(_yes("hitl_verification") | _yes("_hitl_verification"), True).when(F.coalesce(F.col("hitl_verification"), F.col("_hitl_verification")).isNotNull(), False)
    over = {"active": F.when(F.col("_active").isNull(), F.col("active")).otherwise(_yes("active") | F.col("_active")), "hitl_verification": verdict}
    over |= {c: F.when(_yes("_hitl_verification"), F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in REVIEW}
    added = moved.join(old.select("slick", "source"), ["slick", "source"], "left_anti").drop("id")
    top = links.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    added = numbered(added, [F.asc("slick"), F.asc("source")], "id").withColumn("id", F.col("id") + top)
    return both.select(*[over.get(c, F.col(c)).alias(c) for c in links.columns]).unionByName(added.select(*links.columns))


def reranked(links: DataFrame, slicks: DataFrame) -> DataFrame:
    """links with new ranks for the active ones of slicks (slick): by score, then id. Only rows of these slicks are sorted."""
    touched = links.join(slicks.distinct(), "slick", "left_semi").where("active")
    w = Window.partitionBy("slick").orderBy(F.desc_nulls_last("score"), "id")
    rank = F.row_number().over(w).cast(links.schema["link_rank"].dataType)
    ranks = touched.select(F.col("id"), rank.alias("_rank"))
    return links.join(ranks, "id", "left").withColumn("link_rank", F.coalesce("_rank", "link_rank")).select(*links.columns)


def audits(staged: Staged, slicks: DataFrame) -> dict[str, DataFrame]:
    """What has to be empty: links of merged sources, links that stand twice, active links of the touched slicks that share a rank, links of no source, new targets
    without details."""
    final = staged.resolved.where("large_id is not null and small_id is not null")
    touched = staged.links.join(slicks.distinct(), "slick", "left_semi")
    return {
        "links_of_merged_sources": staged.links.join(final.select(F.col("large_id").alias("source")), "source", "left_semi"),
        "repeated_links": touched.groupBy("slick", "source").count().where("count > 1"),
        "repeated_ranks": touched.where("active").groupBy("slick", "link_rank").count().where("count > 1"),
        "links_without_source": touched.join(staged.sources.select(F.col("id").alias("source")), "source", "left_anti"),
        "targets_without_details": final.select(F.col("small_id").alias("source_id")).distinct().join(staged.details, "source_id", "left_anti"),
    }


def _stop(found: dict[str, DataFrame]) -> None:
    """An error if any of the tables has rows; they are counted in one query."""
    all_rows = None
    for name, rows in found.items():
        one = rows.select(F.lit(name).alias("fault"))
        all_rows = one if all_rows is None else all_rows.unionByName(one)
    faults = {r.fault: r["count"] for r in all_rows.groupBy("fault").count().collect()}
    if faults:
        raise MigrationStopped(faults)


def prepared(mapping: DataFrame, sources: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stages before links are changed: the map with the ids of its sources, and sources and details with the targets that were missing."""
    mapping = tables.settled(mapping)
    if mapping.isEmpty():
        raise MigrationStopped({"empty_map": 1})
    _stop({"map_faults": map_faults(mapping)})
    pairs = tables.settled(resolved(mapping, sources))
    if pairs.where("large_id is not null").isEmpty():
        raise MigrationStopped({"nothing_to_merge": 1})
    missing = tables.settled(donors(pairs))
    _stop({"donors_without_details": missing.join(details, missing["donor"] == details["source_id"], "left_anti")})
    grown, more = seeded(sources, details, missing)
    return tables.settled(resolved(mapping, grown)), grown, tables.settled(more)


def staged(mapping: DataFrame, sources: DataFrame, details: DataFrame, links: DataFrame) -> Staged:
    """All stages. mapping (large_ext_id, small_ext_id), sources (id, type, ext_id ...), details (source_id ...), links (id, slick, source,
    active, score, link_rank, create_time, hitl_verification and REVIEW ...); further columns stay.

    Pairs whose large name is no source are left out, and stay in `resolved` without large_id. An empty map, one that has faults, one without
    any source to merge, and a missing target whose donor has no details stop it. Nulls in active and in verdicts count as not active and no verdict.
    Links are worked out once, and are shuffled to partitions for their number.
    """
    pairs, grown, more = prepared(mapping, sources, details)
    links = tables.settled(links)
    with tables.shuffled_for(links.sparkSession, links.count()):
        moved = tables.settled(retargeted(links, pairs))
        one = tables.settled(merged(links, moved, pairs))
        out = Staged(grown, more, tables.settled(reranked(one, moved.select("slick"))), pairs)
        _stop(audits(out, moved.select("slick")))
    return out


def current(spark: SparkSession, folder: str) -> str | None:
    """The name of the run whose tables are published in a folder; None if there is none yet."""
    try:
        row = spark.read.schema("run string, at timestamp").parquet(f"{folder}/current").orderBy(F.desc("at")).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return row.run if row else None


def publish(result: Staged, folder: str, run: str) -> bool:
    """The staged tables under the run's name, then the row that makes them current. The run that is current is left alone
    (False); one that was interrupted writes its tables anew."""
    spark = result.links.sparkSession
    if current(spark, folder) == run:
        return False
    for name in ("sources", "details", "links"):
        getattr(result, name).write.mode("overwrite").parquet(f"{folder}/{name}/run={run}")
    spark.range(1).select(F.lit(run).alias("run"), F.current_timestamp().alias("at")).coalesce(1).write.mode("append").parquet(f"{folder}/current")
    return True


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the current run."""
    run = current(spark, folder)
    if run is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(f"{folder}/{name}/run={run}")


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A map whose targets are there, are of another type or aren't there, and sources, details and links."""
    s = tables.table(spark, sf_dir, "supplier").withColumn("k", F.col("s_suppkey").cast("long"))
    k = F.col("k")
    sources = s.select(k.alias("id"), F.when(k % 5 == 0, 1).otherwise(INFRA).alias("type"), k.cast("string").alias("ext_id"), F.col("s_name").alias("st_name"))
    details = s.where("k % 5 <> 0").select(k.alias("source_id"), F.col("s_name").alias("ext_name"), F.col("s_nationkey").cast("long").alias("operator"))
    small = F.when(k % 4 == 0, F.concat(F.lit("n"), F.floor(k / 24).cast("string"))).otherwise((k - 1).cast("string"))
    mapping = s.where("k % 3 = 0").select(k.cast("string").alias("large_ext_id"), small.alias("small_ext_id"))
    l = tables.table(spark, sf_dir, "lineitem")
    own = l.select(F.col("l_orderkey").cast("long").alias("slick"), F.col("l_suppkey").cast("long").alias("source"), "l_extendedprice", "l_linenumber", "l_linestatus", "l_shipdate")
    l = own.repartition(tables.parts_for(spark, l.count()), "slick").groupBy("slick", "source")
    l = l.agg(F.max("l_extendedprice").alias("price"), F.max("l_linenumber").cast("int").alias("link_rank"), F.bool_or(F.col("l_linestatus") == "O").alias("active"), F.max("l_shipdate").cast("timestamp").alias("create_time"))
    n = F.col("slick") + F.col("source")
    verdict = F.when(n % 3 == 0, True).when(n % 3 == 1, False)
    note = lambda c: F.when(n % 7 > 0, F.concat(F.lit(c), F.col("source").cast("string")))
    links = l.select((F.col("slick") * 100_000_000 + F.col("source")).alias("id"), "slick", "source", "active", F.when(n % 11 > 0, F.col("price")).alias("score"), "link_rank", "create_time", verdict.alias("hitl_verification"), F.when(n % 2 > 0, (n % 5 + 1).cast("int")).alias("hitl_confidence"), note("u").alias("hitl_user"), F.when(n % 7 > 0, F.col("create_time")).alias("hitl_time"), note("n").alias("hitl_notes"))
    return mapping, sources, details, links


def migration_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map's sources after the missing targets were seeded; those that are no infrastructure have none."""
    return prepared(*_inputs(spark, sf_dir)[:3])[0]


def migration_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with their details, new targets with those of their donors."""
    _, sources, details = prepared(*_inputs(spark, sf_dir)[:3])
    return sources.join(details, sources["id"] == details["source_id"], "left").drop("source_id")


def migration_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links after the migration, ranked anew."""
    rows = staged(*_inputs(spark, sf_dir)).links
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return rows.select("id", "slick", "source", "active", "score", "link_rank", day("create_time"), "hitl_verification", "hitl_confidence", "hitl_user", day("hitl_time"), "hitl_notes")


def migration_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of a map of every source to half its number."""
    k = F.col("s_suppkey").cast("long")
    s = tables.table(spark, sf_dir, "supplier").select(k.alias("k"))
    once = s.select(F.col("k").cast("string").alias("large_ext_id"), F.when(F.col("k") % 9 > 0, F.floor((F.col("k") + 1) / 2).cast("string")).alias("small_ext_id"))
    return map_faults(once.unionByName(once.where("cast(large_ext_id AS long) % 4 = 0")))


QUERIES = {f.__name__: f for f in (migration_map, migration_details, migration_links, migration_faults)}

_MAP = """WITH src AS (SELECT s_suppkey::BIGINT AS id, CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 2 END::INT AS type, s_suppkey::VARCHAR AS ext_id, s_name AS st_name, s_nationkey::BIGINT AS operator FROM supplier),
map AS (SELECT s_suppkey::VARCHAR AS l, CASE WHEN s_suppkey % 4 = 0 THEN 'n' || s_suppkey // 24 ELSE (s_suppkey - 1)::VARCHAR END AS s FROM supplier WHERE s_suppkey % 3 = 0),
r0 AS (SELECT l, s, (SELECT id FROM src WHERE type = 2 AND ext_id = l) AS large_id, (SELECT id FROM src WHERE type = 2 AND ext_id = s) AS old_id FROM map),
seed AS (SELECT s, min(large_id) AS donor, row_number() OVER (ORDER BY s) + (SELECT max(id) FROM src) AS new_id FROM r0 WHERE large_id IS NOT NULL AND old_id IS NULL GROUP BY s),
res AS (SELECT l AS large_ext_id, r0.s AS small_ext_id, large_id, coalesce(old_id, new_id) AS small_id FROM r0 LEFT JOIN seed USING (s))"""
_NOTES = ("hitl_confidence", "hitl_user", "hitl_time", "hitl_notes")
ORACLES = {
    "migration_map": _MAP + " SELECT * FROM res",
    "migration_details": _MAP + """ SELECT id, type, ext_id, st_name, CASE WHEN type = 2 THEN st_name END AS ext_name, CASE WHEN type = 2 THEN operator END AS operator FROM src
UNION ALL SELECT new_id, 2, s, s, d.st_name, d.operator FROM seed JOIN src d ON d.id = donor""",
    "migration_links": _MAP + f""", g AS (SELECT l_orderkey::BIGINT AS slick, l_suppkey::BIGINT AS source, max(l_extendedprice) AS price, max(l_linenumber)::INT AS link_rank, bool_or(l_linestatus = 'O') AS active, strftime(max(l_shipdate), '%Y-%m-%d') AS create_time, l_orderkey + l_suppkey AS n FROM lineitem GROUP BY ALL),
lk AS (SELECT slick * 100000000 + source AS id, slick, source, active, CASE WHEN n % 11 > 0 THEN price END AS score, link_rank, create_time, CASE n % 3 WHEN 0 THEN true WHEN 1 THEN false END AS hitl_verification,
    CASE WHEN n % 2 > 0 THEN (n % 5 + 1)::INT END AS hitl_confidence, CASE WHEN n % 7 > 0 THEN 'u' || source END AS hitl_user, CASE WHEN n % 7 > 0 THEN create_time END AS hitl_time, CASE WHEN n % 7 > 0 THEN 'n' || source END AS hitl_notes FROM g),
mv AS (SELECT lk.* REPLACE (small_id AS source) FROM lk JOIN res ON large_id = lk.source AND small_id IS NOT NULL),
pick AS (SELECT * EXCLUDE (p, aa, ay) REPLACE (aa AS active, coalesce(ay, hitl_verification) AS hitl_verification) FROM (SELECT *, bool_or(active) OVER w AS aa, nullif(bool_or(coalesce(hitl_verification, false)) OVER w, false) AS ay,
    row_number() OVER (w ORDER BY active DESC, coalesce(hitl_verification, false) DESC, score DESC NULLS LAST, create_time DESC NULLS LAST, link_rank NULLS LAST, id) AS p FROM mv WINDOW w AS (PARTITION BY slick, source)) AS x WHERE p = 1),
kept AS (SELECT * FROM lk WHERE source NOT IN (SELECT large_id FROM res WHERE large_id IS NOT NULL AND small_id IS NOT NULL)),
fin AS (SELECT k.id, slick, source, coalesce(k.active OR p.active, k.active) AS active, k.score, k.link_rank, k.create_time,
    CASE WHEN k.hitl_verification OR p.hitl_verification THEN true WHEN k.hitl_verification = false OR p.hitl_verification = false THEN false END AS hitl_verification,
    {", ".join(f"CASE WHEN p.hitl_verification THEN coalesce(p.{c}, k.{c}) ELSE k.{c} END AS {c}" for c in _NOTES)} FROM kept k LEFT JOIN pick p USING (slick, source)
  UNION ALL SELECT row_number() OVER (ORDER BY slick, source) + (SELECT max(id) FROM lk), slick, source, active, score, link_rank, create_time, hitl_verification, {", ".join(_NOTES)} FROM pick WHERE (slick, source) NOT IN (SELECT (slick, source) FROM kept))
SELECT * REPLACE (CASE WHEN active AND slick IN (SELECT slick FROM mv) THEN row_number() OVER (PARTITION BY slick, active ORDER BY score DESC NULLS LAST, id) ELSE link_rank END::INT AS link_rank) FROM fin""",
    "migration_faults": """WITH o AS (SELECT s_suppkey AS l, CASE WHEN s_suppkey % 9 > 0 THEN (s_suppkey + 1) // 2 END AS s FROM supplier)
SELECT 'missing_id' AS fault, l::VARCHAR AS large_ext_id FROM o WHERE s IS NULL UNION ALL SELECT 'own_target', l::VARCHAR FROM o WHERE l = s UNION ALL SELECT 'mapped_twice', l::VARCHAR FROM o WHERE l % 4 = 0
UNION ALL SELECT 'chain', l::VARCHAR FROM o WHERE l <> s AND l IN (SELECT s FROM o WHERE s IS NOT NULL)""",
}
