"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

The mean repetition rate of a source is its share of the target rows over its own rows. For each document a number
hashed from its id and the seed is put through the inverse of the Poisson distribution with that mean; the document
is exploded by the count, and a sort by a hash of id and copy shuffles all copies globally.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import saved

#: Larger means are drawn as sums of independent parts, so that exp(-mean) stays a normal number.
LARGEST_MEAN = 200.0
#: Rates of so many sources go to every executor (some 4 KB each); beyond it they meet the rows in a shuffled join.
BROADCAST_SOURCES = 2_000
#: In that join a hot source's rows meet its rate in so many places.
SALTS = 16


def uniform(*parts: Column) -> Column:
    """A number from 0 to under 1 out of 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", *parts)), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(documents: DataFrame, weights: dict[str, float] | None, target_rows: int | None) -> tuple[DataFrame, int]:
    """(source, parts, cdf), the rate being drawn as `parts` Poisson numbers with the cumulative distribution `cdf`; and how many sources there are."""
    n = documents.groupBy("source").agg(F.count("*").alias("n"))
    weight = F.lit(1.0) if weights is None else F.coalesce(*[F.when(F.col("source") == s, F.lit(float(w))) for s, w in weights.items()], F.lit(0.0))
    n = saved(n.withColumn("weight", weight))
    all_n, all_weight, sources = n.agg(F.sum("n"), F.sum("weight"), F.count("*")).first()
    rows = F.lit((all_n or 0) if target_rows is None else target_rows)
    n = n.withColumn("rate", F.coalesce(F.try_divide(rows * F.col("weight"), F.lit(all_weight or 0.0) * F.col("n")), F.lit(0.0)))
    n = n.withColumn("parts", F.greatest(F.ceil(F.col("rate") / LARGEST_MEAN), F.lit(1)).cast("int")).withColumn("mean", F.col("rate") / F.col("parts"))
    cdf = """transform(aggregate(sequence(1, cast(ceil(mean + 12 * sqrt(mean)) as int) + 20),
        struct(exp(-mean) as p, array(exp(-mean)) as c),
        (a, k) -> struct(a.p * mean / k as p, concat(a.c, array(element_at(a.c, -1) + a.p * mean / k)) as c)).c, x -> x)"""
    return n.select("source", "parts", F.expr(cdf).alias("cdf")), sources


def mixed(documents: DataFrame, weights: dict[str, float] | None = None, target_rows: int | None = None, seed: int = 42) -> DataFrame:
    """The rows of documents, each repeated by its count, with copy (1, 2, ...) and shuffle_key, in the order of that key.

    weights maps sources to target shares (None: all sources alike; a source that isn't named gets none); target_rows is the
    mean number of rows in all (None: as many as come in). A null source is a source of its own with its share under None
    and none otherwise; a null doc_id draws by its text; rows that share an id draw the same number; columns named copy,
    shuffle_key, parts, cdf, salt, rate_source, rate_salt, who or times are dropped; an empty table gives an empty result.
    """
    rate, sources = rates(documents, weights, target_rows)
    base = documents.drop("copy", "shuffle_key", "parts", "cdf", "salt", "rate_source", "rate_salt", "who", "times")
    who = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    rows, rate = base.withColumn("who", who), rate.withColumnRenamed("source", "rate_source")
    same = F.col("source").eqNullSafe(F.col("rate_source"))
    if sources <= BROADCAST_SOURCES:
        rows = rows.join(F.broadcast(rate), same)
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        rows = rows.join(rate.withColumn("rate_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), F.col("salt").eqNullSafe(F.col("rate_salt")) & same).drop("salt", "rate_salt")
    rows = rows.drop("rate_source")
    draw = lambda j: uniform(F.col("who"), F.lit(str(seed)), j.cast("string"))
    count = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda a, j: a + F.size(F.filter("cdf", lambda c: c <= draw(j))))
    copies = rows.withColumn("times", count).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "parts", "cdf")
    copies = copies.withColumn("shuffle_key", F.md5(F.concat_ws("#", "who", F.col("copy").cast("string"), F.lit(f"order{seed}")))).drop("who")
    return copies.orderBy("shuffle_key", "doc_id", "copy")
