"""URL verdicts by rules, and for what no rule fits by trust and distrust that spread over the links between hosts.

Personalised PageRank runs twice at once: trust flows along host links from hosts with allowed pages, distrust against them
from hosts with blocked pages (who links to bad hosts is suspect). All steps are DataFrame operations; an iteration
is one join of the scores with the edges and one sum for each host, combined before it moves. Iterations end when the
scores have settled; then each host has a verdict of its own, by how much distrust it has and how that compares with its trust.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import merged, saved

#: (host, path, verdict): a rule fits its host and all subdomains where the path starts with the rule's path.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
DAMPING = 0.85
#: Iterations end when the scores change by less than this in all, as a share of the seeds. The error left is at most
#: DAMPING / (1 - DAMPING) times that.
TOLERANCE = 1e-4
#: A host with less distrust than one with so large a share of blocked pages has by them alone isn't blocked.
LEAST_SHARE = 0.2


def _lower(x: Column) -> Column:
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages with host, path, rule (the longest that fits, else null) and ruled (its verdict)."""
    rows = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rows.withColumns({"rule": rule, "ruled": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) for links between different hosts; pages has host and html."""
    links = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1)))
    rows = pages.where("host != ''").select(F.col("host").alias("src"), links.alias("link"))
    url = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    return rows.select("src", host_of(url).alias("dst")).where("dst != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def host_scores(pages: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust), settled to `tolerance`; pages has host, html and ruled. Seeds are each host's share of
    allowed and of blocked pages. The change shrinks by DAMPING with each iteration at least, so their number is bounded by
    log(tolerance) / log(DAMPING) or so, whatever the links."""
    edges = saved(host_edges(pages))
    seeds = pages.where("host != ''").groupBy("host").agg(F.avg((F.col("ruled").eqNullSafe("allow")).cast("double")).alias("t0"), F.avg((F.col("ruled").eqNullSafe("block")).cast("double")).alias("b0"))
    hosts = seeds.unionByName(edges.select(F.col("dst").alias("host"), F.lit(0.0).alias("t0"), F.lit(0.0).alias("b0")))
    start = [(F.col(s) * (1 - DAMPING)).alias(n) for s, n in (("t0", "trust"), ("b0", "distrust"))]
    now = saved(hosts.groupBy("host").agg(F.max("t0").alias("t0"), F.max("b0").alias("b0")).select("*", *start, F.lit(0.0).alias("moved")))
    if edges.isEmpty():
        return now.select("host", "trust", "distrust")
    mass = now.agg(F.sum(F.col("t0") + F.col("b0"))).first()[0] or 0.0
    both = edges.select("src", "dst", "n", F.lit(True).alias("ahead")).union(edges.select("dst", "src", "n", F.lit(False)))
    out = saved(both.groupBy("src", "ahead").agg(F.sum("n").alias("all")))
    both = saved(merged(both, out, ["src", "ahead"]).select(F.col("src").alias("host"), "dst", "ahead", (F.col("n") / F.col("all")).alias("share")))
    while True:
        flow = merged(both, now, "host").select(F.col("dst").alias("host"), F.when(F.col("ahead"), F.col("share") * F.col("trust")).otherwise(0.0).alias("t"), F.when(~F.col("ahead"), F.col("share") * F.col("distrust")).otherwise(0.0).alias("b"))
        came = flow.groupBy("host").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
        step = merged(now.withColumnsRenamed({"trust": "was_t", "distrust": "was_b"}).drop("moved"), came, "host", "left")
        step = step.select("host", "t0", "b0", "was_t", "was_b", *[((1 - DAMPING) * F.col(s) + DAMPING * F.coalesce(c, F.lit(0.0))).alias(n) for s, c, n in (("t0", "t", "trust"), ("b0", "b", "distrust"))])
        now = saved(step.select("host", "t0", "b0", "trust", "distrust", (F.abs(F.col("trust") - F.col("was_t")) + F.abs(F.col("distrust") - F.col("was_b"))).alias("moved")))
        if now.agg(F.sum("moved")).first()[0] <= tolerance * mass:
            return now.select("host", "trust", "distrust")


def url_verdicts(pages: DataFrame, rules=RULES, tolerance: float = TOLERANCE, least_share: float = LEAST_SHARE, margin: float = 1.0) -> DataFrame:
    """One row for each row of pages (page_id, url, html): page_id, host, path, rule, verdict, trust, distrust.

    A rule's verdict stands; elsewhere a host is blocked if its distrust is more than `margin` times its trust, and at
    least what a share of `least_share` of its own pages blocked by rules would give it (one blocked page among many
    clean ones doesn't block a host). Null urls and
    urls without :// have an empty host and path and are allowed; a null html has no links; repeated rows are judged alike;
    other columns are ignored; an empty table gives an empty result.
    """
    rows = judged(pages.select("page_id", "url", "html"), rules)
    scores = host_scores(rows, tolerance)
    # the verdict is one for each host, and a host may have a third of all pages: its row meets them in several places
    spread = scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    out = rows.drop("html").withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(16)).cast("int")).join(spread, ["host", "salt"], "left")
    suspect = F.coalesce((F.col("distrust") > margin * F.col("trust")) & (F.col("distrust") >= (1 - DAMPING) * least_share), F.lit(False))
    verdict = F.coalesce("ruled", F.when(suspect, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
