"""The queries opN_<name> of the operators, with production parameters over whole tables, and SQL for those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, exact_dedup, filter_audit, html_text, mixing, near_dedup, prefix_trie, quotes, repeats, toxicity, url_filter, warc, windows


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("url")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = toxicity.toxicity(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["past"] - x["first"])
    return out.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_warc, op3_toxicity, op4_near_dedup, op5_url_filters, op6_mixing, op7_decontamination, op8_chat_formatting, op9_suffix_array_dedup, op10_exact_dedup, op11_filter_audit, op12_substring_dedup, op13_prefix_trie)}

ORACLES = {
    "op6_mixing": r"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rate AS (SELECT source, greatest(ceil((sum(n) OVER ()) * 1.0 / ((count(*) OVER ()) * n) / 200.0), 1)::INT AS parts,
    ((sum(n) OVER ()) * 1.0 / ((count(*) OVER ()) * n)) / greatest(ceil((sum(n) OVER ()) * 1.0 / ((count(*) OVER ()) * n) / 200.0), 1) AS mean FROM n),
term AS (SELECT source, parts, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p
    FROM (SELECT source, parts, mean, unnest(range(0, ceil(mean + 12 * sqrt(mean))::BIGINT + 21)) AS k FROM rate)),
part AS (SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM term),
cdf AS (SELECT source, parts, list(c ORDER BY k) AS cdf FROM part GROUP BY source, parts),
who AS (SELECT *, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS who FROM documents),
times AS (SELECT who.*, list_sum(list_transform(range(1, parts + 1), lambda j: len(list_filter(cdf, lambda c: c <= (('0x' || substr(md5(who || '#42#' || j), 1, 13))::BIGINT / 4503599627370496.0))))) AS n
    FROM who JOIN cdf ON who.source IS NOT DISTINCT FROM cdf.source)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, md5(who || '#' || copy || '#order42') AS shuffle_key
FROM (SELECT *, unnest(range(1, n::BIGINT + 1)) AS copy FROM times)""",
    "op7_decontamination": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM b),
q AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id),
ok AS (SELECT doc_id, count(*) AS n_items, max(n_shared) AS max_shared FROM hit JOIN q USING (item_id) WHERE 100 * n_shared >= 80 * n_item GROUP BY doc_id)
SELECT doc_id, coalesce(n_items, 0) AS n_items, coalesce(max_shared, 0) AS max_shared, n_items IS NOT NULL AS contaminated, n_items IS NULL AS kept
FROM documents LEFT JOIN ok USING (doc_id)""",
    "op10_exact_dedup": r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)""",
    "op2_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS x FROM p),
bits AS (SELECT page_id, payload_bytes, x, list_transform(range(0, 40), lambda i: (('0x' || substr(x, (i + 1)::BIGINT, 1))::INT)) AS n FROM h),
b32 AS (SELECT page_id, payload_bytes, x, array_to_string(list_transform(range(0, 32), lambda c: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + list_sum(list_transform(range(0, 5), lambda j: ((n[((c * 5 + j) // 4 + 1)::BIGINT] >> (3 - (c * 5 + j) % 4)::INT) & 1) << (4 - j)::INT)))::BIGINT, 1)), '') AS payload_digest FROM bits),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x, payload_bytes) AS first_id FROM b32)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM f""",
    "op11_filter_audit": r"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
f AS (SELECT doc_id, part, concat(CASE WHEN len(w) < 50 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END,
    CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN doc_id > first_id OR doc_id IS NULL AND first_id IS NOT NULL THEN 'E' ELSE '' END) AS fails FROM w),
g AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS earlier FROM o, (SELECT unnest(range(1, 6)) AS step)),
h AS (SELECT *, contains(fails, filter) AS hit, translate(fails, earlier, '') <> fails AS gone FROM g, s),
r AS (SELECT part, filter_order, step, filter, sum(CASE WHEN hit OR gone THEN 0 ELSE n END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = filter THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
    FROM h GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
    good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r""",
    "op12_substring_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
v AS (SELECT n, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT n, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (SELECT n, i FROM (SELECT n, i, row_number() OVER (PARTITION BY s ORDER BY n, i) AS place FROM v) WHERE place > 1),
gone AS (SELECT DISTINCT n, i + unnest(range(0, 20)) AS i FROM later),
word AS (SELECT n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT n, count(*) AS n_kept, string_agg(x, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (n, i) GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (n)""",
    "op13_prefix_trie": r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
id AS (SELECT conv_id, conv_id::VARCHAR AS s FROM (SELECT DISTINCT conv_id FROM t)),
c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ord(substr(s, i, 1))::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda e, k: xor(e >> 1, (e & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 9 AS h FROM id),
r AS (SELECT c.conv_id, t.p, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.p <= c.h
    UNION ALL SELECT c.conv_id, t.p, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.p > c.h),
m AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS d, string_agg(md5(concat(length(role), ':', role, ':', text)), '') OVER (PARTITION BY conv_id ORDER BY p) AS k, strlen(text) AS size FROM r
    UNION ALL SELECT conv_id, 0, '', 0 FROM c),
e AS (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM m),
n AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = last), '') AS ends FROM e GROUP BY d, k),
up AS (SELECT n.d, n.k, p.d AS pd, p.k AS pk FROM n JOIN m p ON p.conv_id = n.conv_id AND p.d = n.d - 1),
ch AS (SELECT pd AS d, pk AS k, count(*) AS n_children FROM up GROUP BY pd, pk),
a AS (SELECT m.d, m.k, count(*) FILTER (WHERE ch.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved FROM n LEFT JOIN ch USING (d, k) JOIN m ON m.conv_id = n.conv_id AND m.d <= n.d GROUP BY m.d, m.k)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children, a.n_leaves, a.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN a USING (d, k) LEFT JOIN ch USING (d, k) LEFT JOIN up USING (d, k) LEFT JOIN n p ON p.d = up.pd AND p.k = up.pk""",
}
