"""The corpus pipeline: each stage on rows with null and repeated ids, and the whole against a brute-force version."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest

import corpus_pipeline
from tidewatch.llm import toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, schema, path):
    df = spark.createDataFrame(rows, schema)
    df.coalesce(2).write.parquet(path)
    return df


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def exact(rows):
    same = collections.defaultdict(list)
    for r in rows:
        same[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r)
    for group in same.values():
        ids = [r[0] for r in group if r[0] is not None]
        yield from (r for r in group if r[0] == (min(ids) if ids else None))


def near(rows):
    sets = [(i, shingles(t)) for i, t, _ in rows if i is not None]
    up = {i: i for i, _ in sets}
    for _ in up:
        for i, a in sets:
            for j, b in sets:
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    up[i] = up[j] = min(up[i], up[j])
    return [r for r in rows if r[0] is None or up[r[0]] == r[0]]


def clean(rows, items):
    sets = [shingles(t) for _, t in items]
    return [r for r in rows if not any(s and 100 * len(s & shingles(r[1])) >= 80 * len(s) for s in sets)]


def mix(rows):
    n = collections.Counter(s for _, _, s in rows)
    for i, t, s in rows:
        mean = sum(n.values()) / (len(n) * n[s])
        who = str(i) if i is not None else hashlib.md5((t or "").encode()).hexdigest()
        u, k, p = int(hashlib.md5(f"{who}#42#1".encode()).hexdigest()[:13], 16) / 2**52, 0, math.exp(-mean)
        c = p
        while c <= u:
            k += 1
            p *= mean / k
            c += p
        yield from ((i, t, s, copy) for copy in range(1, k + 1))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    r = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, labels = [], []
    items = [(i, " ".join(r.choice(vocabulary, 30))) for i in range(4)] + [(4, "two words"), (5, None), (None, "")]
    for i in range(300):
        w = list(r.choice(vocabulary, int(r.integers(20, 60))))
        if i % 6 == 0:
            w[3], w[9] = "slurry", "slurwort"
        if i % 10 == 1:
            w = rows[int(r.integers(len(rows)))][1].split(" ")
        if i % 10 == 2 and len(w) > 50:
            w[25] = "edit"
        if i % 25 == 3:
            w[5:5] = items[i % 4][1].split(" ")
        rows.append((i, " ".join(w), f"s{i % 7 % 3}" if i % 11 else None))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(None, rows[7][1], "s0"), (None, "only text without an id", "s1"), (301, None, "s1"), (302, "", "s1"), (303, " \t", None), (7, "another text that shares its id", "s2"), (304, "two words", "s0"), (8, rows[8][1], "s0"), (305, "w " * 30000, "s0")]
    table(spark, [(i, t, "en", s, 0) for i, t, s in rows], DOCS, f"{path}/documents.parquet")
    table(spark, [*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int", f"{path}/labels.parquet")
    table(spark, items, "item_id long, text string", f"{path}/benchmark.parquet")
    return path, rows, items


def got(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)


def test_whole_run_equals_brute_force(spark, corpus):
    path, rows, items = corpus
    d = spark.read.parquet(f"{path}/documents.parquet")
    toxic = {r.doc_id: r.predicted for r in toxicity.toxicity(docs(spark, [(n, t, "") for n, (_, t, _) in enumerate(rows)]), toxicity.fit(d, spark.read.parquet(f"{path}/labels.parquet"))).collect()}
    left = [r for n, r in enumerate(rows) if not toxic[n]]
    assert 200 < len(left) < 290
    want = list(mix(clean(near(list(exact(left))), items)))
    found = corpus_pipeline.run(spark, path)
    assert sorted(((r.doc_id, r.text, r.source, r.copy) for r in found.collect()), key=str) == sorted(want, key=str)
    assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(found.columns)


def test_stages_on_their_own(spark, corpus):
    path, rows, items = corpus
    d = docs(spark, rows)
    clash = d.selectExpr("*", "1 AS evidence", "2 AS key1", "3 AS gone_id", "4 AS digest", "5 AS score", "'x' AS hit1", "6 AS gone_digest")
    for stage, want in ((corpus_pipeline.exact, exact(rows)), (corpus_pipeline.near, near(rows)), (corpus_pipeline.clean, clean(rows, items)), (corpus_pipeline.toxic, None)):
        out = stage(spark, clash, path)
        assert out.columns == clash.columns
        assert got(out) == got(stage(spark, d, path)) if want is None else got(out) == sorted(want, key=str)


def test_rows_that_share_an_id_are_told_apart(spark, corpus):
    d = docs(spark, [(1, "a b", "s"), (2, "a b", "s"), (2, "unique text", "s"), (None, "a b", "s")])
    assert got(corpus_pipeline.exact(spark, d, corpus[0])) == [(1, "a b", "s"), (2, "unique text", "s")]


def test_empty_tables(spark, tmp_path):
    table(spark, [], DOCS, f"{tmp_path}/documents.parquet")
    table(spark, [], "doc_id long, quality int, toxic int", f"{tmp_path}/labels.parquet")
    table(spark, [], "item_id long, text string", f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
