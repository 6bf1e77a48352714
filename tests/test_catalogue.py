"""Every catalogue query against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tidewatch.plans import catalogue

DATA = "/root/testdata/sf0.001"


def plain(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_oracle(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got = catalogue.run(name, spark, DATA)
    want = c.execute(catalogue.oracles()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


def test_macros_keep_nested_brackets():
    assert catalogue._macro("a $f(g(1, 2), h) b", "f", lambda x, y: f"<{x}|{y}>") == "a <g(1, 2)|h> b"


def test_whole_tables_are_read(spark):
    """Every link gets its flag, and the lineage starts at every detection; brute force over the precursors."""
    links = spark.read.parquet(f"{DATA}/lineitem.parquet").count()
    assert catalogue.run("deactivate_by_type", spark, DATA).count() == links
    assert catalogue.run("exc_sync", spark, DATA).count() == links
    ids = {r.o_orderkey for r in spark.read.parquet(f"{DATA}/orders.parquet").select("o_orderkey").collect()}
    want, todo = {}, list(ids)
    while todo:
        i = todo.pop()
        want[i] = want.get(i, 0) + 1
        if i in ids:
            todo += [p for p in [i // 2, *[i // 3] * (i % 5 == 0)] if p > 0]
    assert {r.id: r.reached for r in catalogue.run("slick_history", spark, DATA).collect()} == want
