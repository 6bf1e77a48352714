"""Statistics of rasters against numpy on all pixels."""

import numpy as np
import pytest

from tidewatch.operators import statistics


def described(spark, groups, nodata=None, **kw):
    rows = [(k, None if v is None else float(v)) for k, vs in groups.items() for v in vs]
    d = spark.createDataFrame(rows, "k string, value double")
    return {r.k: r for r in statistics.described(statistics.counted(d, ["k"], nodata), ["k"], **kw).collect()}


def test_figures_are_those_of_numpy(spark):
    g = np.random.default_rng(7)
    groups = {"whole": g.integers(19, 1076, 3000), "floats": g.normal(5, 2, 800), "few": [0.1, 0.2, 0.3, 0.3], "edges": np.arange(0, 1.01, 0.1), "one": [4.5], "same": [3, 3, 3], "negative": [-7, -7.5, -1e6, 1e6], "tenths": np.repeat([0.7, 0.8, 0.1], [3, 3, 1])}
    got = described(spark, groups)
    for k, v in groups.items():
        v = np.asarray(v, float)
        r, (values, n) = got[k], np.unique(v, return_counts=True)
        assert (r["min"], r["max"], r["count"], r["unique"], r.valid_pixels, r.masked_pixels, r.valid_percent) == (v.min(), v.max(), len(v), len(values), len(v), 0, 100)
        assert (r.majority, r.minority) == (values[n.argmax()], values[n.argmin()])
        assert [r["mean"], r["sum"], r["std"]] == pytest.approx([v.mean(), v.sum(), v.std()], rel=1e-12)
        assert [r["median"], r.percentile_2, r.percentile_98] == pytest.approx(np.percentile(v, [50, 2, 98]).tolist(), rel=1e-12)
        counts, edges = np.histogram(v, bins=10)
        assert r.histogram.counts == counts.tolist() and r.histogram.edges == pytest.approx(edges.tolist(), rel=1e-12)


def test_masked_pixels(spark):
    """Null, NaN and nodata are masked; a band without any other has no figures."""
    got = described(spark, {"some": [0, None, float("nan"), 5, 7, -0.0], "none": [0, None]}, nodata=0)
    r = got["some"]
    assert (r["min"], r["max"], r["count"], r.masked_pixels, r.valid_percent) == (5, 7, 2, 4, 33.33)
    assert r.histogram.counts == [1, *[0] * 8, 1]
    r = got["none"]
    assert (r["count"], r.masked_pixels, r.valid_percent, r["unique"]) == (0, 2, 0, 0)
    assert all(r[f] is None for f in ("min", "max", "mean", "sum", "std", "median", "majority", "minority", "histogram", "percentile_2", "percentile_98"))
    assert statistics.FIGURES == got["some"].__fields__[1:] and len(statistics.FIGURES) == 16


def test_tiles_add_up(spark):
    d = spark.range(1000).selectExpr("id % 7 AS tile", "'vv' AS band", "cast(id * id % 101 AS double) AS value")
    whole = statistics.described(statistics.counted(d, ["band"]), ["band"]).first()
    parts = statistics.described(statistics.merged_counts(statistics.counted(d, ["band", "tile"]), ["band"]), ["band"]).first()
    assert whole == parts and whole["count"] == 1000
    assert statistics.described(statistics.counted(d.limit(0), ["band"]), ["band"]).count() == 0
