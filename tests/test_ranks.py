"""Percentiles and ranks of cells that are ranked in slices, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.plans import norms
from plumbline.sources.fixtures import POINTS


@pytest.mark.parametrize("sliced", [10, 5_000])
def test_percentiles_in_slices_equal_numpy(spark, monkeypatch, sliced):
    monkeypatch.setattr(norms, "SLICED", sliced)
    r = np.random.default_rng(0)
    groups = {("a", None): r.normal(size=3_000), (None, "x"): np.round(r.normal(size=500), 1), ("b", "y"): np.full(40, 2.5), ("c", "z"): np.array([7.0]), ("d", "w"): np.r_[-np.exp(r.normal(size=20)), np.exp(r.normal(size=200))]}
    df = spark.createDataFrame([(g, h, float(v)) for (g, h), x in groups.items() for v in x], "g string, h string, value double").repartition(6)
    cells = df.groupBy("g", "h").agg(F.count("*").alias("n"), F.count("*").alias("n_log"))
    got = {(x.g, x.h): x.percentiles for x in norms.rank_statistics(df, cells, ["g", "h"], False).collect()}
    assert got.keys() == groups.keys()
    for k, x in groups.items():
        assert np.allclose(got[k], np.percentile(x, POINTS), rtol=1e-12, atol=1e-12), k
    ranks = norms.ranked(df, cells, ["g", "h"]).groupBy("g", "h").agg(F.array_sort(F.collect_list(F.struct("i", "value"))).alias("x")).collect()
    for row in ranks:
        assert [p.i for p in row.x] == list(range(1, len(groups[row.g, row.h]) + 1)) and [p.value for p in row.x] == sorted(groups[row.g, row.h])


def test_normality_does_not_depend_on_slices(spark, monkeypatch):
    r = np.random.default_rng(1)
    rows = [("absolute_power" if k % 2 else "x", "Alpha", float(v)) for k, v in enumerate(np.r_[np.exp(r.normal(size=400)), [-1.0, 0.0]])]
    df = spark.createDataFrame(rows, "metric string, band string, value double")
    p = []
    for sliced in (5_000, 20):
        monkeypatch.setattr(norms, "SLICED", sliced)
        p.append({x.metric: x.normality_p for x in norms.shapiro(df, ["metric", "band"]).collect()})
    assert all(abs(p[0][m] - p[1][m]) < 1e-12 for m in p[0]) and p[0]["absolute_power"] > 0.01 > p[0]["x"]
