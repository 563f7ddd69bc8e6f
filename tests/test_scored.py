"""Queries over scores shuffle the metrics once, rank nothing that they don't show and leave no shuffle files behind their tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from plumbline import registry
from plumbline.plans import norms
from plumbline.plans.catalog import r
from plumbline.plans.core import rounded
from plumbline.session import written

SF = "/root/testdata/sf0.001"
UNRANKED = ["z7_clusters", "a26_report_rollup", "t5_significant_surveyed", "z7_clusters_surveyed", "w1_false_discovery", "z8_metric_disagreement", "z6_global_patterns", "z6_patterns_surveyed", "z9_report_json", "t5_significant_findings"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", UNRANKED)
def test_reads_tables_and_ranks_nothing(spark, monkeypatch, name):
    def ranked(*_):
        raise AssertionError("percentiles are not shown")

    monkeypatch.setattr(norms, "rank_statistics", ranked)
    out = registry.queries()[name](spark, SF)
    assert out.inputFiles() and not any("lineitem" in f for f in out.inputFiles())


def test_written_leaves_no_shuffle_files(spark):
    def shuffles():
        return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()

    before = shuffles()
    rows = written(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count())
    assert shuffles() == before and rows.count() == 7


def test_rounds_ties_as_the_oracle(spark):
    z = [0.2168344877, -0.2168345123, 0.0, -1e-9, 1e16, 7.5, None]
    got = [x.z for x in rounded(spark.createDataFrame([(v,) for v in z], "z double").coalesce(1), "z").collect()]
    assert got == [duckdb.execute(f"SELECT {r('CAST(? AS DOUBLE)')}", [v]).fetchone()[0] for v in z]
