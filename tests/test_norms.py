import math

import pytest

from plumbline.plans import norms

SCHEMA = "subject_id long, age double, sex string, condition string, channel string, band string, metric string, value double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(i, age, sex, value, channel="Fz", metric="relative_power"):
    return (i, age, sex, "eo", channel, "Alpha", metric, value)


def test_cells_of_one_and_two(spark):
    cells = {(c.sex, c.bin): c for c in norms.norm_cells(frame(spark, [row(1, 25.0, " f ", 3.0), row(2, 35.0, "M", 1.0), row(3, 36.0, "x", 2.0), row(4, 80.0, "M", 9.0), row(5, 33.0, "M", float("nan")), row(6, 33.0, "M", None)])).collect()}
    one = cells["F", "20-29"]
    assert (one.n, one.sd, one.ci_lower, one.skewness, one.normality_p) == (1, 0.0, None, None, None) and set(one.percentiles) == {3.0}
    assert cells["pooled", "30-39"].n == 2 and ("M", "30-39") in cells and not any(b == "80-89" for _, b in cells)
    assert cells["pooled", "30-39"].ci_upper == pytest.approx(1.5 + 12.7062047 * math.sqrt(0.5) / math.sqrt(2), abs=1e-5)


def test_sex_cell_is_preferred_and_half_years_match_no_label(spark):
    build = frame(spark, [row(i, 25.0, "F", 1.0 + i / 10) for i in range(3)] + [row(9 + i, 25.0, "M", 2.0 + i / 10) for i in range(3)])
    cells = norms.best_cells(norms.norm_cells(build))
    scored = norms.score(frame(spark, [row(1, 25.0, "F", 1.5), row(2, 25.0, "Other", 1.5), row(3, 29.5, "F", 1.5)]), cells)
    got = {r.subject_id: r for r in scored.collect()}
    assert got[1].used == "F" and got[2].used == "pooled" and got[1].z > got[2].z and 3 not in got
    assert norms.score(frame(spark, [row(3, 29.5, "F", 1.5)]), cells, match="half_open").count() == 1


def test_log_metric_with_no_positive_value_uses_the_raw_branch(spark):
    build = frame(spark, [row(i, 25.0, "M", float(i + 1), metric="absolute_power") for i in range(5)])
    cells = norms.best_cells(norms.norm_cells(build))
    z = norms.score(frame(spark, [row(1, 25.0, "x", -1.0, metric="absolute_power")]), cells).first().z
    assert z == pytest.approx((-1 - 3) / math.sqrt(2.5), abs=1e-9)


def test_false_discovery_takes_the_largest_passing_rank(spark):
    ps = [0.01, 0.02, 0.03, 0.04, 0.5]
    rows = spark.createDataFrame([(1, "eo", f"c{i}", "Alpha", "m", p) for i, p in enumerate(ps)], "subject_id long, condition string, channel string, band string, metric string, p double")
    assert [r.significant for r in norms.false_discovery(rows).orderBy("k").collect()] == [True] * 4 + [False]


def test_clusters_join_neighbours_of_one_direction(spark):
    rows = [(1, "eo", c, "Alpha", "m", z) for c, z in [("O1", 2.5), ("O2", 2.0), ("P3", 2.2), ("Fz", 3.0), ("F3", -3.0), ("Fp1", 2.0), ("Fp2", 1.9)]]
    found = norms.clusters(spark.createDataFrame(rows, "subject_id long, condition string, channel string, band string, metric string, z double")).collect()
    assert sorted((r.channels, r.size) for r in found) == [("Fp1,Fp2", 2), ("O1,O2,P3", 3)]


def test_stream_refreshes_touched_cells(spark, tmp_path):
    from plumbline.streaming.norms_stream import ingest, newest_cells

    first = [row(i, 25.0, "F", float(i)) for i in range(4)]
    more = [row(0, 25.0, "F", 99.0), row(7, 25.0, "F", 5.0), row(8, 45.0, "M", 5.0), row(None, 25.0, "F", 1.0)]
    frame(spark, first).coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    ingest(spark, f"{tmp_path}/in", frame(spark, []).schema, f"{tmp_path}/store", f"{tmp_path}/check").awaitTermination()
    frame(spark, more).coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    ingest(spark, f"{tmp_path}/in", frame(spark, []).schema, f"{tmp_path}/store", f"{tmp_path}/check").awaitTermination()
    got = {(c.bin, c.sex): (c.n, round(c.mean, 6)) for c in newest_cells(spark, f"{tmp_path}/store").collect()}
    assert got == {("20-29", "pooled"): (5, 2.2), ("20-29", "F"): (5, 2.2), ("40-49", "pooled"): (1, 5.0), ("40-49", "M"): (1, 5.0)}
