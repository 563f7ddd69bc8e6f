"""Halves, reliability, disagreement, spectra and order, each against something made apart."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline import registry
from plumbline.operators import halves
from plumbline.plans import norms, reports


def test_halves_are_exact_and_in_hash_order(spark, monkeypatch):
    for digits, n in ((4, 1001), (1, 1000), (0, 7)):
        monkeypatch.setattr(halves, "DIGITS", digits)
        got = {x.subject_id: x.first for x in halves.halves(spark.range(n).withColumnRenamed("id", "subject_id"), 3, 7).collect()}
        for k in range(3):
            order = sorted(range(n), key=lambda i: hashlib.md5(f"7:{k}:{i}".encode()).hexdigest())
            assert {i for i, first in got.items() if first[k]} == set(order[: n // 2])


def test_split_cells_equal_a_plain_split(spark):
    r = np.random.default_rng(0)
    rows = [(i, 25.0 + i % 20, "eo", c, "Alpha", m, float(r.normal(j, 1))) for i in range(60) for j, c in enumerate(("Fz", "Pz")) for m in ("relative_power", "x")] + [(None, 25.0, "eo", "Fz", "Alpha", "x", 9e9), (1, 25.0, "eo", "Fz", "Alpha", "x", float("nan"))]
    df = spark.createDataFrame(rows, "subject_id long, age double, condition string, channel string, band string, metric string, value double")
    side = {x.subject_id: x.first for x in halves.halves(df, 4, 1).collect()}
    for x in halves.split_cells(df, 4, 1).collect():
        mine = {s: [v for i, age, _, c, _, m, v in rows if i is not None and v == v and side[i][x.split] == s and c == x.channel and m == x.metric and f"{int(age // 10 * 10)}-{int(age // 10 * 10) + 9}" == x.bin] for s in (True, False)}
        assert min(map(len, mine.values())) >= 3 and abs(np.mean(mine[True]) - x.mean_a) < 1e-12 and abs(np.mean(mine[False]) - x.mean_b) < 1e-9
    summary = {x.scope: x for x in halves.split_half_summary(halves.split_half(df, splits=4, seed=1)).collect()}
    assert set(summary) <= {"overall", "core", "relative_power", "x"}


def slope(spark, x1, x2):
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x1, x2)], "x1 double, x2 double")
    lev, d = (F.col("x1") + F.col("x2")) / 2, F.abs(F.col("x2") - F.col("x1"))
    one = rows.select(lev.alias("lev"), d.alias("d")).agg(F.count("*").alias("n"), F.regr_slope("d", "lev").alias("slope"), F.corr("d", "lev").alias("r"))
    return reports.heteroscedasticity(one).first()


def test_differences_that_grow_with_the_level_have_a_small_p(spark):
    r = np.random.RandomState(1)
    x = r.uniform(1, 100, 400)
    got = slope(spark, x, x + r.normal(0, 1, 400) * x * 0.2)
    assert got.slope > 0 and got.p < 0.01
    r = np.random.RandomState(2)
    x = r.uniform(1, 100, 400)
    assert slope(spark, x, x + r.normal(0, 5, 400)).p > 0.05


def test_tail_of_student_t(spark):
    # Published quantiles: p of 0.05 and 0.001 at 1, 10 and 120 degrees of freedom.
    rows = [(12.7062047, 1, 0.05), (2.2281389, 10, 0.05), (4.5868939, 10, 0.001), (1.9799304, 120, 0.05), (0.0, 5, 1.0)]
    got = spark.createDataFrame(rows, "t double, df long, want double").withColumn("p", reports.two_tailed_t(F.col("t"), F.col("df"))).collect()
    assert all(abs(x.p - x.want) < 1e-7 for x in got)
    odd = spark.createDataFrame([(None, 3), (1.0, 0), (float("inf"), 4)], "t double, df long").withColumn("p", reports.two_tailed_t(F.col("t"), F.col("df"))).collect()
    assert [x.p for x in odd] == [None, None, 0.0]


def test_disagreement_of_total_and_periodic_power(spark):
    rows = [(1, "eo", "Fz", "Alpha", "absolute_power", 2.5), (1, "eo", "Fz", "Alpha", "corrected_absolute_power", -0.3), (1, "eo", "Pz", "Alpha", "absolute_power", 1.4), (1, "eo", "Pz", "Alpha", "corrected_absolute_power", -1.4), (1, "eo", "Cz", "Alpha", "absolute_power", 9.0), (1, "eo", "O1", "Alpha", "absolute_power", 2.0), (1, "eo", "O1", "Alpha", "relative_power", -2.0)]
    got = norms.disagreements(spark.createDataFrame(rows, "subject_id long, condition string, channel string, band string, metric string, z double")).collect()
    assert [(x.channel, x.absolute_z, x.corrected_z) for x in got] == [("Fz", 2.5, -0.3)] and "elevated, periodic power reduced" in got[0].interpretation and "aperiodic" in got[0].interpretation


def test_disagreement_of_both_pairs(spark):
    z = {("Fz", "absolute_power"): 2.5, ("Fz", "corrected_absolute_power"): -0.3, ("Fz", "relative_power"): -1.0, ("Pz", "absolute_power"): -1.4, ("Pz", "relative_power"): 1.6, ("Cz", "absolute_power"): 1.5, ("Cz", "relative_power"): -1.5, ("O1", "absolute_power"): 9.0, ("O1", "relative_power"): None}
    rows = [(1, "eo", channel, "Alpha", metric, value) for (channel, metric), value in z.items()]
    got = norms.pair_disagreements(spark.createDataFrame(rows, "subject_id long, condition string, channel string, band string, metric string, z double")).collect()
    assert sorted((x.channel, x.second, x.a, x.b) for x in got) == [("Fz", "corrected_absolute_power", 2.5, -0.3), ("Fz", "relative_power", 2.5, -1.0), ("Pz", "relative_power", -1.4, 1.6)]
    assert {x.interpretation for x in got if x.channel == "Pz"} == {"total power reduced, relative power elevated at Pz Alpha: the deviation is broadband"}


def test_disagreement_query_finds_relative_power(spark):
    got = registry.queries()["z8_metric_disagreement"](spark, "/root/testdata/sf0.001")
    assert got.where("second = 'relative_power'").count() > 0


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Spectra of a 1/f slope: one with a 10 Hz peak, one without, one too noisy to have a single one."""
    at = str(tmp_path_factory.mktemp("planted"))
    freq = np.arange(64) * 0.78125
    base = np.r_[1.0, freq[1:] ** -1.2]
    peak = base * 10 ** (0.9 * np.exp(-((freq - 10.15625) ** 2) / 2))
    rows = [(i, np.sqrt(p).tolist(), 0) for i, p in enumerate((base, peak))]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{at}/embeddings.parquet")
    return at, freq, base, peak


def test_planted_peak_under_a_slope_is_found(spark, planted):
    got = {x.recording_id: x for x in registry.queries()["k10_alpha_frequency"](spark, planted[0]).collect()}
    assert got[1].peak == 10.15625 and got[1].height > 0.7 and got[0].peak is None


def test_periodic_power_is_the_trapezoid_of_the_flattened_spectrum(spark, planted):
    at, freq, base, peak = planted
    inside = (freq >= 0.5) & (freq <= 50)
    fit = (freq >= 2) & (freq <= 40)
    for i, psd in enumerate((base, peak)):
        x, y = np.log10(freq[fit]), np.log10(psd[fit])
        b, a = np.polyfit(x, y, 1)
        low = y <= a + b * x + 1e-12
        b, a = np.polyfit(x[low], y[low], 1)
        flat = psd[inside] / 10 ** (a + b * np.log10(freq[inside]))
        for row in registry.queries()["k6_corrected_power"](spark, at).where(F.col("recording_id") == i).collect():
            from plumbline.sources.fixtures import BANDS

            lo, hi = BANDS[row.band]
            k = (freq[inside] >= lo) & (freq[inside] <= hi)
            want = np.trapezoid(flat[k], freq[inside][k])
            assert abs(row.corrected_absolute - want) < 2e-6 and abs(row.corrected_relative - want / np.trapezoid(flat, freq[inside])) < 2e-6


def test_sorted_tables_are_sorted(spark):
    sf = "/root/testdata/sf0.001"
    cells = [(int(x.bin.split("-")[0]), x.sex, x.condition, x.channel, x.band, x.metric) for x in registry.queries()["t1_cell_order"](spark, sf).collect()]
    assert cells == sorted(cells) and len(cells) > 100
    rows = [(x.order_icc, x.condition, x.channel, x.band, x.metric) for x in registry.queries()["t2_reliability_order"](spark, "/root/testdata/sf0.01").collect()]
    assert len(rows) > 100 and all(a[0] <= b[0] for a, b in zip(rows, rows[1:]))
