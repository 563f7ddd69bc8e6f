"""Reports on reliability, agreement and distribution: queries of their own with DuckDB oracles, and SQL that both share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numeric import t_sf
from plumbline.operators import halves
from plumbline.plans import catalog, montages, norms, spectra
from plumbline.plans.catalog import ICC, PAIRS, corr, r
from plumbline.plans.core import SHAPED, rounded
from plumbline.plans.sql import run
from plumbline.session import ship

LEAST_PAIRS, LOW_ICC, ALPHA = 10, 0.70, 0.05


def two_tailed_t(t: Column, df: Column) -> Column:
    """p of Student's t by the incomplete beta function; for result rows, not for every value."""

    @F.pandas_udf("double")
    def p(t: pd.Series, df: pd.Series) -> pd.Series:
        out = np.full(len(t), np.nan)
        x, k = t.to_numpy(float, na_value=np.nan), df.to_numpy(float, na_value=np.nan)
        ok = ~np.isnan(x) & (k >= 1)
        out[ok] = np.where(np.isinf(x[ok]), 0.0, t_sf(np.where(np.isinf(x[ok]), 0.0, x[ok]), k[ok]))
        return pd.Series(out)

    found = p(t.cast("double"), df.cast("double"))
    return F.when(~F.isnan(found), found)


LEVELS = f"""{PAIRS}, t AS (SELECT condition, channel, band, metric, ABS(x2 - x1) AS d, x2 - x1 AS raw, (x1 + x2) / 2 AS lev, ROW_NUMBER() OVER (PARTITION BY condition, channel, band, metric ORDER BY (x1 + x2) / 2, subject_id) AS k, COUNT(*) OVER (PARTITION BY condition, channel, band, metric) AS n FROM pair),
het AS (SELECT condition, channel, band, metric, COUNT(*) AS n, CASE WHEN STDDEV_POP(lev) > 0 THEN regr_slope(d, lev) END AS slope, {corr('d', 'lev')} AS r,
 CASE WHEN COUNT(*) >= 6 THEN COALESCE(VAR_SAMP(CASE WHEN k > n - CAST(FLOOR(n / 3) AS BIGINT) THEN raw END), 0) / nullif(VAR_SAMP(CASE WHEN k <= CAST(FLOOR(n / 3) AS BIGINT) THEN raw END), 0) END AS tail_ratio FROM t GROUP BY condition, channel, band, metric HAVING COUNT(*) >= 3)"""
KEYS = ["condition", "channel", "band", "metric"]


def heteroscedasticity(rows: DataFrame) -> DataFrame:
    """p of the slope of rows with n and r: two-tailed t with n - 2 degrees of freedom."""
    t = F.col("r") * F.sqrt((F.col("n") - 2) / F.nullif(1 - F.col("r") * F.col("r"), F.lit(0.0)))
    return rows.withColumn("p", two_tailed_t(F.when(F.abs("r") >= 1, F.lit(float("inf"))).otherwise(t), F.col("n") - 2))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return heteroscedasticity(run(spark, sf_dir, f"WITH {LEVELS} SELECT condition, channel, band, metric, n, slope, r, tail_ratio FROM het"))


def r4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_levels(spark, sf_dir), *KEYS, "n", "slope", "r", "p", "tail_ratio")


RELIABILITY = f"""{ICC}, beyond AS (SELECT r.condition, r.channel, r.band, r.metric, MAX(r.n) AS n, MAX(r.icc) AS icc, AVG(CASE WHEN ABS(p.x2 - p.x1) > r.sem * 1.96 * SQRT(2) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS share FROM rel2 r JOIN pair p ON p.condition = r.condition AND p.channel = r.channel AND p.band = r.band AND p.metric = r.metric GROUP BY r.condition, r.channel, r.band, r.metric)"""


def r6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline numbers of the reliability table, by metric and in all: low ICC, and differences that grow with the level (positive slope, p < 0.05)."""
    table = run(spark, sf_dir, f"WITH {RELIABILITY} SELECT condition, channel, band, metric, n, icc, share FROM beyond")
    both = table.join(_levels(spark, sf_dir).select(*KEYS, "slope", "p"), KEYS, "left")
    grows = F.coalesce((F.col("slope") > 0) & (F.col("p") < ALPHA), F.lit(False))
    out = both.rollup("metric").agg(
        F.count("*").alias("n"), F.expr("percentile(icc, 0.5)").alias("median_icc"), F.count_if(F.col("icc") < LOW_ICC).alias("n_low"), F.count_if(grows).alias("n_heteroscedastic"), F.expr("percentile(share, 0.5)").alias("median_share_beyond")
    )
    share = lambda c: F.col(c) / F.col("n")
    return rounded(out.withColumns({"share_low": share("n_low"), "share_heteroscedastic": share("n_heteroscedastic")}), "metric", "n", "median_icc", "n_low", "share_low", "n_heteroscedastic", "share_heteroscedastic", "median_share_beyond")


def _halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return halves.split_half(norms.metrics(spark, sf_dir))


def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_halves(spark, sf_dir), "split", "metric", "n_cells", "r")


def a16_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(halves.split_half_summary(_halves(spark, sf_dir)), "scope", "n_splits", "mean_r", "min_r", "max_r", "flag")


def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far cells' distributions are from normal, by metric and in all."""
    cells = norms.norm_cells(norms.metrics(spark, sf_dir))
    fails = lambda c: F.avg(F.when(F.col(c).isNotNull(), F.when(F.col(c), 0.0).otherwise(1.0)))
    out = cells.rollup("metric").agg(
        F.count("*").alias("n_cells"), F.count("skewness").alias("n_moments"), F.expr("percentile(abs(skewness), 0.5)").alias("median_abs_skewness"), F.avg(F.abs("skewness")).alias("mean_abs_skewness"),
        F.expr("percentile(kurtosis, 0.5)").alias("median_kurtosis"), F.avg("kurtosis").alias("mean_kurtosis"), F.avg(F.col("log_transformed").cast("int")).alias("share_log"), F.count("normality_p").alias("n_normality"),
        fails("transform_normalized").alias("share_not_normal"), F.count_if(~F.col("transform_normalized")).alias("n_transform_failed"),
    )
    return rounded(out, *out.columns)


_MD5 = f"md5(concat('{halves.SEED}:', k, ':', subject_id))"
_SPLIT = f"""half AS (SELECT k, subject_id, row_number() OVER (PARTITION BY k ORDER BY {_MD5}, subject_id) <= count(*) OVER (PARTITION BY k) // 2 AS first FROM (SELECT DISTINCT subject_id FROM metrics m JOIN bins ON age >= bin_lo AND age < bin_hi), range({halves.SPLITS}) AS g(k)),
grp AS (SELECT k, first, bin, condition, channel, band, metric, avg(value) AS mean FROM metrics JOIN half USING (subject_id) JOIN bins ON age >= bin_lo AND age < bin_hi GROUP BY ALL HAVING count(*) >= {halves.LEAST_CELL}),
both_ AS (SELECT a.k, a.metric, a.mean AS x, b.mean AS y FROM grp a JOIN grp b USING (k, bin, condition, channel, band, metric) WHERE a.first AND NOT b.first),
ov AS (SELECT k, count(*) AS n, {corr('x', 'y')} AS r FROM both_ GROUP BY k HAVING count(*) >= {halves.LEAST_CELLS}),
pm AS (SELECT k, metric, count(*) AS n, {corr('x', 'y')} AS r FROM both_ WHERE k IN (SELECT k FROM ov) GROUP BY ALL HAVING count(*) >= {halves.LEAST_METRIC}),
al AS (SELECT k, NULL AS metric, n, r FROM ov UNION ALL SELECT * FROM pm)"""
#: Student's tail for whole degrees of freedom as a finite sum of cosines.
_T = "(CASE WHEN abs(r) >= 1 THEN 0.0 ELSE {0} END)".format("""1 - CASE WHEN (n - 2) % 2 = 0 THEN sin(th) * list_sum(list_transform(range(0, (n - 2) // 2), lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1)) * cos(th) ** (2 * j)))
 ELSE 2 / pi() * (th + CASE WHEN n - 2 > 1 THEN sin(th) * list_sum(list_transform(range(0, (n - 3) // 2), lambda j: exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5)) * cos(th) ** (2 * j + 1))) ELSE 0 END) END""")
_P = f"ph AS (SELECT *, atan(abs(r) / sqrt(1 - r * r)) AS th FROM het), pv AS (SELECT * EXCLUDE (th), CASE WHEN r IS NOT NULL THEN {_T} END AS p FROM ph)"
ORACLES = {
    "a16_split_half": f"WITH {_SPLIT} SELECT CAST(k AS INT) AS split, metric, n AS n_cells, {r('r')} AS r FROM al",
    "a16_split_half_summary": f"""WITH {_SPLIT}, sc AS (SELECT coalesce(metric, 'overall') AS scope, r FROM al UNION ALL SELECT 'core', avg(r) FROM pm WHERE metric IN {halves.CORE} AND r IS NOT NULL GROUP BY k)
SELECT scope, count(r) AS n_splits, {r('avg(r)')} AS mean_r, {r('min(r)')} AS min_r, {r('max(r)')} AS max_r, CASE WHEN avg(r) < 0.8 THEN 'LOW' WHEN avg(r) IS NOT NULL THEN 'ok' END AS flag FROM sc GROUP BY scope""",
    "r4_heteroscedasticity": f"WITH {LEVELS}, {_P} SELECT condition, channel, band, metric, n, {r('slope')} AS slope, {r('r')} AS r, {r('p')} AS p, {r('tail_ratio')} AS tail_ratio FROM pv",
    "r6_reliability_summary": f"""WITH {RELIABILITY}, {LEVELS.removeprefix(PAIRS + ', ')}, {_P}, j AS (SELECT b.*, p.slope, p.p FROM beyond b LEFT JOIN pv p ON p.condition = b.condition AND p.channel = b.channel AND p.band = b.band AND p.metric = b.metric)
SELECT metric, count(*) AS n, {r('quantile_cont(icc, 0.5)')} AS median_icc, count_if(icc < {LOW_ICC}) AS n_low, {r(f'count_if(icc < {LOW_ICC}) / count(*)')} AS share_low, count_if(slope > 0 AND p < {ALPHA}) AS n_heteroscedastic, {r(f'count_if(slope > 0 AND p < {ALPHA}) / count(*)')} AS share_heteroscedastic, {r('quantile_cont(share, 0.5)')} AS median_share_beyond FROM j GROUP BY ROLLUP (metric)""",
    "a15_disclosure": f"""WITH {SHAPED}, k AS (SELECT *, CASE WHEN n >= 3 AND sd > 0 THEN c3 / c2 ** 1.5 END AS skew, CASE WHEN n >= 3 AND sd > 0 THEN c4 / (c2 * c2) - 3 END AS kurt FROM sc)
SELECT metric, count(*) AS n_cells, count(skew) AS n_moments, {r('quantile_cont(abs(skew), 0.5)')} AS median_abs_skewness, {r('avg(abs(skew))')} AS mean_abs_skewness, {r('quantile_cont(kurt, 0.5)')} AS median_kurtosis, {r('avg(kurt)')} AS mean_kurtosis, {r('avg(CAST(log_transformed AS INT))')} AS share_log, count(normality_p) AS n_normality, {r('avg(CAST(normality_p < 0.05 AS INT))')} AS share_not_normal, count_if(normality_p < 0.05) AS n_transform_failed FROM k GROUP BY ROLLUP (metric)""",
}
QUERIES = {"a16_split_half": a16, "a16_split_half_summary": a16_summary, "r4_heteroscedasticity": r4, "r6_reliability_summary": r6, "a15_disclosure": a15}

_LABEL = "CASE WHEN {0} > 0.90 THEN 'good' WHEN {0} > 0.80 THEN 'moderate' ELSE 'poor' END"
_R = f"CASE WHEN COUNT(*) >= 3 THEN {corr('m1', 'm2')} END"
SHARED: dict[str, str] = {
    # Cells of 3 values and more in both datasets; labels of agreement, which have one tier more over all cells.
    "a17_cross_dataset": f"""WITH grp AS (SELECT dataset, bin, condition, channel, band, metric, AVG(value) AS mean, COALESCE(STDDEV_SAMP(value), 0) AS sd, COUNT(*) AS n FROM metrics JOIN bins ON age >= bin_lo AND age < bin_hi GROUP BY dataset, bin, condition, channel, band, metric HAVING COUNT(*) >= 3),
 both_ AS (SELECT a.bin, a.metric, a.mean AS m1, b.mean AS m2, a.n AS n1, b.n AS n2, (a.mean - b.mean) / nullif(SQRT(((a.n - 1) * a.sd * a.sd + (b.n - 1) * b.sd * b.sd) / (a.n + b.n - 2)), 0) AS d FROM grp a JOIN grp b ON a.dataset = 0 AND b.dataset = 1 AND a.bin = b.bin AND a.condition = b.condition AND a.channel = b.channel AND a.band = b.band AND a.metric = b.metric),
 g AS (SELECT metric, bin, GROUPING(metric) AS gm, GROUPING(bin) AS gb, COUNT(*) AS n, MIN(n1) AS least_a, MIN(n2) AS least_b, {_R} AS r, AVG(ABS(d)) AS mean_d, MAX(ABS(d)) AS max_d FROM both_ GROUP BY GROUPING SETS ((metric), (bin), ()))
 SELECT metric, bin, n, least_a, least_b, {r('r')} AS r, {r('mean_d')} AS mean_d, {r('max_d')} AS max_d, CASE WHEN gm = 1 AND gb = 1 AND r > 0.95 THEN 'excellent' WHEN gb = 1 THEN {_LABEL.format('r')} END AS agreement FROM g""",
    # The alpha peak of a recording's spectrum (8 to 13 Hz) before and after: recordings 2k and 2k + 1.
    "a27_peak_shift": f"""WITH peak AS (SELECT recording_id, MAX_BY(freq, psd) AS peak FROM psd WHERE freq BETWEEN 8 AND 13 GROUP BY recording_id),
 shift AS (SELECT a.recording_id % 10 AS slot, b.peak - a.peak AS shift FROM peak a JOIN peak b ON b.recording_id = a.recording_id + 1 WHERE a.recording_id % 2 = 0)
 SELECT slot, COUNT(*) AS n, {r('AVG(shift)')} AS mean, {r('STDDEV_SAMP(shift)')} AS sd, {r('AVG(shift) / nullif(STDDEV_SAMP(shift), 0)')} AS d FROM shift GROUP BY slot""",
}
#: The checks of the summary: each one's rows with its verdict in the column ok (null: not decided).
CHECKS = {name: (catalog.QUERIES | montages.QUERIES | spectra.QUERIES)[name] for name in ("v1_alpha_closed_over_open", "v3_posterior_ratio", "v4_ranges", "v5_exponent_age", "v6_relative_sum", "v7_scale_consistency", "v8_source_checks", "v9_network_checks", "v10_topography")}
_CHECK = "SELECT '{0}' AS check_name, CASE WHEN COUNT(ok) = 0 THEN 'SKIP' WHEN COUNT_IF(NOT ok) = 0 THEN 'PASS' WHEN COUNT_IF(ok) * 10 >= COUNT(ok) * 9 THEN 'WARN' ELSE 'FAIL' END AS status, COUNT(*) AS n_tested, COALESCE(COUNT_IF(ok), 0) AS n_ok FROM {0}"
ALL_CHECKS = "WITH " + ", ".join(f"{name} AS ({text})" for name, text in CHECKS.items()) + ", done AS (" + " UNION ALL ".join(_CHECK.format(name) for name in CHECKS) + ")"
SHARED["v11_check_summary"] = f"{ALL_CHECKS} SELECT check_name, status, n_tested, n_ok FROM done"
SHARED["v11_status_counts"] = f"{ALL_CHECKS} SELECT status, COUNT(*) AS n, $JOIN(check_name) AS checks FROM done GROUP BY status"

