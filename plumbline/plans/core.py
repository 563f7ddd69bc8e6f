"""The norm-building and scoring queries over the given tables, and their independent SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.numeric import SW_C1, SW_C2, low_first, norm_ppf, num, shapiro_p, t_table, two_tailed
from plumbline.plans import norms
from plumbline.plans.catalog import CELL, FAN, LOG, MEANS, r
from plumbline.plans.sql import run
from plumbline.session import written
from plumbline.sources.fixtures import EDGES, NEIGHBOURS, POINTS

NUDGE = 1.23e-8


def rounded(rows: DataFrame, *columns: str) -> DataFrame:
    """Columns as catalog.r() gives them; structs and arrays are left out by the caller.

    Millionths are rounded, as DuckDB does: Spark's round to six digits goes by the decimals of the double, which a tie of ten-digit scores may miss by a bit.
    """
    kinds = dict(rows.dtypes)
    return rows.select(*((F.round((F.col(c) + NUDGE) * 1e6) / 1e6 + 0.0).alias(c) if kinds[c] == "double" else F.col(c) for c in columns))


def scaled(x: str) -> str:
    """Values of any size: six decimals below 100, two above."""
    return f"(CASE WHEN abs({x}) < 100 THEN {r(x)} ELSE round({x} + {num(1.23e-5)}, 2) END)"


def norm_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = norms.norm_cells(norms.metrics(spark, sf_dir), shape=False)
    points = {f"p{str(p).replace('.', '_')}": F.element_at("percentiles", i + 1) for i, p in enumerate(POINTS)}
    numbers = ["mean", "sd", "log_mean", "log_sd", "ci_lower", "ci_upper", "pi_lower", "pi_upper", *points]
    return cells.withColumns(points).select(*norms.KEYS, "n", "log_transformed", *(F.expr(scaled(c)).alias(c) for c in numbers))


def cell_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = norms.norm_cells(norms.metrics(spark, sf_dir))
    return rounded(cells, *norms.KEYS, "skewness", "kurtosis", "normality_p", "transform_normalized")


def _scored(spark: SparkSession, sf_dir: str, ranks: bool = True) -> DataFrame:
    """Scores of the metrics against their own norms; ranks: with those that come from percentiles.

    Metrics are read for the cells and for the scores, cells are few: as tables, metrics are shuffled once and meet the cells by broadcast.
    """
    rows = written(norms.metrics(spark, sf_dir))
    cells = written(norms.best_cells(norms.norm_cells(rows, shape=False, percentiles=ranks)))
    return norms.score(rows, cells, edges=EDGES)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scored(spark, sf_dir), "subject_id", "condition", "channel", "band", "metric", "used", "z", "rank", "robust_z", "p", "se_z", "cohen_d", "severity", "low_confidence")


def false_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(norms.false_discovery(_scored(spark, sf_dir, ranks=False)), "subject_id", "condition", "channel", "band", "metric", "k", "m", "threshold", "significant")


def report_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = norms.false_discovery(_scored(spark, sf_dir, ranks=False))
    out = found.groupBy("subject_id", "condition").agg(F.count("*").alias("n_tests"), F.count_if("significant").alias("n_significant"), (F.count("*") * F.lit(0.05)).alias("expected_false"), F.count_if(F.col("used") == "pooled").alias("n_pooled"))
    return rounded(out, *out.columns)


def global_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = norms.global_patterns(_scored(spark, sf_dir, ranks=False), cut=0.5, share=0.4)
    return rounded(out, *out.columns)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = norms.clusters(_scored(spark, sf_dir, ranks=False), cut=1.0).drop("root")
    return rounded(out, *out.columns)


def trust_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each z can be trusted: its distance from the robust one, thin cells, and whether the value is in the prediction interval."""
    rows = _scored(spark, sf_dir).withColumn("parametric_z_unreliable", F.col("low_confidence") | F.col("discrepant"))
    return rounded(rows, "subject_id", "condition", "channel", "band", "metric", "z_discrepancy", "discrepant", "parametric_z_unreliable", "in_prediction")


def effect_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohen's d in words and the tier of severity, counted for each subject."""
    d = F.round(F.abs("cohen_d"), 9)  # limits fall on whole digits, not on the order of sums
    label = F.when(d.isNull(), "none").when(d < 0.2, "negligible").when(d < 0.5, "small").when(d < 0.8, "medium").otherwise("large")
    return _scored(spark, sf_dir).groupBy("subject_id", "condition", label.alias("effect"), "severity").agg(F.count("*").alias("n"))


def metric_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places where two metrics deviate in opposite directions: total against periodic power, and total against relative power."""
    out = norms.pair_disagreements(_scored(spark, sf_dir, ranks=False))
    return rounded(out, *out.columns)


def significant_findings(spark: SparkSession, sf_dir: str, alpha: float = 0.2) -> DataFrame:
    """Each subject's significant values, the most deviant first."""
    found = norms.false_discovery(_scored(spark, sf_dir, ranks=False), alpha=alpha).where("significant")
    order = Window.partitionBy("subject_id", "condition").orderBy(F.desc(F.abs("z")), "channel", "band", "metric")
    return rounded(found.withColumn("place", F.row_number().over(order)), "subject_id", "condition", "channel", "band", "metric", "z", "place")


def transform_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 cells whose scoring space is furthest from normal: a report of its own length."""
    cells = norms.norm_cells(norms.metrics(spark, sf_dir))
    # Ordered as shown, so that ties in the shown digits are ties. The filter comes last: pushed into p's formula it outgrows the compiler.
    return rounded(cells, *norms.KEYS, "n", "normality_p").orderBy(F.asc_nulls_last("normality_p"), *norms.KEYS).limit(25).where("normality_p < 0.05")


def shape_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are thin or not normal (p < 0.01), by bin and in all."""
    cells = norms.norm_cells(norms.metrics(spark, sf_dir))
    bad = F.col("normality_p") < 0.01
    out = cells.rollup("bin").agg(F.count("*").alias("n_cells"), F.min("n").alias("n_min"), F.expr("percentile(n, 0.5)").alias("n_median"), F.max("n").alias("n_max"), F.count_if(F.col("n") < 10).alias("n_thin"), F.count_if(F.coalesce(bad, F.lit(False))).alias("n_not_normal"), F.avg(bad.cast("double")).alias("share_not_normal"), F.count_if(F.coalesce(F.col("log_transformed") & ~F.col("transform_normalized"), F.lit(False))).alias("n_transform_failed"))
    return rounded(out, *out.columns)


def spectral_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Norms of spectra: log power by bin, condition, sex, channel and frequency (the band), with the normality of each."""
    cells = norms.norm_cells(run(spark, sf_dir, "SELECT * FROM spectra"))
    points = {f"p{str(p).replace('.', '_')}": F.element_at("percentiles", i + 1) for i, p in enumerate(POINTS)}
    return rounded(cells.withColumns(points), *norms.KEYS, "n", "mean", "sd", *points, "normality_p")


def psd_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log power by frequency over all spectra: a frequency's percentiles from exact ranks in slices, as those of cells."""
    rows = written(run(spark, sf_dir, f"SELECT freq, LOG10(GREATEST(psd, {num(1e-30)}) * 1e12) AS value FROM psd"))
    cells = written(rows.groupBy("freq").agg(F.count("*").alias("n"), F.count("*").alias("n_log"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd")))
    points = {f"p{str(p).replace('.', '_')}": F.element_at("percentiles", i + 1) for i, p in enumerate(POINTS)}
    out = norms.with_cells(norms.rank_statistics(rows, cells, ["freq"], False), cells, ["freq"], "n", "mean", "sd").withColumns(points)
    return out.select("freq", "n", *(F.expr(r(c)).alias(c) for c in ("mean", "sd", *points)))


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document for each subject and condition (its scores, the most deviant first) and a summary in words."""
    rows = rounded(_scored(spark, sf_dir, ranks=False), "subject_id", "condition", "channel", "band", "metric", "z", "severity", "in_prediction")
    fields = ["channel", "band", "metric", "z", "severity", "in_prediction"]
    item = lambda x: F.struct((-F.abs(x["z"])).alias("order"), *(x[c].alias(c) for c in fields))
    # The order follows from z, so the shuffle goes without it.
    packed = rows.groupBy("subject_id", "condition").agg(F.collect_list(F.struct(*fields)).alias("items")).withColumn("items", F.array_sort(F.transform("items", item)))
    top = F.col("items")[0]
    far, outside = F.size(F.filter("items", lambda x: x["severity"] >= 3)), F.size(F.filter("items", lambda x: ~x["in_prediction"]))
    words = F.format_string("%s: %d values, %d at 1.5 or beyond, %d outside the prediction interval; most deviant %s %s %s", "condition", F.size("items"), far, outside, top["channel"], top["band"], top["metric"])
    return packed.select("subject_id", "condition", F.size("items").cast("long").alias("n"), words.alias("summary"), F.to_json(F.struct("subject_id", "condition", "items")).alias("report"))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the JSON documents hold, read back: counts, the most deviant value and the summary."""
    kind = "struct<subject_id: long, condition: string, items: array<struct<order: double, channel: string, band: string, metric: string, z: double, severity: int, in_prediction: boolean>>>"
    got = report_json(spark, sf_dir).select(F.from_json("report", kind).alias("d"), "summary")
    top = F.col("d.items")[0]
    return got.select("d.subject_id", "d.condition", F.size("d.items").cast("long").alias("n"), top["channel"].alias("channel"), top["band"].alias("band"), top["metric"].alias("metric"), top["z"].alias("z"), "summary")


_T = "t975(df, t) AS (VALUES " + ", ".join(f"({i + 1}, CAST({float(t)!r} AS DOUBLE))" for i, t in enumerate(t_table())) + ")"
_PCTS = ", ".join(f"quantile_cont(value, {p / 100}) AS p{str(p).replace('.', '_')}" for p in POINTS)
_CELLS = f"""{FAN}, {_T}, lg AS (SELECT *, {LOG} AS is_log, CASE WHEN {LOG} AND value > 0 THEN ln(value) END AS lv FROM fan),
c0 AS (SELECT {CELL}, any_value(is_log) AS log_transformed, count(*) AS n, avg(value) AS mean, coalesce(stddev_samp(value), 0) AS sd, avg(lv) AS log_mean, count(lv) AS n_log, CASE WHEN count(lv) > 0 THEN coalesce(stddev_samp(lv), 0) END AS log_sd, {_PCTS},
 avg((value - m) ** 3) AS c3, avg((value - m) ** 2) AS c2, avg((value - m) ** 4) AS c4 FROM (SELECT *, avg(value) OVER (PARTITION BY {CELL}) AS m FROM lg) GROUP BY {CELL}),
c1 AS (SELECT c0.*, t, CASE WHEN log_transformed THEN n_log ELSE n END AS k, CASE WHEN log_transformed THEN log_mean ELSE mean END AS ce, CASE WHEN log_transformed THEN log_sd ELSE sd END AS sp FROM c0 LEFT JOIN t975 ON t975.df = CASE WHEN log_transformed THEN n_log ELSE n END - 1),
cells AS (SELECT *, CASE WHEN k >= 2 AND sp > 0 THEN CASE WHEN log_transformed THEN exp(ce - t * sp / sqrt(k)) ELSE ce - t * sp / sqrt(k) END END AS ci_lower, CASE WHEN k >= 2 AND sp > 0 THEN CASE WHEN log_transformed THEN exp(ce + t * sp / sqrt(k)) ELSE ce + t * sp / sqrt(k) END END AS ci_upper,
 CASE WHEN k >= 2 AND sp > 0 THEN CASE WHEN log_transformed THEN exp(ce - t * sp * sqrt(1 + 1.0 / k)) ELSE ce - t * sp * sqrt(1 + 1.0 / k) END END AS pi_lower, CASE WHEN k >= 2 AND sp > 0 THEN CASE WHEN log_transformed THEN exp(ce + t * sp * sqrt(1 + 1.0 / k)) ELSE ce + t * sp * sqrt(1 + 1.0 / k) END END AS pi_upper FROM c1)"""
_P = [f"p{str(p).replace('.', '_')}" for p in POINTS]
_RANK = f"CASE WHEN value <= {_P[0]} THEN 0.5 WHEN value >= {_P[-1]} THEN 99.5 " + " ".join(f"WHEN value >= {a} AND value <= {b} THEN CASE WHEN {b} > {a} THEN {num(x)} + {num(y - x)} * (value - {a}) / ({b} - {a}) ELSE {num((x + y) / 2)} END" for a, b, x, y in zip(_P[:-1], _P[1:], map(float, POINTS[:-1]), map(float, POINTS[1:]), strict=True)) + " END"
_SCORED = f"""{_CELLS}, own AS (SELECT m.*, b.bin FROM metrics m JOIN bins b ON m.age >= b.bin_lo AND m.age <= b.bin_hi - 1),
pick AS (SELECT o.subject_id, o.condition, o.channel, o.band, o.metric, o.value, c.sex AS used, c.* EXCLUDE (bin, bin_lo, bin_hi, sex, condition, channel, band, metric), row_number() OVER (PARTITION BY o.subject_id, o.condition, o.channel, o.band, o.metric ORDER BY CASE WHEN c.sex = 'pooled' THEN 1 ELSE 0 END) AS pr
 FROM own o JOIN cells c ON c.bin = o.bin AND c.condition = o.condition AND c.channel = o.channel AND c.band = o.band AND c.metric = o.metric AND c.sex IN ('pooled', o.sex)),
z0 AS (SELECT *, CASE WHEN log_transformed AND value > 0 AND log_mean IS NOT NULL AND log_sd > 0 THEN (ln(value) - log_mean) / log_sd WHEN sd > 0 THEN (value - mean) / sd WHEN mean <> 0 THEN (value - mean) / abs(mean) ELSE 0 END AS z_raw, CAST({_RANK} AS DOUBLE) AS rank FROM pick WHERE pr = 1),
z1 AS (SELECT *, round(z_raw, 10) AS z, CASE WHEN n < 200 THEN greatest(1.0, least(99.0, rank)) ELSE greatest(0.5, least(99.5, rank)) END / 100 AS q FROM z0),
scored AS (SELECT *, {norm_ppf("q")} AS robust_z, {two_tailed("z")} AS p, sqrt(1.0 / n + z * z / (2 * n)) AS se_z, CASE WHEN sd > 0 THEN (value - mean) / sd END AS cohen_d, CASE WHEN abs(z) < 0.5 THEN 0 WHEN abs(z) < 1 THEN 1 WHEN abs(z) < 1.5 THEN 2 WHEN abs(z) < 2 THEN 3 WHEN abs(z) < 3 THEN 4 ELSE 5 END AS severity, n < 10 AS low_confidence FROM z1)"""


def fdr_sql(alpha: float = 0.05) -> str:
    return f"""{_SCORED}, f0 AS (SELECT *, row_number() OVER (PARTITION BY subject_id, condition ORDER BY p, channel, band, metric) AS k2, count(*) OVER (PARTITION BY subject_id, condition) AS m2 FROM scored),
f1 AS (SELECT *, max(CASE WHEN p <= {alpha} * k2 / m2 THEN k2 END) OVER (PARTITION BY subject_id, condition) AS largest FROM f0),
fdr AS (SELECT *, CAST({alpha} AS DOUBLE) * k2 / m2 AS threshold, k2 <= coalesce(largest, 0) AS significant FROM f1)"""


_FDR = fdr_sql()


def significant_sql(alpha: float) -> str:
    return f"WITH {fdr_sql(alpha)} SELECT subject_id, condition, channel, band, metric, {r('z')} AS z, row_number() OVER (PARTITION BY subject_id, condition ORDER BY abs(z) DESC, channel, band, metric) AS place FROM fdr WHERE significant"


def patterns_sql(cut: float, share: float) -> str:
    return f"WITH {_SCORED}, g AS (SELECT subject_id, condition, band, metric, d.direction, count(*) AS n_channels, count_if(z * d.s > {cut}) AS n_deviant FROM scored CROSS JOIN (VALUES ('high', 1), ('low', -1)) AS d(direction, s) GROUP BY ALL) SELECT *, {r('n_deviant * CAST(1 AS DOUBLE) / n_channels')} AS share FROM g WHERE n_deviant * CAST(1 AS DOUBLE) / n_channels >= {share}"


def clusters_sql(cut: float) -> str:
    return f"WITH RECURSIVE {_SCORED}, dev AS (SELECT subject_id, condition, band, metric, channel, z, CASE WHEN z > 0 THEN 'high' ELSE 'low' END AS direction FROM scored WHERE abs(z) > {cut}), walk AS (SELECT subject_id, condition, band, metric, direction, channel, channel AS seen FROM dev UNION SELECT w.subject_id, w.condition, w.band, w.metric, w.direction, w.channel, d.channel FROM walk w JOIN adjacency a ON a.channel = w.seen JOIN dev d ON d.channel = a.neighbour AND d.subject_id = w.subject_id AND d.condition = w.condition AND d.band = w.band AND d.metric = w.metric AND d.direction = w.direction), root AS (SELECT subject_id, condition, band, metric, direction, channel, min(seen) AS root FROM walk GROUP BY ALL) SELECT r.subject_id, r.condition, r.band, r.metric, r.direction, count(*) AS size, string_agg(r.channel, ',' ORDER BY r.channel) AS channels, {r('avg(abs(d.z))')} AS mean_abs_z, {r('max(abs(d.z))')} AS max_abs_z FROM root r JOIN dev d USING (subject_id, condition, band, metric, direction, channel) GROUP BY r.subject_id, r.condition, r.band, r.metric, r.direction, r.root HAVING count(*) >= 2"


_U = "(1 / sqrt(k))"
_A1 = f"(CASE WHEN k = 3 THEN sqrt({num(0.5)}) ELSE {low_first(SW_C1, _U)} + mn / sqrt(mm) END)"
_A2 = f"({low_first(SW_C2, _U)} + mn1 / sqrt(mm))"
_SHAPE = f"""{_CELLS}, sx AS (SELECT {CELL}, CASE WHEN is_log THEN lv ELSE value END AS x FROM lg), sr AS (SELECT *, row_number() OVER (PARTITION BY {CELL} ORDER BY x) AS i, count(*) OVER (PARTITION BY {CELL}) AS k FROM sx WHERE x IS NOT NULL),
sm AS (SELECT *, CASE WHEN 2 * i = k + 1 THEN 0.0 ELSE {norm_ppf("((i - 0.375) / (k + 0.25))")} END AS m FROM sr WHERE k >= 3),
se AS (SELECT *, sum(m * m) OVER w AS mm, max(CASE WHEN i = k THEN m END) OVER w AS mn, max(CASE WHEN i = k - 1 THEN m END) OVER w AS mn1 FROM sm WINDOW w AS (PARTITION BY {CELL})),
sa AS (SELECT *, {_A1} AS a1, {_A2} AS a2 FROM se),
sw AS (SELECT *, CASE WHEN k > 5 THEN (mm - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * a1 * a1 - 2 * a2 * a2) ELSE (mm - 2 * mn * mn) / nullif(1 - 2 * a1 * a1, 0) END AS phi FROM sa),
wt AS (SELECT *, CASE WHEN i = k THEN a1 WHEN i = 1 THEN -a1 WHEN k > 5 AND i = k - 1 THEN a2 WHEN k > 5 AND i = 2 THEN -a2 WHEN k = 3 THEN 0 ELSE m / sqrt(phi) END AS a FROM sw),
st AS (SELECT {CELL}, max(k) AS k, sum(a * x) ** 2 / nullif(var_pop(x) * count(*), 0) AS w FROM wt GROUP BY {CELL} HAVING max(x) > min(x)),
shape AS (SELECT *, {shapiro_p("w", "k")} AS normality_p FROM st)"""


def _cols(*names: str) -> str:
    return ", ".join(f"{r(n)} AS {n}" for n in names)


_FIRST = "row_number() OVER (PARTITION BY subject_id, condition ORDER BY -abs(zr), channel, band, metric)"
_KEYLIST = "subject_id, condition, channel, band, metric"
_FLAGS = f"{_SCORED}, flag AS (SELECT *, abs(z - robust_z) AS gap, value BETWEEN pi_lower AND pi_upper AS inside, {r('z')} AS zr FROM scored)"
SHAPED = f"{_SHAPE}, sc AS (SELECT c.*, s.normality_p FROM cells c LEFT JOIN shape s ON s.bin = c.bin AND s.sex = c.sex AND s.condition = c.condition AND s.channel = c.channel AND s.band = c.band AND s.metric = c.metric)"
ORACLES = {
    "z4_trust_flags": f"WITH {_FLAGS} SELECT {_KEYLIST}, {r('gap')} AS z_discrepancy, gap > 1 AS discrepant, gap > 1 OR low_confidence AS parametric_z_unreliable, inside AS in_prediction FROM flag",
    "p12_effect_labels": f"WITH {_SCORED} SELECT subject_id, condition, CASE WHEN cohen_d IS NULL THEN 'none' WHEN round(abs(cohen_d), 9) < 0.2 THEN 'negligible' WHEN round(abs(cohen_d), 9) < 0.5 THEN 'small' WHEN round(abs(cohen_d), 9) < 0.8 THEN 'medium' ELSE 'large' END AS effect, severity, count(*) AS n FROM scored GROUP BY ALL",
    "z8_metric_disagreement": f"""WITH {_SCORED}, wide AS (SELECT subject_id, condition, channel, band, max(CASE WHEN metric = 'absolute_power' THEN z END) AS t, max(CASE WHEN metric = 'corrected_absolute_power' THEN z END) AS c, max(CASE WHEN metric = 'relative_power' THEN z END) AS s FROM scored GROUP BY ALL),
pr AS (SELECT subject_id, condition, channel, band, unnest([{{'second': 'corrected_absolute_power', 'word': 'periodic', 'what': 'aperiodic', 'b': c}}, {{'second': 'relative_power', 'word': 'relative', 'what': 'broadband', 'b': s}}]) AS p, t AS a FROM wide)
SELECT subject_id, condition, channel, band, 'absolute_power' AS first, p.second AS second, {r('a')} AS a, {r('p.b')} AS b, concat('total power ', CASE WHEN a > 0 THEN 'elevated' ELSE 'reduced' END, ', ', p.word, ' power ', CASE WHEN p.b > 0 THEN 'elevated' ELSE 'reduced' END, ' at ', channel, ' ', band, ': the deviation is ', p.what) AS interpretation FROM pr WHERE sign(a) * sign(p.b) = -1 AND (abs(a) > 1.5 OR abs(p.b) > 1.5)""",
    "t5_significant_findings": significant_sql(0.2),
    "t3_transform_failures": f"WITH {SHAPED} SELECT {CELL}, n, {r('normality_p')} AS normality_p FROM sc WHERE normality_p < 0.05 ORDER BY {r('normality_p')}, {CELL} LIMIT 25",
    "a14_shape_rollup": f"WITH {SHAPED} SELECT bin, count(*) AS n_cells, min(n) AS n_min, {r('quantile_cont(n, 0.5)')} AS n_median, max(n) AS n_max, count_if(n < 10) AS n_thin, count_if(normality_p < 0.01) AS n_not_normal, {r('avg(CAST(normality_p < 0.01 AS INT))')} AS share_not_normal, count_if(log_transformed AND normality_p < 0.05) AS n_transform_failed FROM sc GROUP BY ROLLUP (bin)",
    "z9_report_lines": f"WITH {_FLAGS}, o AS (SELECT *, {_FIRST} AS place, count(*) OVER p AS n_all, count_if(severity >= 3) OVER p AS far, count_if(NOT inside) OVER p AS outside FROM flag WINDOW p AS (PARTITION BY subject_id, condition)) SELECT subject_id, condition, n_all AS n, channel, band, metric, zr AS z, printf('%s: %d values, %d at 1.5 or beyond, %d outside the prediction interval; most deviant %s %s %s', condition, n_all, far, outside, channel, band, metric) AS summary FROM o WHERE place = 1",
    "a1_norm_cells": f"WITH {_CELLS} SELECT {CELL}, n, log_transformed, {', '.join(f'{scaled(c)} AS {c}' for c in ('mean', 'sd', 'log_mean', 'log_sd', 'ci_lower', 'ci_upper', 'pi_lower', 'pi_upper', *_P))} FROM cells",
    "a5_cell_shape": f"WITH {_SHAPE} SELECT c.bin, c.bin_lo, c.bin_hi, c.sex, c.condition, c.channel, c.band, c.metric, {r('CASE WHEN n >= 3 AND sd > 0 THEN c3 / c2 ** 1.5 END')} AS skewness, {r('CASE WHEN n >= 3 AND sd > 0 THEN c4 / (c2 * c2) - 3 END')} AS kurtosis, {r('s.normality_p')} AS normality_p, s.normality_p >= 0.05 AS transform_normalized FROM cells c LEFT JOIN shape s ON s.bin = c.bin AND s.sex = c.sex AND s.condition = c.condition AND s.channel = c.channel AND s.band = c.band AND s.metric = c.metric",
    "z1_scores": f"WITH {_SCORED} SELECT subject_id, condition, channel, band, metric, used, severity, low_confidence, {_cols('z', 'rank', 'robust_z', 'p', 'se_z', 'cohen_d')} FROM scored",
    "w1_false_discovery": f"WITH {_FDR} SELECT subject_id, condition, channel, band, metric, k2 AS k, m2 AS m, {r('threshold')} AS threshold, significant FROM fdr",
    "a26_report_rollup": f"WITH {_FDR} SELECT subject_id, condition, count(*) AS n_tests, count_if(significant) AS n_significant, {r('count(*) * CAST(0.05 AS DOUBLE)')} AS expected_false, count_if(used = 'pooled') AS n_pooled FROM fdr GROUP BY ALL",
    "z6_global_patterns": patterns_sql(0.5, 0.4),
    "z7_clusters": clusters_sql(1.0),
}
PCTS = ", ".join(f"{r(c)} AS {c}" for c in _P)
#: The norm machinery over spectra in place of metrics.
SPECTRAL = f"WITH {SHAPED.replace('FROM metrics JOIN', 'FROM spectra JOIN')} SELECT {CELL}, n, {r('mean')} AS mean, {r('sd')} AS sd, {PCTS}, {r('normality_p')} AS normality_p FROM sc"
ORACLES["a8_spectral_norms"] = SPECTRAL
A8_PSD = f"SELECT freq, COUNT(*) AS n, {r(f'AVG(LOG10(GREATEST(psd, {num(1e-30)}) * 1e12))')} AS mean, {r(f'STDDEV_SAMP(LOG10(GREATEST(psd, {num(1e-30)}) * 1e12))')} AS sd, " + ", ".join(f"{r(f'quantile_cont(LOG10(GREATEST(psd, {num(1e-30)}) * 1e12), {p / 100})')} AS p{str(p).replace('.', '_')}" for p in POINTS) + " FROM psd GROUP BY freq"
ORACLES["a8_psd_norms"] = A8_PSD
QUERIES = {"z4_trust_flags": trust_flags, "p12_effect_labels": effect_labels, "z8_metric_disagreement": metric_disagreement, "t5_significant_findings": significant_findings, "t3_transform_failures": transform_failures, "a14_shape_rollup": shape_rollup, "a8_spectral_norms": spectral_norms, "a8_psd_norms": psd_norms, "z9_report_lines": report_lines} | {"a1_norm_cells": norm_cells, "a5_cell_shape": cell_shape, "z1_scores": scores, "w1_false_discovery": false_discovery, "a26_report_rollup": report_rollup, "z6_global_patterns": global_patterns, "z7_clusters": clusters, "z9_report_json": report_json}

assert all(set(NEIGHBOURS[b]) >= {a} for a, bs in NEIGHBOURS.items() for b in bs), "adjacency goes both ways"
__all__ = ["MEANS", "ORACLES", "QUERIES", "run"]
