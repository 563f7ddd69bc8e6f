"""Queries by inventory id that Spark and its oracle share as SQL text (see plans.sql); all over whole tables."""

from __future__ import annotations

from plumbline.functions.numeric import norm_cdf, norm_ppf, num, two_tailed
from plumbline.sources.fixtures import CHANNELS, POINTS


def r(x: str) -> str:
    """Rounded for comparison: nudged off the ties that averages of decimals lie on, and never a negative zero."""
    return f"(round(({x}) + {num(1.23e-8)}, 6) + 0.0)"


LOG = "(metric IN ('absolute_power', 'corrected_absolute_power', 'gsf_absolute_power') OR band LIKE '%/%')"
FAN = """fan AS (SELECT bin, bin_lo, bin_hi, 'pooled' AS sex, condition, channel, band, metric, value, subject_id, age, dataset FROM metrics JOIN bins ON age >= bin_lo AND age < bin_hi
 UNION ALL SELECT bin, bin_lo, bin_hi, sex, condition, channel, band, metric, value, subject_id, age, dataset FROM metrics JOIN bins ON age >= bin_lo AND age < bin_hi WHERE sex IN ('F', 'M'))"""
CELL = "bin, bin_lo, bin_hi, sex, condition, channel, band, metric"
#: Means only, as many checks need.
MEANS = f"{FAN}, cell AS (SELECT {CELL}, COUNT(*) AS n, AVG(value) AS mean, COALESCE(STDDEV_SAMP(value), 0) AS sd, $PCT(value, 0.5) AS p50 FROM fan GROUP BY {CELL})"
GUARDED = "covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


def corr(x: str, y: str) -> str:
    return GUARDED.format(x=x, y=y)


PAIR = "(SELECT subject_id, condition, channel, band, metric, MAX(CASE WHEN session = 'session1' THEN value END) AS x1, MAX(CASE WHEN session = 'session2' THEN value END) AS x2 FROM retest GROUP BY subject_id, condition, channel, band, metric)"
PAIRS = f"pair AS (SELECT subject_id, condition, channel, band, metric, x1, x2 FROM {PAIR} q WHERE x1 IS NOT NULL AND x2 IS NOT NULL)"
# Two-way ICC from sums of centred values.
ICC = f"""{PAIRS}, c AS (SELECT *, AVG(x1 + x2) OVER (PARTITION BY condition, channel, band, metric) / 2 AS g FROM pair),
s AS (SELECT condition, channel, band, metric, COUNT(*) AS n, SUM((x1 - g) * (x1 - g) + (x2 - g) * (x2 - g)) AS ss, SUM((x1 + x2 - 2 * g) * (x1 + x2 - 2 * g)) / 2 AS ssr, (SUM(x1 - g) * SUM(x1 - g) + SUM(x2 - g) * SUM(x2 - g)) / COUNT(*) AS ssc,
 AVG(x2 - x1) AS bias, STDDEV_SAMP(x2 - x1) AS sd_diff FROM c GROUP BY condition, channel, band, metric HAVING COUNT(*) >= 10),
m AS (SELECT *, ssr / (n - 1) AS msr, ssc AS msc, (ss - ssr - ssc) / (n - 1) AS mse, SQRT(ss / (2 * n - 1)) AS sd_all FROM s),
rel AS (SELECT *, (msr - mse) / nullif(msr + mse + 2 * (msc - mse) / n, 0) AS icc FROM m),
rel2 AS (SELECT *, sd_all * SQRT(GREATEST(CAST(0 AS DOUBLE), 1 - icc)) AS sem FROM rel)"""
BANDPOWER = """seg AS (SELECT recording_id, freq, psd, LAG(freq) OVER (PARTITION BY recording_id ORDER BY freq) AS f0, LAG(psd) OVER (PARTITION BY recording_id ORDER BY freq) AS p0 FROM psd),
total AS (SELECT recording_id, SUM((freq - f0) * (psd + p0) / 2) AS total FROM seg GROUP BY recording_id),
bp AS (SELECT s.recording_id, b.band, SUM(CASE WHEN s.f0 >= b.lo THEN (s.freq - s.f0) * (s.psd + s.p0) / 2 ELSE CAST(0 AS DOUBLE) END) AS power FROM seg s JOIN bands b ON s.freq >= b.lo AND s.freq <= b.hi GROUP BY s.recording_id, b.band)"""
FIT = f"""pts AS (SELECT recording_id, LOG10(freq) AS x, LOG10(GREATEST(psd, {num(1e-30)})) AS y FROM psd WHERE freq >= 2 AND freq <= 40),
f1 AS (SELECT recording_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM pts GROUP BY recording_id),
f2 AS (SELECT p.recording_id, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2, COUNT(*) AS n_points FROM pts p JOIN f1 ON f1.recording_id = p.recording_id WHERE y <= a + b * x + {num(1e-12)} GROUP BY p.recording_id)"""
#: Blocks run to the next event or, the last ones, to the recording's end.
MARK = """ev AS (SELECT event_id, recording_id, onset, kind, LEAD(onset) OVER (PARTITION BY recording_id ORDER BY onset, event_id) AS nxt FROM markers WHERE kind IS NOT NULL),
rec AS (SELECT recording_id, MAX(onset) AS last FROM markers GROUP BY recording_id),
block AS (SELECT e.recording_id, e.event_id, e.kind, e.onset, COALESCE(e.nxt, c.last) AS stop FROM ev e JOIN rec c ON c.recording_id = e.recording_id WHERE e.kind <> 'boundary')"""
#: Channels as recorded: subjects of the second dataset wear two more.
SEEN = "seen AS (SELECT DISTINCT subject_id, channel FROM metrics UNION ALL SELECT subject_id, 'AF3' FROM subjects WHERE dataset = 1 UNION ALL SELECT subject_id, 'FC1' FROM subjects WHERE dataset = 1)"
N = 64
#: All bins of an epoch but the mean's; the last one, at half the rate, is real. Epochs last a second (64 samples at 64 Hz, as in c12_), so bin k is k Hz.
DFT = f"""freqs AS (SELECT * FROM (VALUES {', '.join(f'({k})' for k in range(1, N // 2 + 1))}) AS t(k)),
spec AS (SELECT channel, epoch, k, SUM(v * (0.5 - 0.5 * COS(2 * PI() * t_idx / {N})) * COS(2 * PI() * k * t_idx / {N})) AS re, CASE WHEN k = {N // 2} THEN CAST(0 AS DOUBLE) ELSE -SUM(v * (0.5 - 0.5 * COS(2 * PI() * t_idx / {N})) * SIN(2 * PI() * k * t_idx / {N})) END AS im FROM epochs CROSS JOIN freqs GROUP BY channel, epoch, k),
cross_ AS (SELECT a.channel AS ca, b.channel AS cb, a.k, a.epoch, a.re * b.re + a.im * b.im AS sr, a.im * b.re - a.re * b.im AS si, a.re * a.re + a.im * a.im AS sa, b.re * b.re + b.im * b.im AS sb FROM spec a JOIN spec b ON a.epoch = b.epoch AND a.k = b.k AND a.channel < b.channel),
coh_f AS (SELECT ca, cb, k, SQRT(SUM(sr) * SUM(sr) + SUM(si) * SUM(si)) / nullif(SQRT(SUM(sa) * SUM(sb)), 0) AS coh, ABS(SUM(si)) / nullif(SQRT(SUM(sa) * SUM(sb)), 0) AS imcoh,
 (SUM(si) * SUM(si) - SUM(si * si)) / nullif(SUM(ABS(si)) * SUM(ABS(si)) - SUM(si * si), 0) AS wpli FROM cross_ GROUP BY ca, cb, k),
edge AS (SELECT ca, cb, band, AVG(coh) AS coh, AVG(imcoh) AS imcoh, AVG(ABS(wpli)) AS dwpli FROM coh_f JOIN bands ON k >= lo AND k <= hi GROUP BY ca, cb, band)"""
#: Correlation graphs between channels in each subject: 19 nodes at most.
GRAPH = """node AS (SELECT subject_id, condition, channel, band, value FROM metrics WHERE metric = 'absolute_power'),
graph AS (SELECT a.subject_id, a.condition, a.band, a.channel AS ca, b.channel AS cb, 1 / (1 + ABS(LN(a.value) - LN(b.value))) AS weight FROM node a JOIN node b ON a.subject_id = b.subject_id AND a.condition = b.condition AND a.band = b.band AND a.channel < b.channel WHERE a.value > 0 AND b.value > 0),
lim AS (SELECT subject_id, condition, band, $PCT(weight, 0.75) AS cut FROM (SELECT subject_id, condition, band, weight FROM graph UNION ALL SELECT subject_id, condition, band, weight FROM graph) g GROUP BY subject_id, condition, band),
kept AS (SELECT g.* FROM graph g JOIN lim l ON g.subject_id = l.subject_id AND g.condition = l.condition AND g.band = l.band WHERE g.weight >= l.cut),
sym AS (SELECT subject_id, condition, band, ca AS u, cb AS v, weight FROM kept UNION ALL SELECT subject_id, condition, band, cb AS u, ca AS v, weight FROM kept)"""

RATIO = "SUM(CASE WHEN side = 'num' THEN power END) / nullif(SUM(CASE WHEN side = 'den' THEN power END), 0)"

QUERIES: dict[str, str] = {
    # --- sources, cleaning, projections -------------------------------------------------------------------------
    "s2_merge_sources": "SELECT CASE WHEN dataset = 0 THEN 'lemon' ELSE 'dortmund' END AS source, CONCAT(CASE WHEN dataset = 0 THEN 'lemon' ELSE 'dortmund' END, '_', CAST(subject_id AS VARCHAR(20))) AS subject, age, sex FROM subjects",
    "s7_wide_subjects": "SELECT subject_id, MAX(age) AS age, MAX(sex) AS sex, condition, " + ", ".join(f"{r(f'''MAX(CASE WHEN channel = '{c}' AND band = '{b}' AND metric = '{m}' THEN value END)''')} AS {c.lower()}_{b.lower()}_{m}" for c in sorted(CHANNELS) for b in ("Alpha", "Beta", "Theta") for m in ("absolute_power", "corrected_absolute_power", "relative_power")) + " FROM metrics GROUP BY subject_id, condition",
    "p2_age_parse": "SELECT subject_id, COALESCE(TRY_CAST(raw AS DOUBLE), (TRY_CAST(SPLIT_PART(raw, '-', 1) AS DOUBLE) + TRY_CAST(SPLIT_PART(raw, '-', 2) AS DOUBLE)) / 2) AS age FROM (SELECT subject_id, CASE subject_id % 4 WHEN 0 THEN CAST(CAST(FLOOR(age) AS BIGINT) AS VARCHAR(20)) WHEN 1 THEN CONCAT(CAST(CAST(FLOOR(age) AS BIGINT) AS VARCHAR(20)), '-', CAST(CAST(FLOOR(age) AS BIGINT) + 5 AS VARCHAR(20))) WHEN 2 THEN 'n/a' ELSE NULL END AS raw FROM subjects) q",
    "p3_sex_normalise": "SELECT c_custkey, raw, CASE WHEN UPPER(TRIM(raw)) LIKE 'M%' THEN 'M' WHEN UPPER(TRIM(raw)) LIKE 'F%' THEN 'F' WHEN TRIM(raw) = '1' THEN 'F' WHEN TRIM(raw) = '2' THEN 'M' ELSE TRIM(raw) END AS sex FROM (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN ' male' WHEN 1 THEN 'Female ' WHEN 2 THEN '1' WHEN 3 THEN '2' WHEN 4 THEN 'x' ELSE c_mktsegment END AS raw FROM customer) q",
    "p4_entities": "SELECT o_orderkey, REGEXP_EXTRACT(name, 'sub-([A-Za-z0-9]+)', 1) AS subject, REGEXP_EXTRACT(name, 'ses-([A-Za-z0-9]+)', 1) AS session, REGEXP_EXTRACT(name, 'task-([A-Za-z0-9]+)', 1) AS task, CASE WHEN LOWER(name) LIKE '%open%' THEN 'eo' WHEN LOWER(name) LIKE '%closed%' THEN 'ec' ELSE 'rest' END AS condition FROM (SELECT o_orderkey, CONCAT('sub-', CAST(o_custkey AS VARCHAR(20)), '_ses-', CAST(o_orderkey % 3 AS VARCHAR(20)), '_task-', CASE o_orderstatus WHEN 'O' THEN 'EyesOpen' WHEN 'F' THEN 'EyesClosed' ELSE 'rest' END, '_eeg.set') AS name FROM orders) q",
    "p8_age_bins": "SELECT s.subject_id, s.age, b.bin FROM subjects s LEFT JOIN bins b ON s.age >= b.bin_lo AND s.age < b.bin_hi",
    "p10_scoring_space": f"SELECT subject_id, condition, channel, band, metric, {LOG} AS is_log, {r(f'CASE WHEN NOT {LOG} THEN value WHEN value > 0 THEN LN(value) END')} AS x FROM metrics",
    "p11_channel_names": "SELECT n_name, raw, CASE UPPER(stem) WHEN 'T7' THEN 'T3' WHEN 'T8' THEN 'T4' WHEN 'P7' THEN 'T5' WHEN 'P8' THEN 'T6' ELSE CONCAT(UPPER(SUBSTR(stem, 1, 1)), LOWER(SUBSTR(stem, 2))) END AS channel FROM (SELECT n_name, raw, SPLIT_PART(REPLACE(REPLACE(raw, 'EEG ', ''), '.', ''), '-', 1) AS stem FROM (SELECT n_name, CASE n_nationkey % 5 WHEN 0 THEN 'EEG FZ-REF' WHEN 1 THEN 'T7..' WHEN 2 THEN 'P8-LE' WHEN 3 THEN 'EEG o1' ELSE 'Cz.' END AS raw FROM nation) q) w",
    "p13_normal": f"SELECT l_orderkey, l_linenumber, {r(norm_cdf('z'))} AS cdf, {r(two_tailed('z'))} AS p, {r(norm_ppf('u'))} AS ppf FROM (SELECT l_orderkey, l_linenumber, (l_quantity - 25) / 7 AS z, (l_discount * 100 + 1) / 13 AS u FROM lineitem) q",
    "p17_row_filters": "SELECT m.subject_id, m.channel, m.band, m.value FROM metrics m WHERE m.condition = 'eo' AND m.metric = 'relative_power' AND m.channel NOT IN ('Fp1', 'Fp2') AND EXISTS (SELECT 1 FROM subjects s WHERE s.subject_id = m.subject_id AND s.sex IN ('F', 'M') AND s.age >= 20)".replace("m.value", "(round(m.value, 6) + 0.0) AS value", 1),
    "p18_slice": "SELECT subject_id, k FROM (SELECT subject_id, ROW_NUMBER() OVER (ORDER BY subject_id) AS k FROM (SELECT DISTINCT subject_id FROM metrics WHERE condition = 'eo' ORDER BY subject_id LIMIT 60) e) q WHERE k > 10 AND k <= 60",
    # --- joins and sets --------------------------------------------------------------------------------------------
    "j4_demographics_priority": "SELECT o.o_orderkey, COALESCE(a.age, b.age) AS age, CASE WHEN a.subject_id IS NOT NULL THEN 'first' WHEN b.subject_id IS NOT NULL THEN 'second' ELSE 'none' END AS found FROM orders o LEFT JOIN subjects a ON a.subject_id = o.o_orderkey LEFT JOIN subjects b ON b.subject_id = o.o_custkey",
    "j5_session_pairs": f"WITH {PAIRS} SELECT subject_id, condition, channel, band, metric, {r('x1')} AS x1, {r('x2')} AS x2 FROM pair",
    "j7_condition_pairs": f"WITH {MEANS} SELECT bin, channel, band, metric, {r('''MAX(CASE WHEN condition = 'ec' THEN mean END)''')} AS ec, {r('''MAX(CASE WHEN condition = 'eo' THEN mean END)''')} AS eo FROM cell WHERE sex = 'pooled' GROUP BY bin, channel, band, metric",
    "j8_metric_pairs": f"SELECT subject_id, condition, channel, band, {r('''MAX(CASE WHEN metric = 'absolute_power' THEN value END)''')} AS absolute, {r('''MAX(CASE WHEN metric = 'corrected_absolute_power' THEN value END)''')} AS corrected FROM metrics GROUP BY subject_id, condition, channel, band",
    "j9_eligibility": "SELECT s.subject_id, s.age, s.sex, COALESCE(q.n, 0) AS n_rows, COALESCE(q.n, 0) >= 20 AND s.age >= 20 AND s.age < 80 AND s.sex IN ('F', 'M') AS eligible FROM subjects s LEFT JOIN (SELECT subject_id, COUNT(*) AS n FROM metrics GROUP BY subject_id) q ON q.subject_id = s.subject_id",
    "j10_not_done": "SELECT s.subject_id FROM subjects s WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = s.subject_id AND o.o_orderstatus = 'P')",
    "j13_nearest_within": "SELECT p_partkey, s_suppkey, d FROM (SELECT p_partkey, s_suppkey, d, ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY d, s_suppkey) AS k FROM (SELECT p.p_partkey, s.s_suppkey, ABS(p.p_partkey - 20 * s.s_suppkey) AS d FROM part p JOIN supplier s ON CAST(FLOOR(s.s_suppkey * 20 / 15) AS BIGINT) BETWEEN CAST(FLOOR(p.p_partkey / 15) AS BIGINT) - 1 AND CAST(FLOOR(p.p_partkey / 15) AS BIGINT) + 1) q WHERE d <= 15) w WHERE k = 1",
    "j14_adjacent_pairs": "SELECT m.subject_id, m.condition, m.band, m.channel, a.neighbour FROM metrics m JOIN adjacency a ON a.channel = m.channel JOIN metrics n ON n.subject_id = m.subject_id AND n.condition = m.condition AND n.band = m.band AND n.metric = m.metric AND n.channel = a.neighbour WHERE m.metric = 'relative_power' AND m.value > 0.07 AND n.value > 0.07",
    "j15_weighted_remap": f"SELECT subject_id, condition, band, region, {r('SUM(value * w) / nullif(SUM(w), 0)')} AS value FROM (SELECT m.subject_id, m.condition, m.band, g.region, m.value, CASE WHEN m.channel IN ('Pz', 'Fz') THEN 2.0 ELSE 1.0 END AS w FROM metrics m JOIN regions g ON g.channel = m.channel WHERE m.metric = 'absolute_power') q GROUP BY subject_id, condition, band, region",
    "j17_interval_join": f"WITH {MARK} SELECT b.recording_id, b.kind, b.event_id AS block, m.event_id, ROW_NUMBER() OVER (PARTITION BY b.recording_id, b.kind ORDER BY b.onset, b.event_id, m.onset, m.event_id) AS k FROM block b JOIN markers m ON m.recording_id = b.recording_id AND m.onset >= b.onset AND m.onset < b.stop WHERE b.stop - b.onset >= 5",
    "u2_priority_union": "SELECT subject_id, age, source FROM (SELECT subject_id, age, source, ROW_NUMBER() OVER (PARTITION BY subject_id ORDER BY pr DESC) AS k FROM (SELECT subject_id, age, 'base' AS source, 1 AS pr FROM subjects UNION ALL SELECT o_custkey, CAST(o_orderkey % 50 AS DOUBLE), 'update', 2 FROM orders WHERE o_orderkey IN (SELECT MAX(o_orderkey) FROM orders GROUP BY o_custkey)) q) w WHERE k = 1",
    "u3_common_keys": "SELECT channel, band, metric, bin FROM metrics JOIN bins ON age >= bin_lo AND age < bin_hi WHERE dataset = 0 INTERSECT SELECT channel, band, metric, bin FROM metrics JOIN bins ON age >= bin_lo AND age < bin_hi WHERE dataset = 1",
    "u4_missing_channels": f"WITH {SEEN}, want AS (SELECT s.subject_id, c.channel FROM (SELECT DISTINCT subject_id FROM seen) s CROSS JOIN (SELECT DISTINCT channel FROM adjacency) c) SELECT subject_id, channel, 'missing' AS kind FROM (SELECT * FROM want EXCEPT SELECT subject_id, channel FROM seen) a UNION ALL SELECT subject_id, channel, 'unexpected' FROM (SELECT subject_id, channel FROM seen EXCEPT SELECT * FROM want) b",
    # --- aggregations -----------------------------------------------------------------------------------------------
    "a7_cohort_counts": "SELECT b.bin, m.condition, COUNT(DISTINCT CASE WHEN sex = 'F' THEN subject_id END) AS n_f, COUNT(DISTINCT CASE WHEN sex = 'M' THEN subject_id END) AS n_m, COUNT(DISTINCT CASE WHEN sex NOT IN ('F', 'M') THEN subject_id END) AS n_other FROM metrics m JOIN bins b ON age >= bin_lo AND age < bin_hi GROUP BY b.bin, m.condition",
    "a9_unit_sanity": f"SELECT recording_id, {r('$PCT(psd, 0.5)')} AS median_psd, $PCT(psd, 0.5) < {num(1e-16)} OR $PCT(psd, 0.5) > {num(1e-2)} AS suspect FROM psd WHERE freq >= 8 AND freq <= 13 GROUP BY recording_id",
    "a10_duplicates": "SELECT o_custkey, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus HAVING COUNT(*) > 1",
    "a11_merge_summary": "SELECT dataset, COUNT(*) AS n, MIN(age) AS age_min, MAX(age) AS age_max, COUNT_IF(sex = 'F') AS n_f, COUNT_IF(sex = 'M') AS n_m FROM subjects GROUP BY ROLLUP (dataset)",
    "a12_coverage": f"WITH {MEANS} SELECT bin, SUM(CASE WHEN condition = 'eo' THEN n ELSE 0 END) AS n_eo, SUM(CASE WHEN condition = 'ec' THEN n ELSE 0 END) AS n_ec, MIN(n) < 20 AS low FROM cell WHERE sex = 'pooled' AND channel = 'Cz' AND band = 'Alpha' AND metric = 'absolute_power' GROUP BY bin",
    "a13_low_cells": f"WITH {MEANS} SELECT bin, condition, band, metric, COUNT(*) AS n_cells, COUNT_IF(n < 20) AS n_low, $JOIN(DISTINCT channel) AS channels FROM cell WHERE sex = 'pooled' GROUP BY bin, condition, band, metric",
    "a14_cell_quality": f"WITH {MEANS} SELECT bin, COUNT(*) AS n_cells, MIN(n) AS n_min, $PCT(n, 0.5) AS n_median, MAX(n) AS n_max, COUNT_IF(n < 10) AS n_thin FROM cell WHERE sex = 'pooled' GROUP BY ROLLUP (bin)",
    "a18_age_distribution": f"SELECT CAST(FLOOR(age / 5) * 5 AS BIGINT) AS bin5, COUNT(*) AS n, COUNT_IF(sex = 'F') AS n_f, COUNT_IF(sex = 'M') AS n_m, {r('AVG(age)')} AS mean, {r('STDDEV_SAMP(age)')} AS sd, $PCT(age, 0.5) AS median, COUNT(*) < 10 AS thin FROM subjects GROUP BY CAST(FLOOR(age / 5) * 5 AS BIGINT)",
    "a19_score_histogram": "SELECT CASE WHEN s <= 13 THEN 'minimal' WHEN s <= 19 THEN 'mild' WHEN s <= 28 THEN 'moderate' ELSE 'severe' END AS level, COUNT(*) AS n, COUNT_IF(s <= 13) AS healthy FROM (SELECT c_custkey % 64 AS s FROM customer) q GROUP BY CASE WHEN s <= 13 THEN 'minimal' WHEN s <= 19 THEN 'mild' WHEN s <= 28 THEN 'moderate' ELSE 'severe' END",
    "a20_thresholds": "SELECT t.cut, COUNT_IF(s.score < t.cut OR s.score IS NULL) AS n_eligible, COUNT(*) AS n FROM (SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 100 END AS score FROM customer) s CROSS JOIN (VALUES (60), (63), (70)) AS t(cut) GROUP BY t.cut",
    "a21_issue_histogram": "SELECT SPLIT_PART(SPLIT_PART(issue, ':', 1), '=', 1) AS issue, COUNT(*) AS n FROM (SELECT CASE WHEN event_type = 'click' THEN CONCAT('flat channel: ', CAST(user_id AS VARCHAR(20))) WHEN value > 50 THEN CONCAT('amplitude=', CAST(event_id AS VARCHAR(20))) ELSE 'short recording' END AS issue FROM events) q GROUP BY SPLIT_PART(SPLIT_PART(issue, ':', 1), '=', 1)",
    "a22_task_inventory": "SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT user_id) AS n_subjects FROM events GROUP BY event_type",
    "a23_session_inventory": "SELECT n_sessions, COUNT(*) AS n_subjects FROM (SELECT subject_id, COUNT(DISTINCT session) AS n_sessions FROM retest GROUP BY subject_id) q GROUP BY n_sessions",
    "a24_verdict": "SELECT user_id, CASE MAX(CASE WHEN event_type = 'error' OR value < 0 THEN 2 WHEN value > 90 THEN 1 ELSE 0 END) WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS verdict, COUNT_IF(value > 90) AS n_warn FROM events GROUP BY user_id",
    "a27_pre_post": f"WITH {PAIRS} SELECT condition, band, COUNT(*) AS n, {r('AVG(LOG10(x2) - LOG10(x1))')} AS mean, {r('STDDEV_SAMP(LOG10(x2) - LOG10(x1))')} AS sd, {r('AVG(LOG10(x2) - LOG10(x1)) / nullif(STDDEV_SAMP(LOG10(x2) - LOG10(x1)), 0)')} AS d FROM pair WHERE metric = 'absolute_power' AND x1 > 0 AND x2 > 0 GROUP BY condition, band",
    "a28_payload_rules": f"""WITH v AS (SELECT freq, LOG10(GREATEST(psd, {num(1e-30)}) * 1e12) AS x FROM psd), c AS (SELECT freq, COUNT(*) AS n, AVG(x) AS mean, """ + ", ".join(f"$PCT(x, {p / 100}) AS q{i}" for i, p in enumerate(POINTS)) + f""" FROM v GROUP BY freq)
 SELECT 'median_near_mean' AS rule_name, {r(f'$PCT(ABS(q{POINTS.index(50)} - mean), 0.5)')} AS value, $PCT(ABS(q{POINTS.index(50)} - mean), 0.5) <= 0.25 AS ok FROM c
 UNION ALL SELECT 'percentiles_rise', {r('MIN(LEAST(' + ', '.join(f'q{i + 1} - q{i}' for i in range(len(POINTS) - 1)) + '))')}, MIN(LEAST({', '.join(f'q{i + 1} - q{i}' for i in range(len(POINTS) - 1))})) >= {num(-1e-4)} FROM c
 UNION ALL SELECT 'largest', {r(f'MAX(q{len(POINTS) - 1})')}, MAX(q{len(POINTS) - 1}) <= 6 FROM c UNION ALL SELECT 'has_rows', CAST(COUNT(*) AS DOUBLE), COUNT(*) > 0 FROM c""",
    # --- windows --------------------------------------------------------------------------------------------------------
    "w2_segments": f"WITH {MARK} SELECT recording_id, kind, {r('onset')} AS start, {r('stop')} AS stop, {r('stop - onset')} AS duration FROM block WHERE stop - onset >= 5",
    "w3_marker_blocks": f"""WITH g AS (SELECT event_id, recording_id, kind, onset, onset - LAG(onset) OVER (PARTITION BY recording_id, kind ORDER BY onset, event_id) AS gap FROM markers WHERE kind IN ('eo', 'ec')),
 med AS (SELECT recording_id, kind, $PCT(gap, 0.5) AS step FROM g WHERE gap IS NOT NULL GROUP BY recording_id, kind),
 b AS (SELECT g.recording_id, g.kind, g.onset, m.step, SUM(CASE WHEN gap IS NULL OR gap > 2.5 * m.step THEN 1 ELSE 0 END) OVER (PARTITION BY g.recording_id, g.kind ORDER BY g.onset, g.event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block FROM g JOIN med m ON m.recording_id = g.recording_id AND m.kind = g.kind)
 SELECT recording_id, kind, block, COUNT(*) AS n, {r('MIN(onset)')} AS start, {r('MAX(onset) + MAX(step)')} AS stop FROM b GROUP BY recording_id, kind, block""",
    "w4_bad_intervals": """WITH w AS (SELECT recording_id, channel, win, MAX(ABS(v)) > 60 AS bad FROM signal GROUP BY recording_id, channel, win), i AS (SELECT recording_id, channel, win, win - ROW_NUMBER() OVER (PARTITION BY recording_id, channel ORDER BY win) AS island FROM w WHERE bad)
 SELECT recording_id, channel, MIN(win) AS first_win, MAX(win) AS last_win, COUNT(*) AS n FROM i GROUP BY recording_id, channel, island""",
    "w5_trapezoid": f"WITH {BANDPOWER} SELECT recording_id, {r('total')} AS total FROM total",
    "w6_block_coverage": f"WITH {MARK} SELECT recording_id, kind, COUNT(*) AS n_blocks, {r('SUM(stop - onset)')} AS seconds FROM block GROUP BY recording_id, kind",
    "w8_pre_post_order": "SELECT o_orderkey, o_custkey, CASE WHEN COUNT(*) OVER (PARTITION BY o_custkey, o_orderstatus) = 1 THEN 'single' WHEN ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) = 1 THEN 'pre' ELSE 'post' END AS timing FROM orders",
    "w9_format_priority": "SELECT stem, fmt, o_orderkey FROM (SELECT o_orderkey, o_custkey AS stem, CASE o_orderstatus WHEN 'F' THEN 'set' WHEN 'O' THEN 'edf' ELSE 'raw' END AS fmt, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey) AS k FROM orders) q WHERE k = 1",
    "w10_middle_epochs": "SELECT channel, epoch FROM (SELECT channel, epoch, ROW_NUMBER() OVER (PARTITION BY channel ORDER BY epoch) - 1 AS k, COUNT(*) OVER (PARTITION BY channel) AS n FROM (SELECT DISTINCT channel, epoch FROM epochs) e) q WHERE n >= 30 AND k >= CAST(FLOOR((n - LEAST(n, 120)) / 2) AS BIGINT) AND k < CAST(FLOOR((n - LEAST(n, 120)) / 2) AS BIGINT) + LEAST(n, 120)",
    # --- top k -----------------------------------------------------------------------------------------------------------
    "t4_disagreements": f"WITH grp AS (SELECT dataset, bin, condition, channel, band, metric, AVG(value) AS mean, STDDEV_SAMP(value) AS sd FROM metrics JOIN bins ON age >= bin_lo AND age < bin_hi GROUP BY dataset, bin, condition, channel, band, metric HAVING COUNT(*) >= 3) SELECT a.bin, a.condition, a.channel, a.band, a.metric, {r('(a.mean - b.mean) / SQRT((a.sd * a.sd + b.sd * b.sd) / 2)')} AS d FROM grp a JOIN grp b ON a.dataset = 0 AND b.dataset = 1 AND a.bin = b.bin AND a.condition = b.condition AND a.channel = b.channel AND a.band = b.band AND a.metric = b.metric WHERE a.sd > 0 AND b.sd > 0 ORDER BY ABS((a.mean - b.mean) / SQRT((a.sd * a.sd + b.sd * b.sd) / 2)) DESC, 1, 2, 3, 4, 5 LIMIT 20",
    "t6_top_areas": f"SELECT region, channel, mean FROM (SELECT g.region, m.channel, {r('AVG(m.value)')} AS mean, ROW_NUMBER() OVER (PARTITION BY g.region ORDER BY AVG(m.value) DESC, m.channel) AS k FROM metrics m JOIN regions g ON g.channel = m.channel WHERE m.metric = 'absolute_power' GROUP BY g.region, m.channel) q WHERE k <= 3",
    # --- reliability and validation -----------------------------------------------------------------------------------------
    "r1_icc": f"WITH {ICC} SELECT condition, channel, band, metric, n, {r('icc')} AS icc, {r('sem')} AS sem, {r('sem * 1.96 * SQRT(2)')} AS mdc95 FROM rel2",
    "r3_bland_altman": f"WITH {ICC} SELECT condition, channel, band, metric, {r('bias')} AS bias, {r('sd_diff')} AS sd_diff, {r('bias - 1.96 * sd_diff')} AS lower_limit, {r('bias + 1.96 * sd_diff')} AS upper_limit FROM rel2",
    "r5_beyond_mdc": f"WITH {ICC} SELECT r.condition, r.channel, r.band, r.metric, {r('AVG(CASE WHEN ABS(p.x1 - p.x2) > r.sem * 1.96 * SQRT(2) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)')} AS share FROM rel2 r JOIN pair p ON p.condition = r.condition AND p.channel = r.channel AND p.band = r.band AND p.metric = r.metric GROUP BY r.condition, r.channel, r.band, r.metric",
    "v1_alpha_closed_over_open": f"WITH {MEANS}, p AS (SELECT bin, channel, MAX(CASE WHEN condition = 'ec' THEN mean END) AS ec, MAX(CASE WHEN condition = 'eo' THEN mean END) AS eo FROM cell WHERE sex = 'pooled' AND band = 'Alpha' AND metric = 'absolute_power' GROUP BY bin, channel) SELECT COUNT(*) AS n, COUNT_IF(ec > eo) AS n_pass, {r('AVG(CASE WHEN ec > eo THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)')} AS share, AVG(CASE WHEN ec > eo THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) >= 0.9 AS ok FROM p WHERE ec IS NOT NULL AND eo IS NOT NULL",
    "v2_age_trend": f"WITH {MEANS} SELECT condition, channel, metric, COUNT(*) AS n_bins, {r(corr('(bin_lo + bin_hi) / 2.0', 'mean'))} AS r FROM cell WHERE sex = 'pooled' AND band = 'Alpha' AND n >= 5 GROUP BY condition, channel, metric HAVING COUNT(*) >= 3",
    "v7_scale_consistency": f"WITH {MEANS} SELECT condition, band, {r('STDDEV_POP(mean) / nullif(ABS(AVG(mean)), 0)')} AS cv, STDDEV_POP(mean) / nullif(ABS(AVG(mean)), 0) < 0.1 AS ok FROM cell WHERE sex = 'pooled' AND metric = 'absolute_power' GROUP BY condition, band",
    # --- recording quality ---------------------------------------------------------------------------------------------------
    "q1_integrity": f"WITH m AS (SELECT recording_id, channel, v, AVG(v) OVER (PARTITION BY recording_id) AS c FROM signal) SELECT recording_id, COUNT(DISTINCT channel) AS n_channels, COUNT(*) AS n, {r('$PCT(ABS(v - c), 0.5)')} AS typical, COUNT(DISTINCT channel) >= 3 AS ok FROM m GROUP BY recording_id",
    "q2_flat_railed": f"SELECT recording_id, channel, {r('VAR_POP(v)')} AS variance, VAR_POP(v) < 0.1 AS flat, AVG(CASE WHEN ABS(v) > 80 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) > 0.1 AS railed FROM signal GROUP BY recording_id, channel",
    "q4_gross_artefacts": f"WITH c AS (SELECT recording_id, win, channel, MAX(ABS(v)) > 60 AS bad FROM signal GROUP BY recording_id, win, channel), w AS (SELECT recording_id, win, AVG(CASE WHEN bad THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) > 0.5 AS bad FROM c GROUP BY recording_id, win) SELECT recording_id, COUNT(*) AS n_windows, COUNT_IF(bad) AS n_bad, {r('AVG(CASE WHEN bad THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)')} AS percent, COUNT_IF(NOT bad) * 3600 AS usable_seconds FROM w GROUP BY recording_id",
    "q5_amplitude": f"SELECT recording_id, channel, {r('AVG(v)')} AS dc, {r('STDDEV_POP(v)')} AS sd, {r('MAX(ABS(v))')} AS peak, {r('$PCT(ABS(v), 0.5)')} AS median FROM signal GROUP BY recording_id, channel",
    "q7_marker_limits": "SELECT recording_id, kind, COUNT(*) AS n, CASE WHEN COUNT(*) < 3 THEN 'fail' WHEN COUNT(*) < 6 THEN 'warn' ELSE 'pass' END AS verdict FROM markers WHERE kind IN ('eo', 'ec') GROUP BY recording_id, kind",
    "q8_alpha_peak": "SELECT recording, MAX_BY(freq, m) AS peak FROM (SELECT CAST(FLOOR(recording_id / 5) AS BIGINT) AS recording, freq, AVG(psd) AS m FROM psd WHERE freq BETWEEN 8 AND 13 GROUP BY CAST(FLOOR(recording_id / 5) AS BIGINT), freq) q GROUP BY recording",
    "q9_bad_channels": f"WITH v AS (SELECT recording_id, channel, VAR_POP(v) AS var FROM signal GROUP BY recording_id, channel), m AS (SELECT recording_id, $PCT(var, 0.5) AS med FROM v GROUP BY recording_id) SELECT v.recording_id, v.channel, {r('var')} AS var, var < 0.01 * med OR var > 10 * med AS bad FROM v JOIN m ON m.recording_id = v.recording_id",
    "q10_line_share": f"SELECT recording_id, {r('SUM(CASE WHEN freq BETWEEN 48 AND 50.5 THEN psd ELSE 0 END) / nullif(SUM(psd), 0)')} AS share, SUM(CASE WHEN freq BETWEEN 48 AND 50.5 THEN psd ELSE 0 END) / nullif(SUM(psd), 0) > 0.4 AS noisy FROM psd WHERE freq BETWEEN 40 AND 50.5 GROUP BY recording_id",
    "q11_bad_windows": f"""WITH w AS (SELECT recording_id, channel, win, STDDEV_POP(v) AS s FROM signal GROUP BY recording_id, channel, win), m AS (SELECT recording_id, channel, $PCT(s, 0.5) AS med, COUNT(*) AS n FROM w GROUP BY recording_id, channel HAVING COUNT(*) >= 4),
 b AS (SELECT w.recording_id, w.channel, w.win, m.n, s > 1.5 * med AS bad FROM w JOIN m ON m.recording_id = w.recording_id AND m.channel = w.channel), i AS (SELECT *, CASE WHEN bad THEN win - ROW_NUMBER() OVER (PARTITION BY recording_id, channel, bad ORDER BY win) END AS island FROM b)
 SELECT recording_id, channel, MAX(n) AS n, COUNT_IF(bad) AS n_bad, COUNT(DISTINCT island) AS n_intervals, COUNT_IF(bad) * 3600 AS bad_seconds FROM i GROUP BY recording_id, channel""",
    # --- spectra -----------------------------------------------------------------------------------------------------------------
    "k1_average_reference": f"SELECT channel, epoch, t_idx, {r('v - AVG(v) OVER (PARTITION BY epoch, t_idx)')} AS v FROM epochs",
    "k3_band_power": f"WITH {BANDPOWER} SELECT b.recording_id, b.band, {r('power')} AS absolute, {r('power / nullif(total, 0)')} AS relative FROM bp b JOIN total t ON t.recording_id = b.recording_id",
    "k4_band_ratios": f"WITH {BANDPOWER} SELECT b.recording_id, q.ratio, {r(RATIO)} AS value FROM bp b JOIN ratios q ON q.band = b.band JOIN (SELECT ratio, COUNT(*) AS need FROM ratios GROUP BY ratio) n ON n.ratio = q.ratio GROUP BY b.recording_id, q.ratio HAVING COUNT(*) = MAX(n.need)",
    "k5_aperiodic": f"WITH {FIT} SELECT recording_id, {r('-slope')} AS exponent, {r('intercept')} AS level, {r('r2')} AS r2, r2 >= 0.85 AS good, n_points FROM f2 WHERE n_points >= 5",
    "k12_mean_log_power": f"WITH {BANDPOWER} SELECT band, {r('AVG(LOG10(power))')} AS mean FROM bp WHERE power > 0 GROUP BY band",
    # --- coupling and graphs ---------------------------------------------------------------------------------------------------------
    "c14_hub_matrix": f"SELECT m.subject_id, m.condition, m.band, h.hub, {r('AVG(m.value)')} AS value, COUNT(*) AS n_channels FROM hubs h JOIN metrics m ON m.channel = h.channel WHERE m.metric = 'absolute_power' GROUP BY m.subject_id, m.condition, m.band, h.hub",
    "c6_threshold": f"WITH {GRAPH} SELECT subject_id, condition, band, COUNT(*) AS n_edges, {r('MIN(weight)')} AS least FROM kept GROUP BY subject_id, condition, band",
    "c7_thresholded_strength": f"WITH {GRAPH} SELECT subject_id, condition, band, u AS channel, {r('SUM(weight)')} AS strength, COUNT(*) AS degree FROM sym GROUP BY subject_id, condition, band, u",
    # --- region projection ---------------------------------------------------------------------------------------------------------------
    "g1_projection": f"SELECT subject_id, condition, band, voxel, {r('SQRT(SUM(part * part))')} AS power FROM (SELECT m.subject_id, m.condition, m.band, t.voxel, t.orient, SUM(t.w * m.value) AS part FROM metrics m JOIN (SELECT a.channel, v.voxel, o.orient, (LENGTH(a.channel) + v.voxel * o.orient) / 10.0 AS w FROM (SELECT DISTINCT channel FROM adjacency) a CROSS JOIN (VALUES (1), (2), (3)) AS v(voxel) CROSS JOIN (VALUES (0), (1), (2)) AS o(orient)) t ON t.channel = m.channel WHERE m.metric = 'absolute_power' GROUP BY m.subject_id, m.condition, m.band, t.voxel, t.orient) q GROUP BY subject_id, condition, band, voxel",
    "g2_region_mean_peak": f"SELECT m.subject_id, m.condition, m.band, g.region, {r('AVG(m.value)')} AS mean, MAX_BY(m.channel, m.value) AS peak_channel FROM metrics m JOIN regions g ON g.channel = m.channel WHERE m.metric = 'absolute_power' GROUP BY m.subject_id, m.condition, m.band, g.region",
    "a25_network_means": f"WITH {GRAPH} SELECT g.subject_id, g.condition, g.band, CASE WHEN a.region = b.region THEN 'within' ELSE 'between' END AS kind, {r('AVG(weight)')} AS mean, COUNT(*) AS n FROM graph g JOIN regions a ON a.channel = g.ca JOIN regions b ON b.channel = g.cb GROUP BY g.subject_id, g.condition, g.band, CASE WHEN a.region = b.region THEN 'within' ELSE 'between' END",
    # --- long metrics from spectra, graphs and regions -----------------------------------------------------------------------------------
    "j16_pair_remap": f"""WITH {GRAPH}, area AS (SELECT hub, channel, CASE WHEN hub LIKE '%_L' THEN 'L' WHEN hub LIKE '%_R' THEN 'R' ELSE 'M' END AS side FROM hubs)
 SELECT g.subject_id, g.condition, g.band, LEAST(a.hub, b.hub) AS area_a, GREATEST(a.hub, b.hub) AS area_b, {r('AVG(g.weight)')} AS weight, COUNT(*) AS n FROM graph g JOIN area a ON a.channel = g.ca JOIN area b ON b.channel = g.cb AND b.side = a.side AND b.hub <> a.hub GROUP BY g.subject_id, g.condition, g.band, LEAST(a.hub, b.hub), GREATEST(a.hub, b.hub)""",
    "g4_long_regions": f"""WITH {GRAPH} SELECT m.subject_id, m.condition, m.band, CONCAT('_src_dk_', g.region) AS channel, 'power' AS metric, {r('AVG(m.value)')} AS value FROM metrics m JOIN regions g ON g.channel = m.channel WHERE m.metric = 'absolute_power' GROUP BY m.subject_id, m.condition, m.band, g.region
 UNION ALL SELECT g.subject_id, g.condition, g.band, CONCAT('_src_conn_', LEAST(a.region, b.region), '_', GREATEST(a.region, b.region)), 'coupling', {r('AVG(g.weight)')} FROM graph g JOIN regions a ON a.channel = g.ca JOIN regions b ON b.channel = g.cb WHERE a.region <> b.region GROUP BY g.subject_id, g.condition, g.band, LEAST(a.region, b.region), GREATEST(a.region, b.region)
 UNION ALL SELECT g.subject_id, g.condition, g.band, CONCAT('_src_net_', a.region), 'within', {r('AVG(g.weight)')} FROM graph g JOIN regions a ON a.channel = g.ca JOIN regions b ON b.channel = g.cb AND b.region = a.region GROUP BY g.subject_id, g.condition, g.band, a.region""",
    "j11_spectra_subjects": f"SELECT p.recording_id, s.subject_id, s.age, s.sex, COUNT(*) AS n_freqs, {r('AVG(LOG10(GREATEST(p.psd, 1e-30)))')} AS level FROM psd p JOIN subjects s ON s.subject_id = CAST(FLOOR(p.recording_id / 5) AS BIGINT) GROUP BY p.recording_id, s.subject_id, s.age, s.sex",
    # --- names, bins, lists ----------------------------------------------------------------------------------------------------------------
    "p6_sessions": "SELECT o_orderkey, name, COALESCE(NULLIF(REGEXP_EXTRACT(name, 'ses-([A-Za-z0-9]+)', 1), ''), 'session1') AS session, CASE WHEN LOWER(name) LIKE '%pre%' THEN 'pre' WHEN LOWER(name) LIKE '%post%' THEN 'post' ELSE 'none' END AS timing FROM (SELECT o_orderkey, CONCAT('sub-', CAST(o_custkey AS VARCHAR(20)), CASE o_orderkey % 3 WHEN 0 THEN '_ses-t1' WHEN 1 THEN '_ses-t2' ELSE '' END, CASE o_orderstatus WHEN 'O' THEN '_acq-pre' WHEN 'F' THEN '_acq-Post' ELSE '' END, '_eeg.vhdr') AS name FROM orders) q",
    "p7_trial_types": "SELECT event_id, label, CASE WHEN LOWER(label) LIKE '%open%' THEN 'eo' WHEN LOWER(label) LIKE '%clos%' THEN 'ec' END AS condition FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 'instructed_toOpenEyes' WHEN 'click' THEN 'instructed_toCloseEyes' ELSE event_type END AS label FROM events) q",
    "p9_inclusive_bins": "SELECT subject_id, age, CONCAT(CAST(CAST(FLOOR(age / 5) * 5 AS BIGINT) AS VARCHAR(20)), '-', CAST(CAST(FLOOR(age / 5) * 5 + 4 AS BIGINT) AS VARCHAR(20))) AS five, CASE WHEN age BETWEEN 20 AND 29 THEN '20-29' WHEN age BETWEEN 30 AND 39 THEN '30-39' WHEN age BETWEEN 40 AND 49 THEN '40-49' WHEN age BETWEEN 50 AND 59 THEN '50-59' WHEN age BETWEEN 60 AND 69 THEN '60-69' WHEN age BETWEEN 70 AND 79 THEN '70-79' END AS decade, CASE WHEN age BETWEEN 5 AND 8 THEN '5-8' WHEN age BETWEEN 9 AND 12 THEN '9-12' WHEN age BETWEEN 13 AND 17 THEN '13-17' WHEN age BETWEEN 18 AND 21 THEN '18-21' END AS young FROM subjects",
    "p15_signal_channels": "SELECT c_custkey, channel FROM (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'VEOG' WHEN 1 THEN 'ECG1' WHEN 2 THEN 'EMG left' WHEN 3 THEN 'Status' WHEN 4 THEN 'Fz' WHEN 5 THEN 'T7' ELSE 'GSR' END AS channel FROM customer) q WHERE NOT (UPPER(channel) LIKE '%EOG%' OR UPPER(channel) LIKE '%ECG%' OR UPPER(channel) LIKE '%EMG%' OR UPPER(channel) LIKE '%STATUS%' OR UPPER(channel) LIKE '%GSR%')",
    "p21_families": f"WITH {GRAPH}, every AS (SELECT CONCAT('_pair_', ca, '_', cb) AS channel FROM graph UNION ALL SELECT CONCAT('_src_net_', region) FROM regions UNION ALL SELECT CONCAT('_src_dk_', channel) FROM regions UNION ALL SELECT channel FROM metrics) SELECT channel, CASE WHEN channel LIKE '%pair%' THEN 'pair' WHEN channel LIKE '%src_net%' THEN 'network' WHEN channel LIKE '%src%' THEN 'source' ELSE 'scalp' END AS family, COUNT(*) AS n FROM every GROUP BY channel, CASE WHEN channel LIKE '%pair%' THEN 'pair' WHEN channel LIKE '%src_net%' THEN 'network' WHEN channel LIKE '%src%' THEN 'source' ELSE 'scalp' END",
    "a29_peripheral": "WITH place AS (SELECT s_nationkey AS montage, s_suppkey AS channel, s_acctbal AS z FROM supplier), lim AS (SELECT montage, $PCT(z, 0.5) - 0.4 * (MAX(z) - MIN(z)) AS cut FROM place GROUP BY montage) SELECT p.montage, p.channel, p.z < l.cut AS peripheral FROM place p JOIN lim l ON l.montage = p.montage",
    "u5_bad_channels": "SELECT recording_id, $JOIN(channel) AS channels, COUNT(*) AS n FROM (SELECT recording_id, channel FROM (SELECT recording_id, channel, VAR_POP(v) AS s FROM signal GROUP BY recording_id, channel) a WHERE s < 0.1 UNION SELECT recording_id, channel FROM signal WHERE ABS(v) > 80) u GROUP BY recording_id",
    # --- sorted tables -----------------------------------------------------------------------------------------------------------------------
    "t1_cell_order": f"WITH {MEANS} SELECT bin, sex, condition, channel, band, metric, n FROM cell ORDER BY bin_lo, sex, condition, channel, band, metric",
    "t2_reliability_order": f"WITH {ICC} SELECT condition, channel, band, metric, {r('COALESCE(icc, 1)')} AS order_icc FROM rel2 ORDER BY COALESCE(icc, 1), condition, channel, band, metric",
    # --- checks --------------------------------------------------------------------------------------------------------------------------------
    "v8_source_checks": f"""WITH p AS (SELECT m.subject_id, m.condition, g.region, AVG(m.value) AS power, MIN(m.value) AS least FROM metrics m JOIN regions g ON g.channel = m.channel WHERE m.metric = 'absolute_power' AND m.band = 'Alpha' GROUP BY m.subject_id, m.condition, g.region),
 a AS (SELECT AVG(CASE WHEN region = 'posterior' THEN power END) / nullif(AVG(CASE WHEN region = 'anterior' THEN power END), 0) AS ratio, MIN(least) AS least FROM p), c AS (SELECT subject_id, region, MAX(CASE WHEN condition = 'ec' THEN power END) AS ec, MAX(CASE WHEN condition = 'eo' THEN power END) AS eo FROM p GROUP BY subject_id, region)
 SELECT 'posterior_ratio' AS check_name, {r('ratio')} AS value, ratio > 0.9 AS ok FROM a UNION ALL SELECT 'non_negative', {r('least')}, least >= 0 FROM a UNION ALL SELECT 'closed_over_open', {r('AVG(CASE WHEN ec > eo THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)')}, AVG(CASE WHEN ec > eo THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) >= 0.7 FROM c WHERE ec IS NOT NULL AND eo IS NOT NULL
 UNION ALL SELECT 'in_range', {r('AVG(CASE WHEN value BETWEEN -0.01 AND 1.01 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)')}, COUNT_IF(NOT value BETWEEN -0.01 AND 1.01) = 0 FROM metrics WHERE metric = 'relative_power'""",
    "v9_network_checks": f"""WITH {GRAPH}, w AS (SELECT g.band, AVG(CASE WHEN a.region = b.region AND a.region = 'posterior' THEN weight END) AS within_, AVG(CASE WHEN a.region <> b.region THEN weight END) AS between_ FROM graph g JOIN regions a ON a.channel = g.ca JOIN regions b ON b.channel = g.cb GROUP BY g.band)
 SELECT band, {r('within_')} AS within_mean, {r('within_ / nullif(between_, 0)')} AS ratio, within_ > 0.005 AS strong, within_ / nullif(between_, 0) > 0.7 AS ok, within_ > (SELECT AVG(within_) FROM w) AS above_mean FROM w""",
    "v10_topography": f"""WITH {MEANS}, t AS (SELECT c.band, g.region, AVG(c.mean) AS power FROM cell c JOIN regions g ON g.channel = c.channel WHERE c.sex = 'pooled' AND c.metric = 'relative_power' GROUP BY c.band, g.region), o AS (SELECT band, AVG(CASE WHEN channel IN ('O1', 'O2') THEN mean END) AS within_, AVG(CASE WHEN channel NOT IN ('O1', 'O2') THEN mean END) AS across_ FROM cell WHERE sex = 'pooled' AND metric = 'relative_power' GROUP BY band)
 SELECT t.band, t.region, {r('t.power')} AS power, {r('o.within_')} AS occipital, {r('o.across_')} AS elsewhere, o.within_ > o.across_ AS ok FROM t JOIN o ON o.band = t.band""",
    "q6_reference": "SELECT r.recording_id, s.recording_id IS NULL AS absent, COALESCE(s.var < 0.1, FALSE) AS flat FROM (SELECT DISTINCT recording_id FROM signal) r LEFT JOIN (SELECT recording_id, VAR_POP(v) AS var FROM signal WHERE channel = 'purchase' GROUP BY recording_id) s ON s.recording_id = r.recording_id",
    "q12_recording_results": """WITH flat AS (SELECT recording_id, COUNT_IF(var < 0.1) AS n_flat, COUNT(*) AS n_channels FROM (SELECT recording_id, channel, VAR_POP(v) AS var FROM signal GROUP BY recording_id, channel) c GROUP BY recording_id), gross AS (SELECT recording_id, COUNT_IF(ABS(v) > 60) AS n_gross, COUNT(*) AS n FROM signal GROUP BY recording_id),
 blocks AS (SELECT recording_id, COUNT_IF(kind = 'eo') AS n_eo, COUNT_IF(kind = 'ec') AS n_ec FROM markers GROUP BY recording_id)
 SELECT f.recording_id, f.n_channels, f.n_flat, g.n_gross, COALESCE(b.n_eo, 0) AS n_eo, COALESCE(b.n_ec, 0) AS n_ec, CASE WHEN f.n_flat * 2 > f.n_channels OR COALESCE(b.n_eo, 0) + COALESCE(b.n_ec, 0) = 0 THEN 'excluded' WHEN g.n_gross * 2 > g.n OR f.n_flat > 0 THEN 'review' ELSE 'ready' END AS verdict,
 CONCAT(CASE WHEN f.n_flat > 0 THEN 'flat;' ELSE '' END, CASE WHEN g.n_gross * 2 > g.n THEN 'gross;' ELSE '' END, CASE WHEN COALESCE(b.n_eo, 0) = 0 THEN 'no eo;' ELSE '' END, CASE WHEN COALESCE(b.n_ec, 0) = 0 THEN 'no ec;' ELSE '' END) AS issues FROM flat f JOIN gross g ON g.recording_id = f.recording_id LEFT JOIN blocks b ON b.recording_id = f.recording_id""",
    "q13_montage_report": f"""WITH {SEEN}, named AS (SELECT subject_id, CASE channel WHEN 'T3' THEN 'T7' WHEN 'T4' THEN 'T8' ELSE channel END AS raw FROM seen), back AS (SELECT DISTINCT subject_id, CASE UPPER(raw) WHEN 'T7' THEN 'T3' WHEN 'T8' THEN 'T4' ELSE raw END AS channel FROM named)
 SELECT b.subject_id, COUNT(a.channel) AS n_present, 19 - COUNT(a.channel) AS n_missing, COUNT(*) - COUNT(a.channel) AS n_extra, COUNT(a.channel) = 19 AS complete FROM back b LEFT JOIN (SELECT DISTINCT channel FROM adjacency) a ON a.channel = b.channel GROUP BY b.subject_id""",
}
