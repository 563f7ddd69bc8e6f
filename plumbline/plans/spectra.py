"""Long spectral metrics from power spectra (band integrals, aperiodic fit, periodic power, scale factor, alpha frequency, ratios, asymmetry) and the
checks of their ranges, as SQL that Spark and the oracle share."""

from __future__ import annotations

from plumbline.functions.numeric import num
from plumbline.plans.catalog import BANDPOWER, FIT, RATIO, corr, r
from plumbline.sources.parameters import PARAMETERS

GENERAL = {p[2]: p[5] for p in PARAMETERS if p[0] is None and p[1] is None and p[4] is None}
LOW, HIGH = 0.5, 50.0
#: Peaks of the flattened spectrum lower than this (in log10 units) are none.
LEAST_PEAK = 0.1


def integrals(source: str, prefix: str) -> str:
    """Trapezoids of a spectrum (recording_id, freq, psd) over each band's own points (<prefix>bp) and over all (<prefix>total)."""
    return f"""{prefix}seg AS (SELECT recording_id, freq, psd, LAG(freq) OVER (PARTITION BY recording_id ORDER BY freq) AS f0, LAG(psd) OVER (PARTITION BY recording_id ORDER BY freq) AS p0 FROM {source}),
{prefix}total AS (SELECT recording_id, SUM((freq - f0) * (psd + p0) / 2) AS total FROM {prefix}seg GROUP BY recording_id),
{prefix}bp AS (SELECT s.recording_id, b.band, SUM(CASE WHEN s.f0 >= b.lo THEN (s.freq - s.f0) * (s.psd + s.p0) / 2 ELSE CAST(0 AS DOUBLE) END) AS power FROM {prefix}seg s JOIN bands b ON s.freq >= b.lo AND s.freq <= b.hi GROUP BY s.recording_id, b.band)"""


#: The spectrum without its aperiodic part, where the fit has points enough; in linear units.
PERIODIC = f"""{FIT}, flat AS (SELECT p.recording_id, p.freq, p.psd AS raw, LOG10(GREATEST(p.psd, {num(1e-30)})) - f.intercept - f.slope * LOG10(p.freq) AS height, GREATEST(p.psd, {num(0.0)}) / POWER(10, f.intercept + f.slope * LOG10(p.freq)) AS psd
 FROM psd p JOIN f2 f ON f.recording_id = p.recording_id WHERE p.freq >= {LOW} AND p.freq <= {HIGH} AND f.n_points >= 5), {integrals('flat', 'c')}"""
#: Peak: the highest local maximum of the flattened spectrum; gravity: the centre of the raw one.
ALPHA = f"""hill AS (SELECT recording_id, freq, height, LAG(height) OVER (PARTITION BY recording_id ORDER BY freq) AS a, LEAD(height) OVER (PARTITION BY recording_id ORDER BY freq) AS b FROM flat),
peak AS (SELECT recording_id, MAX_BY(freq, height) AS peak, MAX(height) AS height FROM hill WHERE freq >= {GENERAL['peak_low']} AND freq <= {GENERAL['peak_high']} AND height > a AND height > b AND height >= {num(LEAST_PEAK)} GROUP BY recording_id),
grav AS (SELECT recording_id, SUM(freq * psd) / nullif(SUM(psd), 0) AS gravity FROM psd WHERE freq >= {GENERAL['peak_low']} AND freq <= {GENERAL['peak_high']} GROUP BY recording_id)"""
SCALE = f"scale AS (SELECT recording_id, AVG(LOG10(GREATEST(psd, {num(1e-30)}))) AS gsf FROM psd WHERE freq >= {LOW} AND freq <= {HIGH} GROUP BY recording_id), scaled AS (SELECT p.recording_id, p.freq, p.psd / POWER(10, s.gsf) AS psd FROM psd p JOIN scale s ON s.recording_id = p.recording_id WHERE p.freq >= {LOW} AND p.freq <= {HIGH}), {integrals('scaled', 'g')}"
#: Each spectrum is one sensor's: five to a subject, named by the subject's montage.
SENSOR = "sensor AS (SELECT q.recording_id, w.subject_id, w.age, w.sex, w.dataset, w.montage, CASE WHEN q.recording_id % 10 < 5 THEN 'eo' ELSE 'ec' END AS condition, c.item AS channel FROM (SELECT DISTINCT recording_id FROM psd) q JOIN worn w ON w.subject_id = CAST(FLOOR(q.recording_id / 5) AS BIGINT) JOIN setting c ON c.dataset = w.dataset AND c.montage = w.montage AND c.name = 'sensors' AND c.pos = q.recording_id % 5)"
SUBJECT_ALPHA = f"""{SENSOR}, post AS (SELECT s.subject_id, s.condition, MAX(s.age) AS age, MAX(s.sex) AS sex, AVG(p.peak) AS peak, AVG(g.gravity) AS gravity, COUNT(p.peak) AS n_peaks FROM sensor s JOIN setting c ON c.name = 'peak_channels' AND c.dataset = s.dataset AND c.montage = s.montage AND c.item = s.channel
 LEFT JOIN peak p ON p.recording_id = s.recording_id LEFT JOIN grav g ON g.recording_id = s.recording_id GROUP BY s.subject_id, s.condition)"""
RATIOS = f"ra AS (SELECT b.recording_id, q.ratio, {RATIO} AS value FROM bp b JOIN ratios q ON q.band = b.band JOIN (SELECT ratio, COUNT(*) AS need FROM ratios GROUP BY ratio) n ON n.ratio = q.ratio GROUP BY b.recording_id, q.ratio HAVING COUNT(*) = MAX(n.need))"
_BASE = f"{BANDPOWER}, {PERIODIC}, {ALPHA}, {SCALE}, {RATIOS}, {SUBJECT_ALPHA}"
_OF = "SELECT s.subject_id, s.age, s.sex, s.condition, s.channel"
#: (subject_id, age, sex, condition, channel, band, metric, value): all that is known of a subject's spectra.
LONG = f"""long_ AS ({_OF}, b.band, 'absolute_power' AS metric, b.power AS value FROM bp b JOIN sensor s ON s.recording_id = b.recording_id
 UNION ALL {_OF}, b.band, 'relative_power', b.power / nullif(t.total, 0) FROM bp b JOIN total t ON t.recording_id = b.recording_id JOIN sensor s ON s.recording_id = b.recording_id
 UNION ALL {_OF}, b.band, 'corrected_absolute_power', b.power FROM cbp b JOIN sensor s ON s.recording_id = b.recording_id
 UNION ALL {_OF}, b.band, 'corrected_relative_power', b.power / nullif(t.total, 0) FROM cbp b JOIN ctotal t ON t.recording_id = b.recording_id JOIN sensor s ON s.recording_id = b.recording_id
 UNION ALL {_OF}, b.band, 'gsf_absolute_power', b.power FROM gbp b JOIN sensor s ON s.recording_id = b.recording_id
 UNION ALL {_OF}, b.band, 'gsf_relative_power', b.power / nullif(t.total, 0) FROM gbp b JOIN gtotal t ON t.recording_id = b.recording_id JOIN sensor s ON s.recording_id = b.recording_id
 UNION ALL {_OF}, a.ratio, 'value', a.value FROM ra a JOIN sensor s ON s.recording_id = a.recording_id
 UNION ALL {_OF}, 'broadband', 'aperiodic_exponent', -f.slope FROM f2 f JOIN sensor s ON s.recording_id = f.recording_id WHERE f.n_points >= 5 AND f.r2 >= 0.85
 UNION ALL {_OF}, 'broadband', 'aperiodic_offset', f.intercept FROM f2 f JOIN sensor s ON s.recording_id = f.recording_id WHERE f.n_points >= 5 AND f.r2 >= 0.85
 UNION ALL {_OF}, 'Alpha', 'iaf_peak', p.peak FROM peak p JOIN sensor s ON s.recording_id = p.recording_id UNION ALL {_OF}, 'Alpha', 'iaf_cog', g.gravity FROM grav g JOIN sensor s ON s.recording_id = g.recording_id
 UNION ALL SELECT subject_id, age, sex, condition, '_subject', 'Alpha', 'iaf_peak', peak FROM post WHERE peak IS NOT NULL UNION ALL SELECT subject_id, age, sex, condition, '_subject', 'Alpha', 'iaf_cog', gravity FROM post WHERE gravity IS NOT NULL
 UNION ALL SELECT s.subject_id, MAX(s.age), MAX(s.sex), s.condition, '_subject', 'broadband', 'gsf', AVG(g.gsf) FROM scale g JOIN sensor s ON s.recording_id = g.recording_id GROUP BY s.subject_id, s.condition
 UNION ALL SELECT x.subject_id, x.age, x.sex, x.condition, CONCAT(p.key_, '/', p.item), bx.band, 'asymmetry', CASE WHEN bx.power + b2.power > 0 THEN (b2.power - bx.power) / (bx.power + b2.power) ELSE 0 END FROM sensor x JOIN setting p ON p.name = 'pairs' AND p.dataset = x.dataset AND p.montage = x.montage AND p.key_ = x.channel JOIN sensor y ON y.subject_id = x.subject_id AND y.condition = x.condition AND y.channel = p.item JOIN bp bx ON bx.recording_id = x.recording_id JOIN bp b2 ON b2.recording_id = y.recording_id AND b2.band = bx.band)"""
_CELLS = f"{_BASE}, {LONG}, cell AS (SELECT b.bin, b.bin_lo, b.bin_hi, l.condition, l.channel, l.band, l.metric, COUNT(*) AS n, AVG(l.value) AS mean, COALESCE(STDDEV_SAMP(l.value), 0) AS sd FROM long_ l JOIN bins b ON l.age >= b.bin_lo AND l.age < b.bin_hi WHERE l.value IS NOT NULL GROUP BY b.bin, b.bin_lo, b.bin_hi, l.condition, l.channel, l.band, l.metric)"
#: Where means of healthy adults lie (exponent, alpha frequency of the subject, theta/beta ratio).
RANGES = [("aperiodic_exponent", "metric = 'aperiodic_exponent'", 0.5, 3.0), ("iaf", "metric = 'iaf_peak' AND channel = '_subject'", 8.0, 13.0), ("theta_beta", "band = 'Theta/Beta'", 0.1, 20.0)]
LEAST_N = 5
MAIN_BANDS = "('Delta', 'Theta', 'Alpha', 'Beta', 'Gamma')"

QUERIES: dict[str, str] = {
    "k6_corrected_power": f"WITH {PERIODIC} SELECT b.recording_id, b.band, {r('b.power')} AS corrected_absolute, {r('b.power / nullif(t.total, 0)')} AS corrected_relative FROM cbp b JOIN ctotal t ON t.recording_id = b.recording_id",
    "k8_global_scale": f"WITH {SCALE} SELECT c.recording_id, c.freq, {r('s.gsf')} AS gsf, {r('c.psd')} AS corrected FROM scaled c JOIN scale s ON s.recording_id = c.recording_id",
    "k9_gsf_power": f"WITH {SCALE} SELECT b.recording_id, b.band, {r('b.power')} AS absolute, {r('b.power / nullif(t.total, 0)')} AS relative FROM gbp b JOIN gtotal t ON t.recording_id = b.recording_id",
    "k10_alpha_frequency": f"WITH {PERIODIC}, {ALPHA} SELECT g.recording_id, {r('g.gravity')} AS gravity, p.peak, {r('p.height')} AS height FROM grav g LEFT JOIN peak p ON p.recording_id = g.recording_id",
    "k10_subject_alpha": f"WITH {PERIODIC}, {ALPHA}, {SUBJECT_ALPHA} SELECT subject_id, condition, n_peaks, {r('peak')} AS peak, {r('gravity')} AS gravity, COALESCE(peak, gravity) BETWEEN {GENERAL['typical_low']} AND {GENERAL['typical_high']} AS typical FROM post",
    "k11_long_spectral": f"WITH {_BASE}, {LONG} SELECT subject_id, condition, channel, band, metric, {r('value')} AS value FROM long_ WHERE value IS NOT NULL",
    "k11_spectral_cells": f"WITH {_CELLS} SELECT bin, condition, channel, band, metric, n, {r('mean')} AS mean, {r('sd')} AS sd FROM cell",
    "v4_ranges": f"WITH {_CELLS} " + " UNION ALL ".join(f"SELECT '{name}' AS check_name, bin, condition, channel, n, {r('mean')} AS mean, mean BETWEEN {lo} AND {hi} AS ok FROM cell WHERE {which} AND n >= {LEAST_N}" for name, which, lo, hi in RANGES),
    "v5_exponent_age": f"WITH {FIT}, {SENSOR}, e AS (SELECT b.bin_lo, b.bin_hi, AVG(-f.slope) AS exponent, COUNT(*) AS n FROM f2 f JOIN sensor s ON s.recording_id = f.recording_id JOIN bins b ON s.age >= b.bin_lo AND s.age < b.bin_hi WHERE f.n_points >= 5 AND s.channel = 'Pz' GROUP BY b.bin_lo, b.bin_hi) SELECT COUNT(*) AS n_bins, {r(corr('(bin_lo + bin_hi) / 2.0', 'exponent'))} AS r, {corr('(bin_lo + bin_hi) / 2.0', 'exponent')} < 0 AS ok FROM e",
    "v6_relative_sum": f"WITH {_CELLS} SELECT bin, condition, channel, COUNT(*) AS n_bands, {r('SUM(mean)')} AS total, SUM(mean) BETWEEN 0.70 AND 1.10 AS ok FROM cell WHERE metric = 'relative_power' AND band IN {MAIN_BANDS} AND n >= {LEAST_N} GROUP BY bin, condition, channel HAVING COUNT(*) >= 4",
}
