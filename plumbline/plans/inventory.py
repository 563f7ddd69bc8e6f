"""Further queries of the inventory: routing and manifests by category, ordered channel vectors, condition rules, parameter hashes, duplicate cells,
overlapping epochs, single references, and the report queries at their surveyed limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numeric import num
from plumbline.operators import signals
from plumbline.plans import catalog, core, norms
from plumbline.plans.catalog import FAN, FIT, GRAPH, r
from plumbline.plans.core import rounded
from plumbline.plans.sql import run
from plumbline.sources import adapters, io
from plumbline.sources.fixtures import CHANNELS

# The category of a cell by its channel's prefix; the longer prefix decides.
PREFIXES = [("_src_ba_conn_", "source_ba_connectivity"), ("_src_conn_", "source_connectivity"), ("_src_net_", "source_network"), ("_src_ba_", "source_ba"), ("_src_dk_", "source_dk"), ("_subject", "subject"), ("_graph", "graph"), ("_pair_", "pair"), ("_hub_", "hub"), ("_pac_", "pac")]
CATEGORY = "CASE " + " ".join(f"WHEN SUBSTR(channel, 1, {len(p)}) = '{p}' THEN '{name}'" for p, name in PREFIXES) + " WHEN channel LIKE '%/%' THEN 'asymmetry' ELSE 'scalp' END"
#: Long rows of several kinds with their subject: scalp metrics, pairs, graphs and hubs of the correlation graphs, regions and asymmetries.
EVERY = f"""{GRAPH}, owned AS (SELECT subject_id, condition, channel, band, metric, value FROM metrics
 UNION ALL SELECT subject_id, condition, CONCAT('_pair_', ca, '_', cb), band, 'coupling', weight FROM graph UNION ALL SELECT subject_id, condition, '_graph', band, 'mean_weight', AVG(weight) FROM kept GROUP BY subject_id, condition, band
 UNION ALL SELECT s.subject_id, s.condition, CONCAT('_hub_', h.hub), s.band, 'strength', SUM(s.weight) FROM sym s JOIN hubs h ON h.channel = s.u GROUP BY s.subject_id, s.condition, h.hub, s.band
 UNION ALL SELECT m.subject_id, m.condition, CONCAT('_src_net_', g.region), m.band, 'power', AVG(m.value) FROM metrics m JOIN regions g ON g.channel = m.channel WHERE m.metric = 'absolute_power' GROUP BY m.subject_id, m.condition, g.region, m.band
 UNION ALL SELECT a.subject_id, a.condition, CONCAT(p.key_, '/', p.item), a.band, 'asymmetry', CASE WHEN a.value + b.value > 0 THEN (b.value - a.value) / (a.value + b.value) ELSE 0 END FROM metrics a JOIN parameters p ON p.name = 'pairs' AND p.montage IS NULL AND p.key_ = a.channel JOIN metrics b ON b.subject_id = a.subject_id AND b.condition = a.condition AND b.band = a.band AND b.metric = a.metric AND b.channel = p.item WHERE a.metric = 'absolute_power'),
every AS (SELECT b.bin, f.sex AS sex, o.condition, o.channel, o.band, o.metric, o.value, {CATEGORY} AS category FROM owned o JOIN subjects s ON s.subject_id = o.subject_id JOIN bins b ON s.age >= b.bin_lo AND s.age < b.bin_hi JOIN (VALUES ('F', 'F'), ('M', 'M'), ('F', 'pooled'), ('M', 'pooled'), ('Other', 'pooled')) AS f(own, sex) ON f.own = s.sex),
cells AS (SELECT category, bin, sex, condition, channel, band, metric, COUNT(*) AS n FROM every GROUP BY category, bin, sex, condition, channel, band, metric)"""
MANIFEST = "SELECT category, COUNT(*) AS n_cells, COUNT(DISTINCT channel) AS n_channels, CAST(0 AS BIGINT) AS n_freqs, $JOIN(DISTINCT band) AS bands, $JOIN(DISTINCT metric) AS metrics, $JOIN(DISTINCT sex) AS sexes, $JOIN(DISTINCT bin) AS age_bins FROM cells GROUP BY category"
#: Spectra that are on the grid of most rows; others are left out and counted.
SPECTRUM = """grid AS (SELECT recording_id, COUNT(*) AS n_points, MIN(freq) AS lo, MAX(freq) AS hi FROM psd WHERE freq >= 0.5 AND freq <= 50 AND recording_id % 17 <> 3 OR freq >= 0.5 AND freq <= 40 GROUP BY recording_id),
usual AS (SELECT n_points, lo, hi FROM (SELECT n_points, lo, hi, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, n_points DESC, lo, hi) AS k FROM grid GROUP BY n_points, lo, hi) q WHERE k = 1),
fit_ AS (SELECT g.recording_id, g.n_points, u.n_points IS NOT NULL AS aligned FROM grid g LEFT JOIN usual u ON u.n_points = g.n_points AND u.lo = g.lo AND u.hi = g.hi)"""


def surveyed(text: str, old: str, new: str) -> str:
    """The text with one limit changed; a text without it is a mistake."""
    if text.count(old) < 1:
        raise ValueError(f"{old} is not in the query")
    return text.replace(old, new)


SHARED: dict[str, str] = {
    "s9_category_routing": f"WITH {EVERY} SELECT category, channel, COUNT(*) AS n_cells, SUM(n) AS n_values FROM cells GROUP BY category, channel",
    "s10_bundle_manifest": f"WITH {EVERY} {MANIFEST}",
    # The manifest with the spectra's entry.
    "s11_spectra_registered": f"WITH {EVERY}, {SPECTRUM} {MANIFEST} UNION ALL SELECT 'psd_spectrum', COUNT(*), COUNT(DISTINCT f.recording_id % 5), MAX(CASE WHEN f.aligned THEN f.n_points END), '', 'log_psd', $JOIN(DISTINCT s.sex), '' FROM fit_ f JOIN subjects s ON s.subject_id = CAST(FLOOR(f.recording_id / 5) AS BIGINT) WHERE f.aligned",
    "s8_spectra_aligned": f"WITH {SPECTRUM} SELECT aligned, n_points, COUNT(*) AS n_spectra FROM fit_ GROUP BY aligned, n_points",
    # One row for each map: the channels in the montage's order, null where there is no cell.
    "s16_channel_vector": f"WITH {catalog.MEANS} SELECT bin, sex, condition, band, metric, " + ", ".join(f"{r(f'''MAX(CASE WHEN channel = '{c}' THEN mean END)''')} AS c{i:02d}_{c.lower()}" for i, c in enumerate(CHANNELS)) + f", {len(CHANNELS)} - COUNT(DISTINCT channel) AS n_missing FROM cell GROUP BY bin, sex, condition, band, metric",
    "p19_params_hash": "WITH listed AS (SELECT dataset, montage, CONCAT(name, ':', CAST(pos AS VARCHAR(20)), ':', COALESCE(key_, ''), ':', COALESCE(item, ''), ':', COALESCE(CAST(CAST(ROUND(value * 1000) AS BIGINT) AS VARCHAR(20)), '')) AS line FROM setting) SELECT dataset, montage, COUNT(*) AS n, $SHA($JOIN(line)) AS params_sha256 FROM listed GROUP BY dataset, montage",
    "k1_single_reference": f"SELECT e.channel, e.epoch, e.t_idx, {r('e.v - c.v')} AS v FROM epochs e JOIN epochs c ON c.channel = 2 AND c.epoch = e.epoch AND c.t_idx = e.t_idx",
    # Ratios of all power keys; a denominator that is not positive gives none.
    "g3_region_ratios": f"WITH p AS (SELECT m.subject_id, m.condition, g.region, m.metric, m.band, AVG(m.value) AS power FROM metrics m JOIN regions g ON g.channel = m.channel GROUP BY m.subject_id, m.condition, g.region, m.metric, m.band), s AS (SELECT p.subject_id, p.condition, p.region, p.metric, q.ratio, SUM(CASE WHEN q.side = 'num' THEN p.power END) AS num, SUM(CASE WHEN q.side = 'den' THEN p.power END) AS den, COUNT(*) AS have FROM p JOIN ratios q ON q.band = p.band GROUP BY p.subject_id, p.condition, p.region, p.metric, q.ratio) SELECT s.subject_id, s.condition, s.region, s.metric, s.ratio, {r('s.num / s.den')} AS value FROM s JOIN (SELECT ratio, COUNT(*) AS need FROM ratios GROUP BY ratio) n ON n.ratio = s.ratio WHERE s.have = n.need AND s.den > 0",
    # The aperiodic fit of k5 (with its refit on the points below the first line) on the mean spectrum of a region.
    "g5_region_correction": f"""WITH area AS (SELECT recording_id, region, freq, AVG(psd) AS psd FROM (SELECT CAST(FLOOR(recording_id / 5) AS BIGINT) AS recording_id, CASE WHEN recording_id % 5 < 2 THEN 'front' ELSE 'back' END AS region, freq, psd FROM psd) q GROUP BY recording_id, region, freq),
 {FIT.replace('FROM psd WHERE', 'FROM area WHERE').replace('recording_id', 'recording_id, region', 1).replace('GROUP BY recording_id)', 'GROUP BY recording_id, region)').replace('f1 AS (SELECT recording_id,', 'f1 AS (SELECT recording_id, region,').replace('f2 AS (SELECT p.recording_id,', 'f2 AS (SELECT p.recording_id, p.region,').replace('f1.recording_id = p.recording_id', 'f1.recording_id = p.recording_id AND f1.region = p.region').replace('GROUP BY p.recording_id', 'GROUP BY p.recording_id, p.region')},
 flat AS (SELECT a.recording_id, a.region, a.freq, LOG10(GREATEST(a.psd, {num(1e-30)})) - f.intercept - f.slope * LOG10(a.freq) AS h FROM area a JOIN f2 f ON f.recording_id = a.recording_id AND f.region = a.region WHERE a.freq >= 2 AND a.freq <= 40 AND f.n_points >= 5)
 SELECT p.recording_id, p.region, d.band, {r('AVG(p.h)')} AS log_corrected, {r('AVG(POWER(10, p.h))')} AS corrected FROM flat p JOIN bands d ON p.freq >= d.lo AND p.freq <= d.hi GROUP BY p.recording_id, p.region, d.band""",
    "q11_bad_windows_surveyed": surveyed(catalog.QUERIES["q11_bad_windows"], "s > 1.5 * med", "s > 5 * med"),
    "a9_unit_sanity_surveyed": surveyed(catalog.QUERIES["a9_unit_sanity"], num(1e-2), num(1e-7)),
}

_NAMES = """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'lemon' WHEN 1 THEN 'mipdb' WHEN 2 THEN 'hbn' WHEN 3 THEN 'dortmund' WHEN 4 THEN 'trt' ELSE 'other' END AS dataset,
 CONCAT('sub-', CAST(o_custkey AS VARCHAR(20)), CASE o_custkey % 5 WHEN 0 THEN '_task-EyesOpen' WHEN 1 THEN '_task-eyesclosed' WHEN 2 THEN '_task-RestingState' WHEN 3 THEN '_task-restEC' ELSE '' END, CASE o_orderstatus WHEN 'O' THEN '_EO' WHEN 'F' THEN '_EC' ELSE '_rest' END) AS stem FROM orders"""


def condition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.classify(run(spark, sf_dir, _NAMES), adapters.condition_rules(spark)).select("o_orderkey", "dataset", "stem", "condition")


def best_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of both datasets in one table: of cells with one key that of largest n is kept."""
    rows = norms.metrics(spark, sf_dir)
    both = norms.norm_cells(rows.where("dataset = 0"), shape=False).unionByName(norms.norm_cells(rows.where("dataset = 1"), shape=False))
    return norms.best_cells(both).select(*norms.KEYS, "n")


def overlapping_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs of 128 samples that overlap by half, by exploded numbers; the middle eight of a recording's whole ones."""
    samples = run(spark, sf_dir, "SELECT recording_id, channel, t_idx, v FROM samples")
    placed = samples.withColumn("epoch", F.explode(signals.segment_numbers(F.col("t_idx"), 128, 64)))
    whole = placed.groupBy("recording_id", "channel", "epoch").agg(F.count("*").alias("n"), F.avg("v").alias("mean")).where("n = 128")
    return rounded(signals.middle(whole, ["recording_id", "channel"], "epoch", least=3, most=8), "recording_id", "channel", "epoch", "n", "mean")


def nearest_within(spark: SparkSession, sf_dir: str, bucket: int = 15) -> DataFrame:
    """For each part the nearest supplier by number within the bucket's width: each supplier once for its bucket and both beside it, met on equal buckets."""
    parts = run(spark, sf_dir, f"SELECT p_partkey, CAST(FLOOR(p_partkey / {bucket}) AS BIGINT) AS b FROM part")
    near = run(spark, sf_dir, f"SELECT s_suppkey, EXPLODE(SEQUENCE(b - 1, b + 1)) AS b FROM (SELECT s_suppkey, CAST(FLOOR(s_suppkey * 20 / {bucket}) AS BIGINT) AS b FROM supplier)")
    pairs = parts.join(near, "b").withColumn("d", F.abs(F.col("p_partkey") - 20 * F.col("s_suppkey"))).where(F.col("d") <= bucket)
    best = pairs.groupBy("p_partkey").agg(F.min(F.struct("d", "s_suppkey")).alias("best"))
    return best.select("p_partkey", "best.s_suppkey", "best.d")


def significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.significant_findings(spark, sf_dir, alpha=0.05)


def patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = norms.global_patterns(core._scored(spark, sf_dir, ranks=False))
    return rounded(out, *out.columns)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = norms.clusters(core._scored(spark, sf_dir, ranks=False)).drop("root")
    return rounded(out, *out.columns)


def nested_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long metrics as one JSON document for each record, read back and exploded."""
    keys = ["subject_id", "condition"]
    packed = io.nest_metrics(run(spark, sf_dir, "SELECT * FROM metrics"), keys).select(*keys, F.to_json("metrics").alias("document"))
    back = packed.select(*keys, F.from_json("document", "map<string, map<string, map<string, double>>>").alias("metrics"))
    return rounded(io.explode_metrics(back), *keys, "channel", "band", "metric", "value")


_RULES = ", ".join(str(x) for x in adapters.RULES)
ORACLES = {
    "p5_condition_rules": f"""WITH n AS ({_NAMES}), rule_(dataset, priority, kind, pattern, condition) AS (VALUES {_RULES}),
m AS (SELECT n.o_orderkey, arg_min(x.condition, x.priority) AS condition FROM n JOIN rule_ x ON x.dataset = n.dataset AND CASE x.kind WHEN 'upper' THEN contains(upper(stem), pattern) WHEN 'lower' THEN contains(lower(stem), pattern) WHEN 'token' THEN list_contains(string_split(upper(stem), '_'), pattern) ELSE lower(regexp_extract(stem, 'task-([A-Za-z0-9]+)', 1)) = pattern END GROUP BY n.o_orderkey)
SELECT n.*, m.condition FROM n LEFT JOIN m USING (o_orderkey)""",
    "j3_best_cells": f"WITH {FAN} SELECT bin, bin_lo, bin_hi, sex, condition, channel, band, metric, max(n) AS n FROM (SELECT dataset, {catalog.CELL}, count(*) AS n FROM fan GROUP BY ALL) GROUP BY ALL",
    "w10_overlapping_epochs": f"""WITH e AS (SELECT recording_id, channel, g.e AS epoch, count(*) AS n, avg(v) AS mean FROM samples, range(0, 200) AS g(e) WHERE t_idx BETWEEN g.e * 64 AND g.e * 64 + 127 GROUP BY ALL HAVING count(*) = 128),
k AS (SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY recording_id, channel) AS m FROM e WINDOW w AS (PARTITION BY recording_id, channel ORDER BY epoch))
SELECT recording_id, channel, epoch, n, {r('mean')} AS mean FROM k WHERE m >= 3 AND k >= (m - least(m, 8)) // 2 AND k < (m - least(m, 8)) // 2 + least(m, 8)""",
    "k13_nested_round_trip": f"SELECT subject_id, condition, channel, band, metric, {r('value')} AS value FROM metrics",
    "t5_significant_surveyed": core.significant_sql(0.05),
    "z6_patterns_surveyed": core.patterns_sql(1.5, 0.6),
    "z7_clusters_surveyed": core.clusters_sql(1.5),
}
QUERIES = {"j13_nearest_within": nearest_within, "p5_condition_rules": condition_rules, "j3_best_cells": best_cells, "w10_overlapping_epochs": overlapping_epochs, "k13_nested_round_trip": nested_round_trip, "t5_significant_surveyed": significant, "z6_patterns_surveyed": patterns, "z7_clusters_surveyed": clusters}
