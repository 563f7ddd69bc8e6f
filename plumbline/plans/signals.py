"""Queries over signals: segmented spectra, coupling, cross-frequency coupling and extracted segments, with DuckDB oracles that sum cosines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numeric import num
from plumbline.operators import signals
from plumbline.operators.grouped import MEASURES, c12_analytic_signal, graph_metrics, j12_greedy_electrodes
from plumbline.plans.catalog import DFT, GRAPH, r
from plumbline.plans.core import rounded
from plumbline.plans.sql import run
from plumbline.sources.parameters import PARAMETERS

RATE, SIZE, STEP = 256.0, 1_024, 512
GENERAL = {p[2]: p[5] for p in PARAMETERS if p[0] is None and p[1] is None and p[4] is None}
PHASE, AMPLITUDE, BINS = (GENERAL["phase_low"], GENERAL["phase_high"]), (GENERAL["amplitude_low"], GENERAL["amplitude_high"]), int(GENERAL["phase_bins"])


def _spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs of one second, of which each is a segment."""
    return signals.rfft_segments(run(spark, sf_dir, "SELECT channel, epoch, t_idx, v FROM epochs"), ["channel", "epoch"], 64)


def welch_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(signals.periodogram(_spectra(spark, sf_dir), ["channel"], 1), "channel", "k", "power")


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = signals.cross_spectra(_spectra(spark, sf_dir), ["epoch"], [])
    return signals.edges(signals.coupling(sums), run(spark, sf_dir, "SELECT * FROM bands"), F.col("k"))


def coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_edges(spark, sf_dir), "ca", "cb", "band", "coh", "dwpli", "imcoh")


def volume_conduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir).select("ca", "cb", "band", ((F.col("coh") > 0.6) & (F.col("dwpli") < 0.1)).alias("suspect"))


def node_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = _edges(spark, sf_dir)
    ends = edge.select(F.explode(F.array("ca", "cb")).alias("channel"), "band", "coh")
    return rounded(ends.groupBy("channel", "band").agg(F.sum("coh").alias("strength")), "channel", "band", "strength")


def welch_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power density of recordings in demeaned 1,024-point segments that overlap by half, 0.5 to 50 Hz."""
    psd = signals.welch(run(spark, sf_dir, "SELECT * FROM samples"), ["recording_id", "channel"], RATE, SIZE, STEP)
    return psd.select("recording_id", "channel", "freq", (F.round(F.col("psd") * 1e6 + 1.23e-8, 6) + 0.0).alias("psd_millionths"), F.col("n").alias("n_segments"))


def line_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power around the dataset's line frequency, against the other channels of the recording."""
    sensed, setting = run(spark, sf_dir, "SELECT * FROM sensed"), run(spark, sf_dir, "SELECT * FROM setting")
    wide = setting.groupBy("dataset", "montage").agg(*(F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in ("line_freq", "line_width", "line_z")))
    keys = ["recording_id", "dataset", "montage", "channel"]
    spectrum = signals.periodogram(signals.rfft_segments(sensed, keys, SIZE, STEP, demean=True), keys)
    near = spectrum.join(F.broadcast(wide), ["dataset", "montage"]).where(F.abs(F.col("k") * (RATE / SIZE) - F.col("line_freq")) <= F.col("line_width"))
    power = near.groupBy(*keys).agg(F.avg("power").alias("power"), F.max("line_freq").alias("line_freq"), F.max("line_z").alias("line_z"))
    stats = power.groupBy("recording_id").agg(F.avg("power").alias("m"), F.stddev_pop("power").alias("s"))
    z = (F.col("power") - F.col("m")) / F.nullif(F.col("s"), F.lit(0.0))
    return rounded(power.join(stats, "recording_id").withColumns({"z": z, "noisy": F.coalesce(z > F.col("line_z"), F.lit(False))}), "recording_id", "channel", "line_freq", "power", "z", "noisy")


def _modulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    hub = run(spark, sf_dir, "SELECT * FROM hub_signal")
    pairs = run(spark, sf_dir, "SELECT dataset, montage, key_ AS phase_hub, item AS amplitude_hub FROM setting WHERE name = 'coupled'")
    return signals.cross_frequency(hub, ["recording_id", "dataset", "montage"], pairs, RATE, PHASE, AMPLITUDE, BINS)


def modulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_modulation(spark, sf_dir), "recording_id", "phase_hub", "amplitude_hub", "modulation")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted segments, each in one row: its place end to end, its source and its sum."""
    rows = signals.extract_segments(run(spark, sf_dir, "SELECT * FROM samples"), run(spark, sf_dir, CONDITIONS), 64.0)
    out = rows.groupBy("recording_id", "condition", "channel", "segment").agg(F.count("*").alias("n"), F.min("t_idx").alias("first_t"), F.max("t_idx").alias("last_t"), F.min("source_idx").alias("first_source"), F.max("source_idx").alias("last_source"), F.sum("v").alias("total"), F.sum(F.col("v") * F.col("t_idx")).alias("moment"))
    return rounded(out, *out.columns)


def long_connectivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs, hubs, graphs and phase-amplitude coupling as long metrics."""
    rows = run(spark, sf_dir, PAIR_ROWS)
    kept = run(spark, sf_dir, f"WITH {GRAPH} SELECT subject_id, condition, band, ca, cb, weight FROM kept")
    measures = {"global_efficiency": "efficiency", "char_path_length": "path_length", "clustering": "clustering"}
    graph = graph_metrics(kept, ["subject_id", "condition", "band"], measures=tuple(measures.values())).select("subject_id", "condition", "band", F.lit("_graph").alias("channel"), F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(c).alias("value")) for n, c in measures.items()))).alias("m")).select("subject_id", "condition", "band", "channel", "m.metric", "m.value")
    inside = F.col("phase_hub") == F.col("amplitude_hub")
    name = F.when(inside, F.concat(F.lit("_hub_"), "phase_hub")).otherwise(F.concat(F.lit("_pac_"), "phase_hub", F.lit("__"), "amplitude_hub"))
    pac = _modulation(spark, sf_dir).select(F.col("recording_id").alias("subject_id"), F.lit("eo").alias("condition"), F.lit("ThetaGamma").alias("band"), name.alias("channel"), F.lit("pac_mi").alias("metric"), F.col("modulation").alias("value"))
    return rows.unionByName(rounded(graph.unionByName(pac), "subject_id", "condition", "band", "channel", "metric", "value"))


def graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = run(spark, sf_dir, f"WITH {GRAPH} SELECT subject_id, condition, band, ca, cb, weight FROM kept")
    return rounded(graph_metrics(kept, ["subject_id", "condition", "band"]), "subject_id", "condition", "band", "n_nodes", *MEASURES)


def analytic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(c12_analytic_signal(spark, sf_dir), "channel", "epoch", "t_idx", "phase", "amplitude")


def electrodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(j12_greedy_electrodes(spark, sf_dir), "recording_id", "target", "channel", "distance")


#: Condition intervals: start seconds from -2, 4 to 8 seconds long, some beyond the recording's end.
CONDITIONS = """SELECT DISTINCT user_id % 6 AS recording_id, CASE WHEN event_type = 'view' THEN 'eo' ELSE 'ec' END AS condition, CAST(CAST(FLOOR($US(ts) / 1000000) AS BIGINT) % 6 * 5 - 2 AS DOUBLE) AS start, CAST(CAST(FLOOR($US(ts) / 1000000) AS BIGINT) % 6 * 5 + 2 + event_id % 3 * 2 AS DOUBLE) + CAST(0.25 AS DOUBLE) AS stop FROM events WHERE event_type IN ('view', 'click')"""
_PAIRS = f"""SELECT subject_id, condition, band, CONCAT('_pair_', ca, '_', cb) AS channel, 'coupling' AS metric, {r('weight')} AS value FROM graph UNION ALL SELECT subject_id, condition, band, CONCAT('_hub_', u), 'strength', {r('SUM(weight)')} FROM sym GROUP BY subject_id, condition, band, u
 UNION ALL SELECT subject_id, condition, band, '_graph', 'mean_weight', {r('AVG(weight)')} FROM kept GROUP BY subject_id, condition, band"""
PAIR_ROWS = f"WITH {GRAPH} {_PAIRS}"


def _whole(source: str, unit: str, size: int, step: int, bins: str) -> str:
    """Demeaned, tapered DFT of whole segments as sums of cosines. source: a view (unit, t_idx, v); bins: a select of k."""
    return f"""seg0 AS (SELECT {unit}, g.s AS segment, t_idx - g.s * {step} AS i, v FROM {source} q, range(0, 1 + t_idx // {step}) AS g(s) WHERE t_idx - g.s * {step} < {size}),
whole AS (SELECT {unit}, segment FROM seg0 GROUP BY ALL HAVING count(*) = {size}),
seg AS (SELECT {unit}, segment, i, (v - avg(v) OVER (PARTITION BY {unit}, segment)) * (0.5 - 0.5 * cos(2 * pi() * i / {size})) AS x FROM seg0 JOIN whole USING ({unit}, segment)),
four AS (SELECT {unit}, segment, k, sum(x * cos(2 * pi() * ((k * i) % {size}) / {size})) AS re, sum(x * sin(2 * pi() * ((k * i) % {size}) / {size})) AS im FROM seg, ({bins}) b GROUP BY ALL)"""


def _analytic(low: float, high: float, name: str) -> str:
    """Analytic hub signals in a band, bin by bin."""
    return f"""{name}_f AS (SELECT recording_id, hub, n, k, sum(v * cos(2 * pi() * ((k * t_idx) % n) / n)) AS re, -sum(v * sin(2 * pi() * ((k * t_idx) % n) / n)) AS im FROM (SELECT *, count(*) OVER (PARTITION BY recording_id, hub) AS n FROM hub_signal) h, range(0, 2000) AS g(k) WHERE k <= n // 2 AND k * {RATE} / n BETWEEN {low} AND {high} GROUP BY ALL),
{name} AS (SELECT recording_id, hub, t, 2 * sum(re * cos(2 * pi() * ((k * t) % n) / n) - im * sin(2 * pi() * ((k * t) % n) / n)) / any_value(n) AS re, 2 * sum(re * sin(2 * pi() * ((k * t) % n) / n) + im * cos(2 * pi() * ((k * t) % n) / n)) / any_value(n) AS im FROM {name}_f, range(0, 2000) AS g(t) WHERE t < n GROUP BY ALL)"""


_MI = f"""{_analytic(*PHASE, 'ph')}, {_analytic(*AMPLITUDE, 'am')},
both_ AS (SELECT DISTINCT recording_id, hub AS phase_hub, hub AS amplitude_hub FROM hub_signal UNION SELECT h.recording_id, c.key_, c.item FROM (SELECT DISTINCT recording_id, dataset, montage FROM hub_signal) h JOIN setting c ON c.name = 'coupled' AND c.dataset = h.dataset AND c.montage = h.montage),
pa AS (SELECT b.recording_id, b.phase_hub, b.amplitude_hub, floor((atan2(p.im, p.re) + pi()) / (2 * pi() / {BINS})) AS bin, avg(sqrt(a.re * a.re + a.im * a.im)) AS amp FROM both_ b JOIN ph p ON p.recording_id = b.recording_id AND p.hub = b.phase_hub JOIN am a ON a.recording_id = b.recording_id AND a.hub = b.amplitude_hub AND a.t = p.t GROUP BY ALL),
sh AS (SELECT *, amp / sum(amp) OVER (PARTITION BY recording_id, phase_hub, amplitude_hub) AS p FROM pa WHERE bin BETWEEN 0 AND {BINS - 1}),
mi AS (SELECT recording_id, phase_hub, amplitude_hub, (ln({BINS}) + sum(p * ln(p)) + ({BINS} - count(*)) * {num(1e-12)} * ln({num(1e-12)})) / ln({BINS}) AS modulation FROM sh WHERE p > 0 GROUP BY ALL)"""
_RANGE = f"SELECT k FROM range({int(0.5 * SIZE / RATE)}, {int(50 * SIZE / RATE) + 1}) AS g(k)"
_NORM = f"(2 / ({RATE} * {3 * SIZE / 8}))"
_GKEYS = "subject_id, condition, band"
#: Shortest paths by min-plus squaring: five turns reach 32 steps, more than 19 nodes need.
_PATHS = ", ".join(f"d{i + 1} AS (SELECT {_GKEYS}, u, v, min(d) AS d FROM (SELECT * FROM d{i} UNION ALL SELECT a.subject_id, a.condition, a.band, a.u, b.v, a.d + b.d FROM d{i} a JOIN d{i} b ON b.subject_id = a.subject_id AND b.condition = a.condition AND b.band = a.band AND b.u = a.v WHERE a.u <> b.v) GROUP BY ALL)" for i in range(5))
_GRAPH_ROWS = f"""d0 AS (SELECT {_GKEYS}, u, v, weight AS d FROM sym), {_PATHS},
reach AS (SELECT {_GKEYS}, u, count(*) + 1 AS size FROM d5 GROUP BY ALL), core AS (SELECT {_GKEYS}, arg_min(u, (-size, u)) AS u0, max(size) AS m FROM reach GROUP BY ALL),
inside AS (SELECT {_GKEYS}, v AS node FROM d5 JOIN core USING ({_GKEYS}) WHERE u = u0 UNION SELECT {_GKEYS}, u0 FROM core),
len AS (SELECT d.subject_id, d.condition, d.band, sum(d.d) / (max(c.m) * (max(c.m) - 1)) AS value FROM d5 d JOIN core c USING ({_GKEYS}) JOIN inside i ON i.subject_id = d.subject_id AND i.condition = d.condition AND i.band = d.band AND i.node = d.u GROUP BY ALL),
top AS (SELECT {_GKEYS}, max(weight) AS w FROM sym GROUP BY ALL), deg AS (SELECT {_GKEYS}, u, count(*) AS k FROM sym GROUP BY ALL),
tri AS (SELECT a.subject_id, a.condition, a.band, a.u, sum(cbrt(a.weight * b.weight * c.weight) / t.w) AS s FROM sym a JOIN sym b ON b.subject_id = a.subject_id AND b.condition = a.condition AND b.band = a.band AND b.u = a.v JOIN sym c ON c.subject_id = a.subject_id AND c.condition = a.condition AND c.band = a.band AND c.u = b.v AND c.v = a.u JOIN top t ON t.subject_id = a.subject_id AND t.condition = a.condition AND t.band = a.band GROUP BY ALL),
clu AS (SELECT {_GKEYS}, avg(CASE WHEN k > 1 THEN coalesce(s, 0) / (k * (k - 1)) ELSE 0 END) AS value FROM deg LEFT JOIN tri USING ({_GKEYS}, u) GROUP BY ALL)"""

_EFFICIENCY = f"eff AS (SELECT b.subject_id, b.condition, b.band, sum(1.0 / b.hops) / any_value(n.n * (n.n - 1)) AS value FROM hop b JOIN (SELECT {_GKEYS}, count(DISTINCT u) AS n FROM sym GROUP BY ALL) n USING ({_GKEYS}) GROUP BY ALL)"
_HOPS = ", ".join(f"h{i + 1} AS (SELECT {_GKEYS}, u, v, min(d) AS d FROM (SELECT * FROM h{i} UNION ALL SELECT a.subject_id, a.condition, a.band, a.u, b.v, a.d + b.d FROM h{i} a JOIN h{i} b ON b.subject_id = a.subject_id AND b.condition = a.condition AND b.band = a.band AND b.u = a.v WHERE a.u <> b.v) GROUP BY ALL)" for i in range(5))

#: Counts of shortest paths by their number of edges, and what of them goes through each node.
_LEVELS = ", ".join(f"p{i + 1} AS (SELECT p.subject_id, p.condition, p.band, p.s, e.v, sum(p.c) AS c FROM p{i} p JOIN sym e ON e.subject_id = p.subject_id AND e.condition = p.condition AND e.band = p.band AND e.u = p.v JOIN dz a ON a.subject_id = p.subject_id AND a.condition = p.condition AND a.band = p.band AND a.u = p.s AND a.v = p.v JOIN dz b ON b.subject_id = p.subject_id AND b.condition = p.condition AND b.band = p.band AND b.u = p.s AND b.v = e.v WHERE e.v <> p.s AND abs(a.d + e.weight - b.d) < 1e-9 GROUP BY ALL)" for i in range(18))
_NODE = f"SELECT DISTINCT {_GKEYS}, u FROM sym"
_BETWEEN = f"""dz AS (SELECT {_GKEYS}, u, v, d FROM d5 UNION ALL SELECT {_GKEYS}, u, u, 0 FROM ({_NODE})), p0 AS (SELECT {_GKEYS}, u AS s, u AS v, 1.0 AS c FROM ({_NODE})), {_LEVELS},
sg AS (SELECT {_GKEYS}, s, v, sum(c) AS c FROM ({' UNION ALL '.join(f'SELECT * FROM p{i}' for i in range(1, 19))}) GROUP BY ALL),
thru AS (SELECT a.subject_id, a.condition, a.band, a.v AS node, sum(x.c * y.c / z.c) AS share FROM d5 a JOIN d5 b ON b.subject_id = a.subject_id AND b.condition = a.condition AND b.band = a.band AND b.u = a.v AND b.v <> a.u JOIN d5 c ON c.subject_id = a.subject_id AND c.condition = a.condition AND c.band = a.band AND c.u = a.u AND c.v = b.v
 JOIN sg x ON x.subject_id = a.subject_id AND x.condition = a.condition AND x.band = a.band AND x.s = a.u AND x.v = a.v JOIN sg y ON y.subject_id = a.subject_id AND y.condition = a.condition AND y.band = a.band AND y.s = b.u AND y.v = b.v JOIN sg z ON z.subject_id = a.subject_id AND z.condition = a.condition AND z.band = a.band AND z.s = a.u AND z.v = b.v WHERE abs(a.d + b.d - c.d) < 1e-9 GROUP BY ALL),
size_ AS (SELECT {_GKEYS}, count(*) AS n FROM ({_NODE}) GROUP BY ALL), bt AS (SELECT {_GKEYS}, max(share) AS share FROM thru GROUP BY ALL)"""
_PLACES = "place AS (SELECT CAST(s_nationkey AS BIGINT) AS recording_id, concat('E', s_suppkey) AS channel, s_suppkey % 7 AS x, s_suppkey % 5 AS y, s_suppkey % 3 AS z FROM supplier)"
_TARGETS = [("Fz", 1, 1, 1), ("Cz", 3, 2, 1), ("Pz", 5, 3, 2)]
_GREEDY = ", ".join(
    f"m{i} AS (SELECT recording_id, '{t}' AS target, arg_min(channel, (d, channel)) AS channel, min(d) AS distance FROM (SELECT recording_id, channel, sqrt((x - {a}) ** 2 + (y - {b}) ** 2 + (z - {c}) ** 2) AS d FROM place p WHERE TRUE {' '.join(f'AND NOT EXISTS (SELECT 1 FROM m{j} q WHERE q.recording_id = p.recording_id AND q.channel = p.channel)' for j in range(i))}) GROUP BY recording_id)"
    for i, (t, a, b, c) in enumerate(_TARGETS)
)

ORACLES = {
    "c9_graph_metrics": f"""WITH {GRAPH}, {_GRAPH_ROWS}, h0 AS (SELECT {_GKEYS}, u, v, 1 AS d FROM sym), {_HOPS}, hop AS (SELECT {_GKEYS}, u, v, d AS hops FROM h5), {_EFFICIENCY}, {_BETWEEN}
SELECT s.subject_id, s.condition, s.band, s.n AS n_nodes, {r('e.value')} AS efficiency, {r('l.value')} AS path_length, {r('c.value')} AS clustering, {r('CASE WHEN s.n > 2 THEN coalesce(b.share, 0) / ((s.n - 1) * (s.n - 2)) ELSE 0 END')} AS max_betweenness
FROM size_ s JOIN eff e USING ({_GKEYS}) JOIN len l USING ({_GKEYS}) JOIN clu c USING ({_GKEYS}) LEFT JOIN bt b USING ({_GKEYS})""",
    "c12_analytic_signal": f"""WITH f AS (SELECT channel, epoch, k, sum(v * cos(2 * pi() * ((k * t_idx) % 64) / 64)) AS re, -sum(v * sin(2 * pi() * ((k * t_idx) % 64) / 64)) AS im FROM epochs, range(4, 14) AS g(k) GROUP BY ALL),
y AS (SELECT channel, epoch, CAST(t AS INT) AS t_idx, sum(re * cos(2 * pi() * ((k * t) % 64) / 64) - im * sin(2 * pi() * ((k * t) % 64) / 64)) / 32 AS re, sum(re * sin(2 * pi() * ((k * t) % 64) / 64) + im * cos(2 * pi() * ((k * t) % 64) / 64)) / 32 AS im FROM f, range(0, 64) AS g(t) GROUP BY ALL)
SELECT channel, epoch, t_idx, {r('atan2(im, re)')} AS phase, {r('sqrt(re * re + im * im)')} AS amplitude FROM y""",
    "j12_greedy_electrodes": f"WITH {_PLACES}, {_GREEDY} SELECT recording_id, target, channel, {r('distance')} AS distance FROM ({' UNION ALL '.join(f'SELECT * FROM m{i}' for i in range(len(_TARGETS)))})",
    "k2_welch": f"WITH {DFT} SELECT channel, k, {r('AVG(re * re + im * im)')} AS power FROM spec GROUP BY channel, k",
    "c2_coherence": f"WITH {DFT} SELECT ca, cb, band, {r('coh')} AS coh, {r('dwpli')} AS dwpli, {r('imcoh')} AS imcoh FROM edge",
    "c4_volume_conduction": f"WITH {DFT} SELECT ca, cb, band, coh > 0.6 AND dwpli < 0.1 AS suspect FROM edge",
    "c5_node_strength": f"WITH {DFT} SELECT channel, band, {r('SUM(coh)')} AS strength FROM (SELECT ca AS channel, band, coh FROM edge UNION ALL SELECT cb, band, coh FROM edge) q GROUP BY channel, band",
    "k2_segments": f"WITH {_whole('samples', 'recording_id, channel', SIZE, STEP, _RANGE)} SELECT recording_id, channel, k * {RATE / SIZE} AS freq, (round(1e6 * {_NORM} * avg(re * re + im * im) + {num(1.23e-8)}, 6) + 0.0) AS psd_millionths, count(*) AS n_segments FROM four GROUP BY recording_id, channel, k",
    "q3_line_noise": f"""WITH {_whole('sensed', 'recording_id, dataset, montage, channel', SIZE, STEP, f'SELECT k FROM range({int(49 * SIZE / RATE)}, {int(61 * SIZE / RATE) + 1}) AS g(k)')},
lim AS (SELECT dataset, montage, max(CASE WHEN name = 'line_freq' THEN value END) AS f, max(CASE WHEN name = 'line_width' THEN value END) AS w, max(CASE WHEN name = 'line_z' THEN value END) AS most FROM setting GROUP BY ALL),
spec AS (SELECT recording_id, dataset, montage, channel, k, avg(re * re + im * im) AS power FROM four GROUP BY ALL),
p AS (SELECT recording_id, channel, any_value(f) AS line_freq, any_value(most) AS most, avg(power) AS power FROM spec JOIN lim USING (dataset, montage) WHERE abs(k * {RATE / SIZE} - f) <= w GROUP BY recording_id, channel),
z AS (SELECT *, (power - avg(power) OVER w) / nullif(stddev_pop(power) OVER w, 0) AS z FROM p WINDOW w AS (PARTITION BY recording_id))
SELECT recording_id, channel, line_freq, {r('power')} AS power, {r('z')} AS z, coalesce(z > most, false) AS noisy FROM z""",
    "c11_modulation_index": f"WITH {_MI} SELECT recording_id, phase_hub, amplitude_hub, {r('modulation')} AS modulation FROM mi",
    "j17_segments": f"""WITH iv AS ({CONDITIONS}), ends AS (SELECT recording_id, max(t_idx) AS last FROM samples GROUP BY recording_id),
c AS (SELECT iv.*, greatest(start, 0) AS s0, least(stop, last / 64.0) AS s1 FROM iv JOIN ends USING (recording_id)),
k AS (SELECT *, CAST(ceil(s0 * 64) AS BIGINT) AS a, CAST(floor(s1 * 64) AS BIGINT) AS b FROM c WHERE s1 - s0 >= 5),
o AS (SELECT *, row_number() OVER w - 1 AS segment, coalesce(sum(b - a + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k WINDOW w AS (PARTITION BY recording_id, condition ORDER BY a, b, start, stop))
SELECT recording_id, condition, channel, segment, count(*) AS n, CAST(min(before + t_idx - a) AS BIGINT) AS first_t, CAST(max(before + t_idx - a) AS BIGINT) AS last_t, min(t_idx) AS first_source, max(t_idx) AS last_source, {r('sum(v)')} AS total, {r('sum(v * (before + t_idx - a))')} AS moment
FROM o JOIN samples USING (recording_id) WHERE t_idx BETWEEN a AND b GROUP BY recording_id, condition, channel, segment""",
    "c13_long_connectivity": f"""WITH {GRAPH}, {_MI}, {_GRAPH_ROWS}, h0 AS (SELECT {_GKEYS}, u, v, 1 AS d FROM sym), {_HOPS}, hop AS (SELECT {_GKEYS}, u, v, d AS hops FROM h5), {_EFFICIENCY}
{_PAIRS}
UNION ALL SELECT subject_id, condition, band, '_graph', 'global_efficiency', {r('value')} FROM eff UNION ALL SELECT subject_id, condition, band, '_graph', 'char_path_length', {r('value')} FROM len UNION ALL SELECT subject_id, condition, band, '_graph', 'clustering', {r('value')} FROM clu
UNION ALL SELECT recording_id, 'eo', 'ThetaGamma', CASE WHEN phase_hub = amplitude_hub THEN CONCAT('_hub_', phase_hub) ELSE CONCAT('_pac_', phase_hub, '__', amplitude_hub) END, 'pac_mi', {r('modulation')} FROM mi""",
}
QUERIES = {
    "c9_graph_metrics": graphs, "c12_analytic_signal": analytic, "j12_greedy_electrodes": electrodes,
    "k2_welch": welch_epochs, "c2_coherence": coherence, "c4_volume_conduction": volume_conduction, "c5_node_strength": node_strength, "k2_segments": welch_segments, "q3_line_noise": line_noise,
    "c11_modulation_index": modulation, "j17_segments": segments, "c13_long_connectivity": long_connectivity,
}
