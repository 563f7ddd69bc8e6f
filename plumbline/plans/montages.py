"""Queries that read parameters by dataset and montage, as SQL that Spark and the oracle share."""

from __future__ import annotations

from plumbline.plans.catalog import r

_EXTRA = "extra AS (SELECT item FROM parameters WHERE name = 'channels' AND montage = '37' EXCEPT SELECT item FROM parameters WHERE name = 'channels' AND montage IS NULL)"
_GROUPS = "SUM(CASE WHEN g.name = '{0}' THEN 1 ELSE 0 END)"

QUERIES: dict[str, str] = {
    # All that holds for each dataset and montage, after overrides.
    "f4_settings": "SELECT dataset, montage, name, COUNT(*) AS n_items, MAX(value) AS value, COALESCE($JOIN(DISTINCT item), '') AS items, COUNT(DISTINCT key_) AS n_keys FROM setting GROUP BY dataset, montage, name",
    # The montage is told from the channels that are there; its region groups follow.
    "p20_montage": f"""WITH {_EXTRA}, seen AS (SELECT DISTINCT subject_id, dataset, channel FROM montage_metrics),
 told AS (SELECT s.subject_id, s.dataset, COUNT(*) AS n_channels, CASE WHEN COUNT(e.item) > 0 THEN '37' ELSE '19' END AS montage FROM seen s LEFT JOIN extra e ON e.item = s.channel GROUP BY s.subject_id, s.dataset)
 SELECT t.subject_id, MAX(t.n_channels) AS n_channels, t.montage, CAST({_GROUPS.format('posterior')} AS BIGINT) AS n_posterior, CAST({_GROUPS.format('anterior')} AS BIGINT) AS n_anterior, CAST({_GROUPS.format('peak_channels')} AS BIGINT) AS n_peak
 FROM told t JOIN seen s ON s.subject_id = t.subject_id LEFT JOIN setting g ON g.dataset = t.dataset AND g.montage = t.montage AND g.item = s.channel AND g.name IN ('posterior', 'anterior', 'peak_channels') GROUP BY t.subject_id, t.montage""",
    # Hub signals by the montage's hubs; hubs without a channel are zero.
    "c1_hub_signals": f"""WITH grid AS (SELECT t.recording_id, t.t_idx, h.hub FROM (SELECT DISTINCT recording_id, dataset, montage, t_idx FROM sensed) t JOIN (SELECT DISTINCT dataset, montage, key_ AS hub FROM setting WHERE name = 'hubs') h ON h.dataset = t.dataset AND h.montage = t.montage)
 SELECT g.recording_id, g.hub, g.t_idx, {r('COALESCE(s.v, 0)')} AS v FROM grid g LEFT JOIN hub_signal s ON s.recording_id = g.recording_id AND s.hub = g.hub AND s.t_idx = g.t_idx""",
    # All homologous pairs of the montage, 7 or 16.
    "k7_asymmetry": f"SELECT a.subject_id, a.montage, a.condition, a.band, p.key_ AS lft, p.item AS rgt, {r('CASE WHEN a.value + b.value > 0 THEN (b.value - a.value) / (a.value + b.value) ELSE 0 END')} AS asymmetry FROM montage_metrics a JOIN setting p ON p.name = 'pairs' AND p.dataset = a.dataset AND p.montage = a.montage AND p.key_ = a.channel JOIN montage_metrics b ON b.channel = p.item AND b.subject_id = a.subject_id AND b.condition = a.condition AND b.band = a.band AND b.metric = a.metric WHERE a.metric = 'absolute_power'",
    # Relative power over the montage's posterior and anterior channels, of cell means.
    "v3_posterior_ratio": f"""WITH cell AS (SELECT m.dataset, m.montage, b.bin, m.condition, m.channel, AVG(m.value) AS mean FROM montage_metrics m JOIN bins b ON m.age >= b.bin_lo AND m.age < b.bin_hi WHERE m.band = 'Alpha' AND m.metric = 'relative_power' GROUP BY m.dataset, m.montage, b.bin, m.condition, m.channel),
 side AS (SELECT c.dataset, c.montage, c.bin, c.condition, AVG(CASE WHEN g.name = 'posterior' THEN c.mean END) AS post, AVG(CASE WHEN g.name = 'anterior' THEN c.mean END) AS ant FROM cell c JOIN setting g ON g.dataset = c.dataset AND g.montage = c.montage AND g.item = c.channel AND g.name IN ('posterior', 'anterior') GROUP BY c.dataset, c.montage, c.bin, c.condition)
 SELECT dataset, montage, bin, condition, {r('post')} AS posterior, {r('ant')} AS anterior, {r('post / nullif(ant, 0)')} AS ratio, COALESCE(post / nullif(ant, 0) > 1, FALSE) AS ok FROM side WHERE post IS NOT NULL AND ant IS NOT NULL""",
}
