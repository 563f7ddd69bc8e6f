"""Views over the given tables in the shapes of the data model, as SQL that Spark and DuckDB share."""

from __future__ import annotations

# The 19 scalp channels in order, the adjacency of channels (neighbours in the order of CHANNELS), regions, bands and ratios.
CHANNELS = ["Fp1", "Fp2", "F7", "F3", "Fz", "F4", "F8", "T3", "C3", "Cz", "C4", "T4", "T5", "P3", "Pz", "P4", "T6", "O1", "O2"]
NEIGHBOURS = {
    "Fp1": ["Fp2", "F7", "F3"], "Fp2": ["Fp1", "F4", "F8"], "F7": ["Fp1", "F3", "T3"], "F3": ["Fp1", "F7", "Fz", "C3"], "Fz": ["F3", "F4", "Cz"], "F4": ["Fp2", "Fz", "F8", "C4"], "F8": ["Fp2", "F4", "T4"],
    "T3": ["F7", "C3", "T5"], "C3": ["F3", "T3", "Cz", "P3"], "Cz": ["Fz", "C3", "C4", "Pz"], "C4": ["F4", "Cz", "T4", "P4"], "T4": ["F8", "C4", "T6"], "T5": ["T3", "P3", "O1"], "P3": ["C3", "T5", "Pz", "O1"],
    "Pz": ["Cz", "P3", "P4"], "P4": ["C4", "Pz", "T6", "O2"], "T6": ["T4", "P4", "O2"], "O1": ["T5", "P3", "O2"], "O2": ["P4", "T6", "O1"],
}
POSTERIOR, ANTERIOR = ["P3", "Pz", "P4", "O1", "O2"], ["Fp1", "Fp2", "F3", "Fz", "F4"]
BANDS = {"Delta": (1.0, 4.0), "Theta": (4.0, 8.0), "Alpha": (8.0, 13.0), "Alpha1": (8.0, 10.5), "Alpha2": (10.5, 13.0), "Beta": (13.0, 30.0), "Beta1": (13.0, 15.0), "Beta2": (15.0, 18.0), "Beta3": (18.0, 25.0), "HighBeta": (25.0, 30.0), "Gamma": (30.0, 50.0)}
RATIOS = {
    "Theta/Beta": (["Theta"], ["Beta"]), "Theta/Beta1": (["Theta"], ["Beta1"]), "Delta/HighBeta": (["Delta"], ["HighBeta"]), "Alpha/HighBeta": (["Alpha"], ["HighBeta"]), "Alpha/Theta": (["Alpha"], ["Theta"]),
    "Delta/Alpha": (["Delta"], ["Alpha"]), "Alpha/Beta": (["Alpha"], ["Beta"]), "(Delta+Theta)/(Alpha+Beta)": (["Delta", "Theta"], ["Alpha", "Beta"]),
}
HUBS = {"F_mid": ["Fz"], "F_L": ["F3", "F7"], "F_R": ["F4", "F8"], "C_mid": ["Cz"], "T_L": ["T3", "T5"], "T_R": ["T4", "T6"], "P_mid": ["Pz"], "P_L": ["P3"], "P_R": ["P4"], "O": ["O1", "O2"]}
LOG_METRICS = ("absolute_power", "corrected_absolute_power", "gsf_absolute_power")
POINTS = [0.5, 1, 2.5, 5, 10, 25, 50, 75, 90, 95, 97.5, 99, 99.5]
EDGES = [20, 30, 40, 50, 60, 70, 80]


def rows(*values: tuple, names: str) -> str:
    """A small table as SQL. names: 'alias(column, ...)'."""
    one = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else repr(v)
    alias, _, columns = names.partition("(")
    columns = [c.strip() for c in columns.rstrip(")").split(",")]
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, v)) + ')' for v in values)}) AS {alias}({', '.join(columns)})"


_CHANNEL = "CASE " + " ".join(f"WHEN {{0}} = {i} THEN '{c}'" for i, c in enumerate(CHANNELS)) + " END"
_METRICS = [("absolute_power", "l_extendedprice"), ("corrected_absolute_power", "l_extendedprice * (1 - l_discount)"), ("relative_power", "l_discount")]
#: One aggregation with all averages, then a row for each. Averages keep nine decimals: the last bits depend on the order of sums.
_LONG = """SELECT subject_id, age, sex, dataset, {session}condition, channel, band, metric, CASE metric {cases} END AS value FROM (SELECT subject_id, MAX(age) AS age, MAX(sex) AS sex, MAX(dataset) AS dataset, {session}condition, channel, band, {averages}
 FROM measured GROUP BY subject_id, {session}condition, channel, band) g $EACH({names})"""
_PARTS = {"cases": " ".join(f"WHEN '{m}' THEN a{i}" for i, (m, _) in enumerate(_METRICS)), "averages": ", ".join(f"ROUND(AVG({v}), 9) AS a{i}" for i, (_, v) in enumerate(_METRICS)), "names": ", ".join(f"'{m}'" for m, _ in _METRICS)}

VIEWS = {
    "subjects": """SELECT c_custkey AS subject_id, CAST(15 + (c_custkey * 7) % 70 AS DOUBLE) + CASE WHEN c_custkey % 11 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS age,
 CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'F' WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN 'M' ELSE 'Other' END AS sex, c_nationkey % 2 AS dataset FROM customer""",
    "measured": f"""SELECT s.subject_id, s.age, s.sex, s.dataset, CASE WHEN l_linestatus = 'O' THEN 'eo' ELSE 'ec' END AS condition, {_CHANNEL.format("l_suppkey % 19")} AS channel,
 CASE l_returnflag WHEN 'A' THEN 'Alpha' WHEN 'N' THEN 'Beta' ELSE 'Theta' END AS band, CASE WHEN l_linenumber % 2 = 1 THEN 'session1' ELSE 'session2' END AS session, l_extendedprice, l_discount
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN subjects s ON s.subject_id = o_custkey""",
    "metrics": _LONG.format(session="", **_PARTS),
    "retest": _LONG.format(session="session, ", **_PARTS),
    "bins": rows(*((lo, hi, f"{lo}-{hi - 1}") for lo, hi in zip(EDGES[:-1], EDGES[1:], strict=True)), names="t(bin_lo, bin_hi, bin)"),
    "adjacency": rows(*((a, b) for a, bs in NEIGHBOURS.items() for b in bs), names="t(channel, neighbour)"),
    "bands": rows(*((n, lo, hi) for n, (lo, hi) in BANDS.items()), names="t(band, lo, hi)"),
    "ratios": rows(*((n, side, b) for n, (num, den) in RATIOS.items() for side, bs in (("num", num), ("den", den)) for b in bs), names="t(ratio, side, band)"),
    "hubs": rows(*((h, c) for h, cs in HUBS.items() for c in cs), names="t(hub, channel)"),
    "regions": rows(*((c, "posterior") for c in POSTERIOR), *((c, "anterior") for c in ANTERIOR), names="t(channel, region)"),
    "psd": "SELECT vec_id AS recording_id, CAST(pos AS DOUBLE) * CAST(0.78125 AS DOUBLE) AS freq, CAST(v AS DOUBLE) * CAST(v AS DOUBLE) AS psd FROM ($POS(embedding, embeddings, vec_id))",
    "spectra": f"""SELECT s.subject_id, s.age, s.sex, s.dataset, CASE WHEN p.recording_id % 2 = 0 THEN 'eo' ELSE 'ec' END AS condition, {_CHANNEL.format("p.recording_id % 5")} AS channel, CAST(p.freq AS VARCHAR(20)) AS band, 'log_psd' AS metric, ROUND(LOG10(GREATEST(p.psd, CAST(1e-30 AS DOUBLE)) * 1e12), 12) AS value
 FROM psd p JOIN subjects s ON s.subject_id = CAST(FLOOR(p.recording_id / 5) AS BIGINT) WHERE p.freq >= 0.5 AND p.freq <= 50""",
    "epochs": "SELECT vec_id % 5 AS channel, CAST(FLOOR(vec_id / 5) AS BIGINT) AS epoch, pos AS t_idx, CAST(v AS DOUBLE) AS v FROM ($POS(embedding, embeddings, vec_id))",
    "markers": """SELECT event_id, user_id AS recording_id, ($US(ts) - MIN($US(ts)) OVER (PARTITION BY user_id)) / CAST(1000000 AS DOUBLE) AS onset,
 CASE event_type WHEN 'view' THEN 'eo' WHEN 'click' THEN 'ec' WHEN 'signup' THEN 'boundary' END AS kind FROM events""",
    "signal": "SELECT event_type AS channel, CAST(FLOOR($US(ts) / 3600000000) AS BIGINT) AS win, value AS v, user_id AS recording_id FROM events WHERE value IS NOT NULL",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
