"""Parameters as a relation: (dataset, montage, name, key, item, value, pos), joined by plans and never changed in place.

A row without a dataset or a montage holds for all of them. For each dataset and montage in use the rows of the most specific kind
win, name by name: those of the dataset and the montage, then of the dataset, then of the montage, then the general ones. Lists (the
channels of a hub, the pairs) are replaced whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.sources.fixtures import ANTERIOR, CHANNELS, HUBS, POSTERIOR, VIEWS, rows

# The 18 further channels of the large montage, its hubs, the homologous pairs, region groups and coupled hubs.
MORE_CHANNELS = ["AF3", "AF4", "FC3", "FC1", "FC2", "FC4", "FT7", "FT8", "CP3", "CP1", "CP2", "CP4", "TP7", "TP8", "PO3", "PO4", "P1", "P2"]
HUBS_37 = {
    "FP": ["Fp1", "Fp2"], "AF_L": ["AF3"], "AF_R": ["AF4"], "F_mid": ["Fz", "FC1", "FC2"], "F_L": ["F3", "F7", "FC3"], "F_R": ["F4", "F8", "FC4"], "C_mid": ["Cz"], "T_L": ["T3", "T5", "FT7", "TP7"],
    "T_R": ["T4", "T6", "FT8", "TP8"], "P_mid": ["Pz", "CP1", "CP2", "P1", "P2"], "P_L": ["P3", "CP3"], "P_R": ["P4", "CP4"], "PO_L": ["PO3"], "PO_R": ["PO4"], "O": ["O1", "O2"],
}
PAIRS = [("F3", "F4"), ("C3", "C4"), ("P3", "P4"), ("T3", "T4"), ("T5", "T6"), ("F7", "F8"), ("O1", "O2")]
MORE_PAIRS = [("AF3", "AF4"), ("FC3", "FC4"), ("FC1", "FC2"), ("FT7", "FT8"), ("CP3", "CP4"), ("CP1", "CP2"), ("TP7", "TP8"), ("PO3", "PO4"), ("P1", "P2")]
MORE_POSTERIOR, MORE_ANTERIOR, MORE_PEAK = ["PO3", "PO4", "P1", "P2"], ["AF3", "AF4", "FC1", "FC2"], ["PO3", "PO4"]
COUPLED = [("F_mid", "P_mid"), ("F_L", "T_L"), ("F_R", "T_R"), ("T_L", "P_mid"), ("F_mid", "T_L"), ("F_mid", "T_R")]
LINE_FREQ, LINE_FREQ_EU = 60.0, 50.0

COLUMNS = "dataset long, montage string, name string, key string, item string, value double, pos long"


def scalar(name: str, value: float, dataset: int | None = None, montage: str | None = None) -> tuple:
    return dataset, montage, name, None, None, float(value), 0


def listed(name: str, items: list, dataset: int | None = None, montage: str | None = None) -> list[tuple]:
    """items: names, or (key, name) pairs."""
    pairs = [x if isinstance(x, tuple) else (None, x) for x in items]
    return [(dataset, montage, name, key, item, None, k) for k, (key, item) in enumerate(pairs)]


def hub_items(hubs: dict[str, list[str]]) -> list[tuple[str, str]]:
    return [(hub, channel) for hub, channels in hubs.items() for channel in channels]


PARAMETERS = [
    scalar("line_freq", LINE_FREQ), scalar("line_freq", LINE_FREQ_EU, dataset=1), scalar("line_width", 1.0), scalar("line_z", 3.0),
    scalar("phase_low", 4.0), scalar("phase_high", 8.0), scalar("amplitude_low", 30.0), scalar("amplitude_high", 45.0), scalar("phase_bins", 18),
    scalar("peak_low", 7.0), scalar("peak_high", 14.0), scalar("typical_low", 9.0), scalar("typical_high", 11.0),
    *listed("channels", CHANNELS), *listed("channels", CHANNELS + MORE_CHANNELS, montage="37"),
    *listed("hubs", hub_items(HUBS)), *listed("hubs", hub_items(HUBS_37), montage="37"),
    *listed("pairs", PAIRS), *listed("pairs", PAIRS + MORE_PAIRS, montage="37"),
    *listed("posterior", POSTERIOR), *listed("posterior", POSTERIOR + MORE_POSTERIOR, montage="37"),
    *listed("anterior", ANTERIOR), *listed("anterior", ANTERIOR + MORE_ANTERIOR, montage="37"),
    *listed("peak_channels", POSTERIOR), *listed("peak_channels", POSTERIOR + MORE_PEAK, montage="37"),
    *listed("coupled", COUPLED),
    # Sensors of the given signals (their channel numbers 0 to 4) by montage.
    *listed("sensors", ["Fz", "F3", "T3", "Pz", "O1"]), *listed("sensors", ["FC1", "FC3", "T3", "CP1", "PO3"], montage="37"),
]


def parameters(spark: SparkSession, more: list[tuple] = ()) -> DataFrame:
    """The given parameters and further rows."""
    return spark.createDataFrame([*PARAMETERS, *more], COLUMNS)


def specificity(dataset: Column, montage: Column) -> Column:
    return 2 * dataset.isNotNull().cast("int") + montage.isNotNull().cast("int")


def resolve(relation: DataFrame, units: DataFrame) -> DataFrame:
    """The rows that hold for each unit (dataset, montage). units: as they are in use, repeats allowed; a null matches only general rows."""
    units = units.select("dataset", "montage").distinct()
    p = relation.withColumnsRenamed({"dataset": "_d", "montage": "_m"})
    meets = (F.col("_d").isNull() | (F.col("_d") == F.col("dataset"))) & (F.col("_m").isNull() | (F.col("_m") == F.col("montage")))
    # Both sides are a handful of rows; the join is by condition, as a missing key stands for all values.
    found = units.join(F.broadcast(p), meets).withColumn("_s", specificity(F.col("_d"), F.col("_m")))
    best = F.max("_s").over(Window.partitionBy("dataset", "montage", "name"))
    return found.withColumn("_best", best).where("_s = _best").select("dataset", "montage", "name", "key", "item", "value", "pos")


MONTAGE_VIEWS = {
    "parameters": rows(*PARAMETERS, names="t(dataset, montage, name, key_, item, value, pos)"),
    "worn": "SELECT subject_id, age, sex, dataset, CASE WHEN subject_id % 3 = 0 THEN '37' ELSE '19' END AS montage FROM subjects",
    "setting": """SELECT dataset, montage, name, key_, item, value, pos FROM (SELECT w.dataset, w.montage, p.name, p.key_, p.item, p.value, p.pos, CASE WHEN p.dataset IS NULL THEN 0 ELSE 2 END + CASE WHEN p.montage IS NULL THEN 0 ELSE 1 END AS s,
 MAX(CASE WHEN p.dataset IS NULL THEN 0 ELSE 2 END + CASE WHEN p.montage IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY w.dataset, w.montage, p.name) AS best
 FROM (SELECT DISTINCT dataset, montage FROM worn) w JOIN parameters p ON (p.dataset IS NULL OR p.dataset = w.dataset) AND (p.montage IS NULL OR p.montage = w.montage)) q WHERE s = best""",
    "montage_measured": """SELECT w.subject_id, w.age, w.sex, w.dataset, w.montage, CASE WHEN l_linestatus = 'O' THEN 'eo' ELSE 'ec' END AS condition, c.item AS channel, CASE l_returnflag WHEN 'A' THEN 'Alpha' WHEN 'N' THEN 'Beta' ELSE 'Theta' END AS band, l_extendedprice, l_discount
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN worn w ON w.subject_id = o_custkey JOIN setting c ON c.dataset = w.dataset AND c.montage = w.montage AND c.name = 'channels' AND c.pos = l_suppkey % CASE WHEN w.montage = '37' THEN 37 ELSE 19 END""",
    "montage_metrics": VIEWS["metrics"].replace("MAX(dataset) AS dataset,", "MAX(dataset) AS dataset, MAX(montage) AS montage,").replace("sex, dataset,", "sex, dataset, montage,", 1).replace("FROM measured", "FROM montage_measured"),
    # Recordings of 24 epochs in a row at 256 Hz, of five sensors each.
    "samples": "SELECT CAST(FLOOR(epoch / 24) AS BIGINT) AS recording_id, channel, (epoch % 24) * 64 + t_idx AS t_idx, v FROM epochs",
    "sensed": """SELECT e.recording_id, w.dataset, w.montage, c.item AS channel, e.t_idx, e.v FROM samples e JOIN worn w ON w.subject_id = e.recording_id JOIN setting c ON c.dataset = w.dataset AND c.montage = w.montage AND c.name = 'sensors' AND c.pos = e.channel""",
    "hub_signal": """SELECT s.recording_id, s.dataset, s.montage, h.key_ AS hub, s.t_idx, ROUND(AVG(s.v), 12) AS v FROM sensed s JOIN setting h ON h.dataset = s.dataset AND h.montage = s.montage AND h.name = 'hubs' AND h.item = s.channel GROUP BY s.recording_id, s.dataset, s.montage, h.key_, s.t_idx""",
}
