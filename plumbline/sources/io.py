"""Readers and writers of subject records, norm cells, participants, events and recording manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.fixtures import POINTS

RECORD = "subject_id string, age double, sex string, condition string, metrics map<string, map<string, map<string, double>>>"
CELL = (
    "bin string, bin_lo int, bin_hi int, sex string, condition string, channel string, band string, metric string, n long, mean double, sd double, log_mean double, log_sd double, log_transformed boolean, "
    "normality_p double, percentiles array<double>, ci_lower double, ci_upper double, pi_lower double, pi_upper double, skewness double, kurtosis double, transform_normalized boolean"
)


def number(c: Column) -> Column:
    """NaN is missing."""
    return F.when(~F.isnan(c), c)


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, corrupt rows) of a folder of JSON files, one record each or one a line."""
    rows = spark.read.schema(f"{RECORD}, _corrupt_record string").option("mode", "PERMISSIVE").option("multiLine", True).json(path).withColumn("_file", F.input_file_name())
    broken = F.col("_corrupt_record").isNotNull() | F.col("subject_id").isNull()
    return rows.where(~broken).drop("_corrupt_record", "_file"), rows.where(broken).select("_file", "_corrupt_record")


def merge_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Several sources with provenance; ids get the source's name before them if there is more than one."""
    out = None
    for name, rows in sources.items():
        prefix = "".join(c for c in name if c.isalnum())
        rows = rows.withColumn("source", F.lit(name)).withColumn("subject_id", F.concat(F.lit(prefix + "_"), F.col("subject_id").cast("string")) if len(sources) > 1 else F.col("subject_id"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def explode_metrics(records: DataFrame) -> DataFrame:
    """Nested metrics as long rows; null and NaN values go."""
    rest = [c for c in records.columns if c != "metrics"]
    rows = records.select(*rest, F.explode("metrics").alias("channel", "_bands")).select(*rest, "channel", F.explode("_bands").alias("band", "_metrics")).select(*rest, "channel", "band", F.explode("_metrics").alias("metric", "value"))
    return rows.where(F.col("value").isNotNull() & ~F.isnan("value"))


def nest_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Long rows as nested maps, a record for each value of the keys."""
    bands = rows.groupBy(*keys, "channel", "band").agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    channels = bands.groupBy(*keys, "channel").agg(F.map_from_entries(F.collect_list(F.struct("band", "m"))).alias("b"))
    return channels.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("channel", "b"))).alias("metrics"))


def category() -> Column:
    """A cell's category by its channel's prefix; the longer prefixes first."""
    c = F.col("channel")
    out = F.lit("scalp")
    for prefix, name in [("_subject", "subject"), ("_pair_", "pair"), ("_graph", "graph"), ("_hub_", "hub"), ("_pac_", "pac"), ("_src_dk_", "source_dk"), ("_src_net_", "source_network"), ("_src_conn_", "source_connectivity"), ("_src_ba_", "source_ba"), ("_src_ba_conn_", "source_ba_connectivity")]:
        out = F.when(c.startswith(prefix), name).otherwise(out)
    return F.when(c.contains("/"), F.lit("asymmetry")).otherwise(out)


SPECTRUM = "recording_id string, channels array<string>, freqs array<double>, psd array<array<double>>"


def spectra_rows(spectra: DataFrame, channels: list[str], freqs: list[float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(long rows, recordings left out and why) of array spectra (recording_id, channels, freqs, psd by channel).

    Channels are aligned by name, in the order of `channels` (position); others go and missing ones have no rows. All recordings must
    have one frequency grid: the given one, or that of most recordings (the longer one of two). Another grid, or a matrix of another shape, is left out whole.
    """
    if freqs is None:
        first = spectra.where("freqs is not null").groupBy("freqs").count().orderBy(F.desc("count"), F.desc(F.size("freqs")), "freqs").select("freqs").first()
        freqs = list(first[0]) if first else []
    grid = F.array(*(F.lit(float(f)) for f in freqs)).cast("array<double>")
    near = F.coalesce((F.size("freqs") == len(freqs)) & F.forall(F.zip_with("freqs", grid, lambda a, b: F.abs(a - b) <= 1e-9), lambda ok: ok), F.lit(False))
    shape = F.coalesce((F.size("psd") == F.size("channels")) & F.forall("psd", lambda row: F.size(row) == F.size("freqs")), F.lit(False))
    why = F.when(~near, "grid").when(~shape, "shape")
    told = spectra.withColumn("reason", why)
    rows = told.where("reason is null").select("recording_id", "freqs", F.explode(F.arrays_zip("channels", "psd")).alias("x")).select("recording_id", F.col("x.channels").alias("channel"), F.explode(F.arrays_zip("freqs", F.col("x.psd").alias("psd"))).alias("y"))
    place = F.array_position(F.array(*(F.lit(c) for c in channels)), F.col("channel"))
    long = rows.select("recording_id", "channel", (place - 1).cast("int").alias("position"), F.col("y.freqs").alias("freq"), number(F.col("y.psd")).alias("psd")).where("position >= 0")
    return long, told.where("reason is not null").select("recording_id", "reason")


def channel_vector(cells: DataFrame, channels: list[str], value: str = "mean", keys: tuple[str, ...] = ("bin", "sex", "condition", "band", "metric")) -> DataFrame:
    """(keys, vector): the cells' values in the order of channels, null where there is no cell."""
    at = cells.where(F.col("channel").isin(channels)).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("channel", value))).alias("m"))
    return at.select(*keys, F.array(*(F.col("m")[c] for c in channels)).alias("vector"))


def write_norms_json(cells: DataFrame, path: str) -> None:
    cells.write.mode("overwrite").json(path)


def read_norms_json(spark: SparkSession, path: str) -> DataFrame:
    """Cells with defaults where older files lack a field."""
    rows = spark.read.schema(CELL).json(path)
    return rows.withColumn("sex", F.coalesce("sex", F.lit("pooled"))).withColumn("log_transformed", F.coalesce("log_transformed", F.lit(False)))


def write_norms_csv(cells: DataFrame, path: str) -> None:
    """Percentiles as columns p0.5 to p99.5."""
    flat = [F.get("percentiles", F.lit(i)).alias(f"p{p}") for i, p in enumerate(POINTS)]
    cells.select(*(c for c in cells.columns if c != "percentiles"), *flat).write.mode("overwrite").csv(path, header=True)


def write_bundle(cells: DataFrame, path: str, params: dict) -> None:
    """Cells by category with a manifest that holds the hash of the parameters."""
    cells = cells.withColumn("category", category())
    cells.write.mode("overwrite").partitionBy("category").parquet(f"{path}/cells")
    listed = [F.array_sort(F.collect_set(c)).alias(f"{c}s") for c in ("band", "metric", "sex", "bin")]
    manifest = cells.groupBy("category").agg(F.count("*").alias("n_cells"), F.count_distinct("channel").alias("n_channels"), *listed)
    manifest.withColumn("params_sha256", F.sha2(F.lit(json.dumps(params, sort_keys=True)), 256)).write.mode("overwrite").json(f"{path}/manifest")


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """Cells of a bundle; columns that an older one lacks are null."""
    rows = spark.read.option("mergeSchema", True).parquet(f"{path}/cells")
    missing = [f.strip().split(" ", 1) for f in CELL.split(",") if f.strip().split(" ")[0] not in rows.columns]
    return rows.withColumns({n: F.lit(None).cast(t) for n, t in missing})


# Names of columns and codes of sexes in participant tables, by dialect; what a dialect lacks is that of 'bids'.
DIALECTS = {
    "bids": {"sep": "\t", "id": ["participant_id"], "age": ["age", "Age", "AGE"], "sex": ["sex", "Sex", "gender", "Gender"], "codes": {"1": "F", "2": "M"}, "decimal": "."},
    "lemon": {"sep": ",", "id": ["ID", "participant_id"], "age": ["Age", "age"], "sex": ["Gender_ 1=female_2=male", "Gender"], "codes": {"1": "F", "2": "M"}},
    "hbn": {"id": ["participant_id", "EID"], "age": ["age", "Age"], "sex": ["sex", "Sex"], "codes": {"0": "M", "1": "F"}},
    "german": {"sep": ";", "id": ["Proband", "participant_id"], "age": ["Alter"], "sex": ["Geschlecht"], "codes": {"m": "M", "w": "F"}, "decimal": ","},
}


def read_participants(spark: SparkSession, path: str, age_columns: tuple[str, ...] | None = None, sex_columns: tuple[str, ...] | None = None, dialect: str | dict = "bids") -> DataFrame:
    """participant_id, age (numbers or ranges' middles), sex (M, F or as it is) and all other columns as a map, in one of the DIALECTS or one of the caller's.

    Ranges are split at - or _; codes and words of sexes are the dialect's, else the first letter's; empty texts and n/a are missing.
    """
    how = DIALECTS["bids"] | (DIALECTS[dialect] if isinstance(dialect, str) else dialect)
    ids, ages, sexes = how["id"], list(age_columns or how["age"]), list(sex_columns or how["sex"])
    rows = spark.read.csv(path, sep=how["sep"], header=True)
    known = lambda c: F.when(~F.lower(F.trim(c)).isin("", "n/a", "na", "nan"), F.trim(c))
    first = lambda names: F.coalesce(*(known(F.col(f"`{n}`")) for n in names if n in rows.columns), F.lit(None).cast("string"))
    plain = lambda c: (F.replace(c, F.lit(how["decimal"]), F.lit(".")) if how["decimal"] != "." else c).try_cast("double")
    raw, sex = first(ages), first(sexes)
    ends = F.split(raw, "[-_]")
    age = F.coalesce(plain(raw), (plain(F.get(ends, F.lit(0))) + plain(F.get(ends, F.lit(1)))) / 2)
    low, clean = F.upper(sex), sex
    clean = F.when(low.startswith("M"), "M").when(low.startswith("F"), "F").otherwise(clean)
    for code, name in how["codes"].items():
        clean = F.when(F.lower(sex) == code, name).otherwise(clean)
    rest = [c for c in rows.columns if c not in (*ids, *ages, *sexes)]
    more = F.create_map(*(x for c in rest for x in (F.lit(c), F.col(f"`{c}`")))) if rest else F.create_map().cast("map<string, string>")
    return rows.select(first(ids).alias("participant_id"), number(age).alias("age"), clean.alias("sex"), more.alias("other"))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """onset, duration and label of an events table; rows without an onset go, a missing duration is 0."""
    rows = spark.read.csv(path, sep="\t", header=True)
    label = F.coalesce(*(F.nullif(F.trim(F.col(c)), F.lit("n/a")) for c in ("trial_type", "value", "description") if c in rows.columns), F.lit(None).cast("string"))
    duration = F.coalesce(F.col("duration").try_cast("double"), F.lit(0.0)) if "duration" in rows.columns else F.lit(0.0)
    return rows.select(F.col("onset").try_cast("double").alias("onset"), duration.alias("duration"), label.alias("label"), F.input_file_name().alias("file")).where("onset is not null")


def read_manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files of a folder with the entities of their names; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    entity = lambda k: F.nullif(F.regexp_extract(name, f"{k}-([A-Za-z0-9]+)", 1), F.lit(""))
    low = F.lower(name)
    condition = F.when(low.contains("open") | low.contains("_eo"), "eo").when(low.contains("closed") | low.contains("_ec"), "ec")
    return rows.select("path", "length", entity("sub").alias("subject"), entity("ses").alias("session"), entity("task").alias("task"), entity("run").try_cast("int").alias("run"), condition.alias("condition"))
