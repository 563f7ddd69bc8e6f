"""Datasets of recordings as relations: a data source of manifests, rules that name conditions, phenotype tables, a store with resume.

`recordings` is a Python data source: spark.read.format("recordings").option("path", folder).option("dataset", name).load() gives the files below
the folder with the entities of their names (dataset, subject, session, task, run, suffix, stem, path, length). Folders of
subjects are its partitions; filters on subject, session and task by equality or lists are taken over, so
other subjects' folders are not listed. The folder must be visible to the driver and all executors under one path (a mounted
store); for stores that only Spark reads, sources.io.read_manifest gives the same entities.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from plumbline.session import ship

MANIFEST = "dataset string, subject string, session string, task string, run int, suffix string, stem string, path string, length bigint"
ENTITIES = {"subject": "sub", "session": "ses", "task": "task"}


def entities(stem: str) -> dict[str, str | None]:
    found = {name: re.search(rf"(?:^|_){key}-([A-Za-z0-9]+)", stem) for name, key in ENTITIES.items()}
    return {name: m[1] if m else None for name, m in found.items()}


class Folder(InputPartition):
    def __init__(self, path: str, deep: bool) -> None:
        super().__init__(path)
        self.path, self.deep = path, deep


class RecordingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"].removeprefix("file://")
        self.dataset = options.get("dataset", os.path.basename(self.root.rstrip("/")))
        self.suffixes = tuple(s for s in options.get("suffixes", "").split(",") if s)
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else set()
            if name in ENTITIES and all(isinstance(v, str) for v in values):
                self.wanted[name] = self.wanted[name] & values if name in self.wanted else values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """A folder for each subject, and the root's own files."""
        subjects = sorted(e.name for e in os.scandir(self.root) if e.is_dir())
        only = self.wanted.get("subject")
        kept = [s for s in subjects if only is None or not s.startswith("sub-") or s.removeprefix("sub-") in only]
        return [Folder(self.root, False), *(Folder(os.path.join(self.root, s), True) for s in kept)]

    def read(self, partition: Folder) -> Iterator[tuple]:
        for top, folders, names in os.walk(partition.path):
            folders.sort()
            for name in sorted(names):
                stem, suffix = os.path.splitext(name)
                if self.suffixes and suffix not in self.suffixes:
                    continue
                found = entities(stem)
                if found["subject"] is None:
                    near = re.search(r"sub-([A-Za-z0-9]+)", top)
                    found["subject"] = near[1] if near else None
                if all(found[k] in v for k, v in self.wanted.items()):
                    run = re.search(r"_run-(\d+)", stem)
                    path = os.path.join(top, name)
                    yield self.dataset, found["subject"], found["session"], found["task"], int(run[1]) if run else None, suffix, stem, path, os.path.getsize(path)
            if not partition.deep:
                break


class Recordings(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recordings"

    def schema(self) -> str:
        return MANIFEST

    def reader(self, schema) -> RecordingReader:
        return RecordingReader(self.options)


def manifest(spark: SparkSession, folders: dict[str, str], suffixes: tuple[str, ...] = ()) -> DataFrame:
    """The recordings of several datasets (name: folder) in one relation; a filter on subject reaches every folder."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Recordings)
    out = None
    for name, path in folders.items():
        rows = spark.read.format("recordings").option("path", path).option("dataset", name).option("suffixes", ",".join(suffixes)).load()
        out = rows if out is None else out.unionAll(rows)
    return out


# How datasets name conditions in files. Of a dataset's rules the first that meets the name decides; 'split' is a recording of both.
# Kinds: upper and lower look for the text in the name of that case, token for a part between underscores, task for the whole task label.
RULES = [
    ("lemon", 0, "upper", "EC", "ec"), ("lemon", 1, "upper", "EO", "eo"),
    ("mipdb", 0, "upper", "EC", "ec"), ("mipdb", 1, "upper", "EO", "eo"), ("mipdb", 2, "upper", "REST", "eo"),
    ("hbn", 0, "upper", "RESTINGSTATE", "split"), ("hbn", 1, "upper", "RESTING_STATE", "split"), ("hbn", 2, "upper", "EC", "ec"), ("hbn", 3, "upper", "EO", "eo"), ("hbn", 4, "upper", "REST", "split"),
    ("dortmund", 0, "lower", "eyesopen", "eo"), ("dortmund", 1, "lower", "resteo", "eo"), ("dortmund", 2, "lower", "_eo_", "eo"), ("dortmund", 3, "lower", "eyesclosed", "ec"), ("dortmund", 4, "lower", "restec", "ec"), ("dortmund", 5, "lower", "_ec_", "ec"), ("dortmund", 6, "token", "EO", "eo"), ("dortmund", 7, "token", "EC", "ec"),
    ("trt", 0, "task", "eyesopen", "eo"), ("trt", 1, "task", "eyesclosed", "ec"),
]
RULE = "dataset string, priority int, kind string, pattern string, condition string"


def condition_rules(spark: SparkSession, rules: list[tuple] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, RULE)


def classify(names: DataFrame, rules: DataFrame, name: str = "stem", dataset: str = "dataset") -> DataFrame:
    """names with a condition by the rules of their dataset; null where none meets, or where the dataset has none.

    A dataset's rules are one row (an array in order), so the join is one lookup and no row is doubled.
    """
    packed = rules.groupBy(F.col("dataset").alias("_dataset")).agg(F.array_sort(F.collect_list(F.struct("priority", "kind", "pattern", "condition"))).alias("_rules"))
    n = F.coalesce(F.col(name), F.lit(""))
    task = F.regexp_extract(n, "task-([A-Za-z0-9]+)", 1)

    def meets(rule: Column) -> Column:
        k, p = rule["kind"], rule["pattern"]
        return F.when(k == "upper", F.contains(F.upper(n), p)).when(k == "lower", F.contains(F.lower(n), p)).when(k == "token", F.array_contains(F.split(F.upper(n), "_"), p)).otherwise(F.lower(task) == p)

    first = F.get(F.filter("_rules", meets), F.lit(0))["condition"]
    return names.join(F.broadcast(packed), names[dataset] == packed["_dataset"], "left").withColumn("condition", first).drop("_dataset", "_rules")


def read_phenotypes(spark: SparkSession, path: str, columns: dict[str, list[str]], sep: str = ",") -> DataFrame:
    """One table of the files below a folder: each column (its name, and names it goes by, the first that a file has) as a string; '#' lines are comments.

    Files are read with their own headers, as they may order and name their columns differently; empty texts and n/a are missing.
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), F.trim("value").alias("line")).where("line <> '' AND NOT startswith(line, '#')")
    # A file's header is its first line; it travels to the file's rows as one short text.
    head = lines.groupBy("file").agg(F.min(F.struct("at", "line")).alias("h")).select("file", F.col("h.at").alias("first"), F.transform(F.split(F.col("h.line"), re.escape(sep)), lambda c: F.lower(F.trim(F.replace(c, F.lit('"'), F.lit(""))))).alias("names"))
    rows = lines.join(F.broadcast(head), "file").where("at > first").withColumn("cells", F.from_csv("line", ", ".join(f"c{i} string" for i in range(MOST_COLUMNS)), {"sep": sep}))
    cells = F.array(*(F.col("cells")[f"c{i}"] for i in range(MOST_COLUMNS)))

    def value(names: list[str]) -> Column:
        at = [F.array_position("names", n.lower()) for n in names]
        found = F.coalesce(*(F.when(a > 0, F.trim(F.get(cells, (a - 1).cast("int")))) for a in at))
        return F.when(~F.lower(found).isin("", "n/a", "na", "nan"), found)

    return rows.select("file", *(value(names).alias(c) for c, names in columns.items()))


#: Columns that a phenotype file may have.
MOST_COLUMNS = 256


class UnitStore:
    """A table of results by unit (a subject, a recording) that a run can be stopped in and started again.

    Each batch of units is written to a folder of its own, and then noted in a manifest with one row a unit; only noted batches are read. So a
    batch that was cut off leaves nothing behind, a batch given twice replaces itself, and `pending` tells what is still to do.
    """

    def __init__(self, spark: SparkSession, path: str, unit: str = "unit") -> None:
        self.spark, self.path, self.unit = spark, path, unit

    def _there(self, name: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def done(self) -> DataFrame:
        """(unit, batch, status, detail) of the units that are stored or failed, the newest note of each."""
        kind = "unit string, batch string, status string, detail string"
        notes = self.spark.read.schema(kind).parquet(f"{self.path}/done") if self._there("done") else self.spark.createDataFrame([], kind)
        return notes.groupBy("unit").agg(F.max_by(F.struct("batch", "status", "detail"), "batch").alias("x")).select("unit", "x.*")

    def pending(self, units: DataFrame, retry: bool = False) -> DataFrame:
        """Units (in column `unit`) not yet stored; failed ones too with retry."""
        over = self.done().where("true" if not retry else "status = 'ok'").select(F.col("unit").alias(self.unit))
        return units.join(over, self.unit, "left_anti")

    def append(self, batch: str, rows: DataFrame, units: DataFrame, failed: DataFrame | None = None) -> None:
        """Store a batch's rows and then note its units; failed: (unit, detail). Batches are named in the order of their names."""
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch}")
        bad = failed if failed is not None else self.spark.createDataFrame([], "unit string, detail string")
        bad = bad.select(F.col("unit").cast("string"), F.lit(batch).alias("batch"), F.lit("failed").alias("status"), "detail")
        good = units.select(F.col(self.unit).cast("string").alias("unit")).distinct().join(bad.select("unit"), "unit", "left_anti")
        notes = good.select("unit", F.lit(batch).alias("batch"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("detail")).unionAll(bad)
        notes.write.mode("overwrite").parquet(f"{self.path}/done/part={batch}")

    def read(self) -> DataFrame:
        """The rows of units whose newest note is ok, each from that note's batch."""
        rows = self.spark.read.parquet(f"{self.path}/rows")
        ok = self.done().where("status = 'ok'").select(F.col("unit").alias("_unit"), F.col("batch").alias("_batch"))
        return rows.join(ok, (rows[self.unit].cast("string") == ok["_unit"]) & (rows["batch"].cast("string") == ok["_batch"]), "left_semi").drop("batch")
