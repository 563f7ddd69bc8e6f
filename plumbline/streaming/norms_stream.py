"""Incremental ingestion of long metrics and refresh of the norm cells that new rows touch.

Exact percentiles do not merge, so a refresh recomputes the touched cells from the stored rows. Each micro-batch appends its
rows to one parquet store, split by batch, condition and channel (duplicates of subject and condition go), so a refresh lists one folder
and reads only the parts that it touches. Rows without a usable value, files that cannot be read and records that cannot be parsed go to
quarantine folders, and a log has one row of counts for each batch. Touched cells are written under the batch's number; readers take the newest row of
each cell. A batch that is repeated after a failure replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from plumbline.plans import norms
from plumbline.sources import io

KEY = ["subject_id", "condition", "channel", "band", "metric"]
PARTS = ["condition", "channel"]
#: Names of folders that a filter may list; beyond it the join alone decides.
MOST_PARTS = 5_000
RECORD_ROWS = "subject_id string, age double, sex string, condition string, channel string, band string, metric string, value double"


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def absorb(spark: SparkSession, rows: DataFrame, store: str, number: int, bad_files: DataFrame | None = None) -> None:
    """Take in one batch of long rows: store the new ones, set bad ones aside, refresh the cells they touch, log the counts."""
    fine = F.col("value").isNotNull() & ~F.isnan("value") & F.col("subject_id").isNotNull()
    rows.where(~fine).write.mode("overwrite").parquet(f"{store}/quarantine/batch={number}")
    if bad_files is not None:
        bad_files.write.mode("overwrite").parquet(f"{store}/unreadable/batch={number}")
    new = rows.where(fine).dropDuplicates(KEY)
    done = seen(spark, store, rows.schema, number)
    if done is not None:
        new = new.join(done.select(*KEY), KEY, "left_anti")
    at = f"{store}/rows/batch={number}"
    new.write.mode("overwrite").partitionBy(*PARTS).parquet(at)
    new = _stored(spark, store, rows.schema).where(F.col("batch") == number).drop("batch")
    everything = new if done is None else done.unionByName(new)
    touched = norms.fan_out(new).select(*norms.KEYS).distinct()
    cells = norms.norm_cells(touched_rows(everything, touched))
    cells.join(touched, norms.KEYS, "left_semi").write.mode("overwrite").parquet(f"{store}/cells/batch={number}")
    counts = [spark.read.parquet(f"{store}/quarantine/batch={number}").count(), spark.read.parquet(f"{store}/unreadable/batch={number}").count() if bad_files is not None else 0, new.count()]
    spark.createDataFrame([tuple(counts)], "n_bad_rows long, n_bad_files long, n_rows long").write.mode("overwrite").parquet(f"{store}/log/batch={number}")


def ingest(spark: SparkSession, source: str, schema: StructType, store: str, checkpoint: str, one_pass: bool = True):
    """Start the stream from a folder of parquet files of long rows. one_pass: take what is there and stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    write = stream.writeStream.foreachBatch(lambda rows, number: absorb(spark, rows, store, number)).option("checkpointLocation", checkpoint)
    return (write.trigger(availableNow=True) if one_pass else write).start()


def ingest_records(spark: SparkSession, source: str, store: str, checkpoint: str, one_pass: bool = True, files: int = 100):
    """Start the stream from a folder of JSON records, one in each file. What is no record (cut off, binary, without a subject) is counted, not fatal; files of no bytes are not listed."""
    stream = spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.json").text(source).select(F.col("_metadata.file_path").alias("file"), "value")

    def batch(texts: DataFrame, number: int) -> None:
        parsed = texts.select("file", F.from_json("value", f"{io.RECORD}, _corrupt_record string", {"mode": "PERMISSIVE"}).alias("r"))
        broken = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull() | F.col("r.subject_id").isNull()
        # Metrics of a record are short next to its text; null values are kept here, so that they are counted.
        rows = parsed.where(~broken).select("r.*").drop("_corrupt_record")
        for name, at in (("channel", "metrics"), ("band", "_bands"), ("metric", "_metrics")):
            rest = [c for c in rows.columns if c != at]
            rows = rows.select(*rest, F.explode(at).alias(name, {"channel": "_bands", "band": "_metrics", "metric": "value"}[name]))
        long = rows.select(*(c.split()[0] for c in RECORD_ROWS.split(", ")))
        absorb(spark, long, store, number, parsed.where(broken).select("file", F.col("r._corrupt_record").alias("text")))

    write = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (write.trigger(availableNow=True) if one_pass else write).start()


def touched_rows(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the cells to recompute: those whose condition, channel, band, metric and bin are touched in any sex."""
    keys = ["condition", "channel", "band", "metric"]
    some = touched.select("bin_lo", *keys).distinct()
    # Folders to read: conditions and channels are named by a montage, so there are hundreds of them, whatever the number of rows.
    for part in PARTS:
        names = [x[0] for x in touched.select(part).distinct().limit(MOST_PARTS + 1).collect()]
        if len(names) <= MOST_PARTS and None not in names:
            rows = rows.where(F.col(part).isin(names))
    binned = rows.withColumn("bin_lo", norms.age_bin()["bin_lo"])
    return binned.join(some, ["bin_lo", *keys], "left_semi").drop("bin_lo")


def _stored(spark: SparkSession, store: str, schema: StructType) -> DataFrame:
    """All stored rows with their batch; condition and channel are folders, so joins on them read only what they meet."""
    kind = StructType(list(schema.fields)).add("batch", "long")
    return spark.read.schema(kind).parquet(f"{store}/rows").select(*schema.names, "batch")


def seen(spark: SparkSession, store: str, schema: StructType, before: int) -> DataFrame | None:
    """Rows of earlier batches."""
    if not _there(spark, f"{store}/rows"):
        return None
    return _stored(spark, store, schema).where(F.col("batch") < before).drop("batch")


def newest_cells(spark: SparkSession, store: str) -> DataFrame:
    """The newest row of each cell."""
    rows = spark.read.parquet(f"{store}/cells")
    last = Window.partitionBy(*norms.KEYS).orderBy(F.desc("batch"))
    return rows.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k", "batch")


def batch_log(spark: SparkSession, store: str) -> DataFrame:
    """(batch, n_rows, n_bad_rows, n_bad_files) of every batch so far."""
    return spark.read.parquet(f"{store}/log")
