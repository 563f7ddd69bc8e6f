"""What a session needs before Python code of this package runs on executors, and tables that cut a plan's lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each context; they need not share the driver's folders."""
    context = spark.sparkContext
    if not getattr(context, "_plumbline_shipped", False):
        package = Path(__file__).resolve().parent
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/plumbline", "zip", package.parent, package.name))
        context._plumbline_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it names none (a local session), one of its own."""
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    if at.isDefined():
        return at.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


#: Whether Spark deletes a query's shuffle files when it ends; else they wait for the driver's garbage collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(rows: DataFrame) -> DataFrame:
    """rows as a table in the shared folder: computed once, however many branches of a plan read it, and there when an executor is lost.

    The shuffle files that it took are deleted when it is there, so that they don't add to those of the plans that read it.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        rows.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(path)
