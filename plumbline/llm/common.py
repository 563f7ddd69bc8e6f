"""Plan helpers shared by the corpus operators: shared folders, size-checked joins, connected components."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import ship

#: Ids that may be broadcast: 8 bytes each, so 4 MB at most; beyond it both sides are shuffled.
BROADCAST_IDS = 500_000
#: Rows in an Arrow batch: bounds what a Python worker holds of long texts.
BATCH_ROWS = 1_000
BATCH_BYTES = 8_000_000
#: Rows of a few longs that a task may well write alone.
TASK_ROWS = 200_000


def prepare(spark: SparkSession) -> None:
    """Make sure of a shared checkpoint folder (the cluster's if it names one) and bounded Arrow batches (kept for the session: plans run later)."""
    ship(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(shared)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory of this Python worker to the system: workers are reused, and what they keep adds to the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, *by: str, size: int | None = None) -> DataFrame:
    """Cut the lineage with a compressed table in the shared checkpoint folder. size: rows at most, if known; few rows make few tasks.

    It is much smaller there than a checkpoint, and its size is known anew: a checkpoint keeps the estimate of its plan, which
    squares with each join of a loop until planning takes minutes.
    """
    spark = rows.sparkSession
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"
    rows = rows if size is None else rows.coalesce(1 + size // TASK_ROWS)
    rows.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    out = spark.read.schema(rows.schema).parquet(path)
    out._stored_at = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete stored tables whose successors are stored; others are left alone."""
    for rows in tables:
        path = getattr(rows, "_stored_at", None)
        if path:
            at = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def named(docs: DataFrame, *columns: str) -> DataFrame:
    """(doc, h1, h2): each row as a struct, so that no name clashes, with 128 bits of hash of the given columns as its name."""
    back = [F.col("doc")[c] for c in reversed(columns)]
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")).withColumns({"h1": F.xxhash64(*(F.col("doc")[c] for c in columns)), "h2": F.xxhash64(F.lit(1), *back)})


def semi(rows: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key is among ids (distinct, counted): by broadcast if they are few, else by a shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, "left_semi")


def anti(rows: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key is not among ids (distinct, counted): by broadcast if they are few, else by a shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, key, "left_anti")


def small_join(rows: DataFrame, other: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Join with a stored table of one row a key: by broadcast if it has few rows, else by a shuffle."""
    few = other.count() <= BROADCAST_IDS // 4
    return rows.join(F.broadcast(other) if few else other, key, how)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges, for nodes that have any.

    Each round every node hooks on the neighbour of least hash (a random order, so chains shrink by a
    constant share), and edges are rewritten between the hooked nodes until none is left. A node with very
    many edges only meets partial aggregations and joins that Spark can split. Tables have as many tasks as their rows need.
    """
    spark = edges.sparkSession
    link = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    n = link.count()
    if not n:
        return spark.createDataFrame([], "node bigint, component bigint")

    def join(rows: DataFrame, hook: DataFrame, key: str, how: str = "inner") -> DataFrame:
        return rows.join(F.broadcast(hook) if 2 * n <= BROADCAST_IDS // 4 else hook, key, how)

    steps, left = [], n
    while left:
        both = link.union(link.select("b", "a"))
        near = F.min(F.struct(F.xxhash64("b").alias("r"), F.col("b").alias("v"))).alias("m")
        hook = stored(both.groupBy("a").agg(near).select("a", F.least("m", F.struct(F.xxhash64("a").alias("r"), F.col("a").alias("v")))["v"].alias("to")), size=2 * left)
        steps.append(hook)
        moved = join(join(link, hook.select(F.col("a"), F.col("to").alias("ta")), "a"), hook.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b")
        before, link = link, stored(moved.select(F.col("ta").alias("a"), F.col("tb").alias("b")).where("a <> b").distinct(), size=left)
        release(before)
        left = link.count()
    nodes = steps[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for hook in steps[1:]:
        nodes = join(nodes, hook.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    nodes = stored(nodes, size=2 * n)
    least = nodes.groupBy("root").agg(F.min("node").alias("component"))
    out = stored(join(nodes, least, "root").select("node", "component"), size=2 * n)
    release(link, nodes, *steps)
    return out
