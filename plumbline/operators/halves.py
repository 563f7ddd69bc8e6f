"""Random halves of subjects, exact in size, and how well norm cells of the halves agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.plans.norms import age_bin
from plumbline.sources.fixtures import EDGES

SPLITS, SEED, LEAST_CELL, LEAST_CELLS, LEAST_METRIC = 10, 42, 3, 10, 5
LOW = 0.80
#: The metrics of the core subset.
CORE = ("relative_power", "corrected_absolute_power", "corrected_relative_power", "gsf_absolute_power", "gsf_relative_power", "aperiodic_exponent", "aperiodic_offset")
#: Leading hex digits of the hash that the histogram counts by.
DIGITS = 4
CELL = ["bin", "condition", "channel", "band", "metric"]


def halves(subjects: DataFrame, splits: int = SPLITS, seed: int = SEED) -> DataFrame:
    """(subject_id, first): for each subject an array that tells for each split whether it is in the first half (n // 2 subjects).

    Subjects are in the order of a hash of seed, split and id. A histogram of the hash's leading digits (65,536 counts a split) finds the bucket
    that the middle falls in; only that bucket's subjects are ranked, so no task sorts all subjects and halves are still exact.
    """
    people = subjects.select("subject_id").where("subject_id is not null").distinct()
    rows = people.select("subject_id", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"))
    rows = rows.withColumn("hash", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("split").cast("string"), F.col("subject_id").cast("string")))).withColumn("bucket", F.substring("hash", 1, DIGITS))
    counts = rows.groupBy("split", "bucket").count()
    upto = Window.partitionBy("split").orderBy("bucket")
    placed = counts.withColumns({"before": F.sum("count").over(upto) - F.col("count"), "half": F.floor(F.sum("count").over(Window.partitionBy("split")) / 2)})
    middle = placed.where((F.col("before") <= F.col("half")) & (F.col("half") < F.col("before") + F.col("count"))).select("split", F.col("bucket").alias("middle"), (F.col("half") - F.col("before")).alias("need"))
    rows = rows.join(F.broadcast(middle), "split")
    inside = rows.where("bucket = middle").withColumn("k", F.row_number().over(Window.partitionBy("split").orderBy("hash", "subject_id")))
    told = inside.select("subject_id", "split", (F.col("k") <= F.col("need")).alias("first")).unionAll(rows.where("bucket <> middle").select("subject_id", "split", (F.col("bucket") < F.col("middle")).alias("first")))
    return told.groupBy("subject_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("split", "first"))), lambda x: x["first"]).alias("first"))


def split_cells(metrics: DataFrame, splits: int = SPLITS, seed: int = SEED, edges: list[int] = EDGES) -> DataFrame:
    """(split, cell, mean_a, mean_b) of cells with LEAST_CELL values in both halves. All splits are sums of one aggregation; no row is copied."""
    rows = metrics.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("bin", age_bin(edges)["bin"]).where("bin is not null")
    rows = rows.join(halves(rows, splits, seed), "subject_id")
    sides = [x for k in range(splits) for x in (F.sum(F.when(F.col("first")[k], F.col("value"))).alias(f"a{k}"), F.sum(F.when(~F.col("first")[k], F.col("value"))).alias(f"b{k}"), F.count_if(F.col("first")[k]).alias(f"n{k}"))]
    cells = rows.groupBy(*CELL).agg(F.count("*").alias("n"), *sides)
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("split"), F.col(f"n{k}").alias("n_a"), (F.col("n") - F.col(f"n{k}")).alias("n_b"), F.col(f"a{k}").alias("a"), F.col(f"b{k}").alias("b")) for k in range(splits))))
    out = cells.select(*CELL, each.alias("x")).select(*CELL, "x.*").where(F.least("n_a", "n_b") >= LEAST_CELL)
    return out.select("split", *CELL, (F.col("a") / F.col("n_a")).alias("mean_a"), (F.col("b") / F.col("n_b")).alias("mean_b"))


def _r(a: str, b: str):
    return F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))


def split_half(metrics: DataFrame, **how) -> DataFrame:
    """(split, metric, n_cells, r): overall (metric null) where a split has LEAST_CELLS common cells, and by metric of such splits."""
    cells = split_cells(metrics, **how)
    found = cells.groupBy("split", "metric").agg(F.count("*").alias("n_cells"), _r("mean_a", "mean_b").alias("r"))
    overall = cells.groupBy("split").agg(F.count("*").alias("n_cells"), _r("mean_a", "mean_b").alias("r")).where(F.col("n_cells") >= LEAST_CELLS)
    by_metric = found.where(F.col("n_cells") >= LEAST_METRIC).join(overall.select("split"), "split", "left_semi")
    return overall.select("split", F.lit(None).cast("string").alias("metric"), "n_cells", "r").unionAll(by_metric.select("split", "metric", "n_cells", "r"))


def split_half_summary(by_split: DataFrame) -> DataFrame:
    """(scope, n_splits, mean_r, min_r, max_r, flag): overall, of the core metrics' mean in each split, and of each metric; LOW below 0.80."""
    core = by_split.where(F.col("metric").isin(*CORE) & F.col("r").isNotNull()).groupBy("split").agg(F.avg("r").alias("r")).select(F.lit("core").alias("scope"), "r")
    rows = by_split.select(F.coalesce("metric", F.lit("overall")).alias("scope"), "r").unionAll(core)
    out = rows.groupBy("scope").agg(F.count("r").alias("n_splits"), F.avg("r").alias("mean_r"), F.min("r").alias("min_r"), F.max("r").alias("max_r"))
    return out.withColumn("flag", F.when(F.col("mean_r") < LOW, "LOW").when(F.col("mean_r").isNotNull(), "ok"))
