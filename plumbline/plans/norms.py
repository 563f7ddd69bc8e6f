"""Norm cells and scores as DataFrame plans: one statistics row per bin, sex, condition, channel, band and metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.numeric import SW_C1, SW_C2, SW_MEAN_LARGE, SW_MEAN_SMALL, SW_SD_LARGE, SW_SD_SMALL, low_first, norm_cdf, norm_ppf, num, t_beyond, t_table, two_tailed
from plumbline.plans.sql import run
from plumbline.session import written
from plumbline.sources.fixtures import EDGES, LOG_METRICS, NEIGHBOURS, POINTS

KEYS = ["bin", "bin_lo", "bin_hi", "sex", "condition", "channel", "band", "metric"]
#: Cells of more values are ranked in this many slices, so that no cell is sorted in one task.
SLICED, SLICES = 5_000, 64


def is_log() -> Column:
    return F.col("metric").isin(*LOG_METRICS) | F.contains("band", F.lit("/"))


def age_bin(edges: list[int] = EDGES) -> Column:
    """Half-open bins as a struct; None outside."""
    out = F.lit(None).cast("struct<bin: string, bin_lo: int, bin_hi: int>")
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        out = F.when((F.col("age") >= lo) & (F.col("age") < hi), F.struct(F.lit(f"{lo}-{hi - 1}").alias("bin"), F.lit(lo).alias("bin_lo"), F.lit(hi).alias("bin_hi"))).otherwise(out)
    return out


def fan_out(metrics: DataFrame, edges: list[int] = EDGES) -> DataFrame:
    """Each value once for 'pooled' and once for its own sex if that is F or M; values without a bin go, as do NaN and null."""
    sex = F.upper(F.trim("sex"))
    rows = metrics.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("b", age_bin(edges)).where("b is not null")
    both = F.when(sex.isin("F", "M"), F.array(F.lit("pooled"), sex)).otherwise(F.array(F.lit("pooled")))
    return rows.select("b.*", F.explode(both).alias("sex"), "condition", "channel", "band", "metric", "value")


def with_cells(rows: DataFrame, cells: DataFrame, keys: list[str], *columns: str, how: str = "inner") -> DataFrame:
    """rows with columns of their cell (one row a key); null keys meet null keys."""
    other = cells.select(*(F.col(k).alias(f"_{k}") for k in keys), *(F.col(c).alias(f"_of_{c}") for c in columns))
    meets = F.lit(True)
    for k in keys:
        meets = meets & rows[k].eqNullSafe(other[f"_{k}"])
    return rows.join(other, meets, how).select(*(rows[c] for c in rows.columns), *(other[f"_of_{c}"].alias(c) for c in columns))


def ranked(rows: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """rows (keys, value) with their cell's n and n_log and their exact rank i in it by value. No cell is sorted in one task.

    Cells of over SLICED values are cut at approximate quantiles of their own; slices are ranked apart and moved by the counts of those before.
    """
    points = F.array(*(F.lit(k / SLICES) for k in range(1, SLICES)))
    large = cells.where(F.col("n") > SLICED)
    cuts = with_cells(rows, large, keys, "n").groupBy(*keys).agg(F.array_distinct(F.percentile_approx("value", points, 1_000)).alias("cuts"))
    placed = with_cells(with_cells(rows, cells, keys, "n", "n_log"), cuts, keys, "cuts", how="left")
    placed = placed.withColumn("slice", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("value"))), F.lit(0))).withColumn("sliced", F.col("cuts").isNotNull()).drop("cuts")
    order = Window.partitionBy(*keys, "slice").orderBy("value")
    sizes = placed.where("sliced").groupBy(*keys, "slice").count()
    before = sizes.withColumn("before", F.sum("count").over(Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))).drop("count")
    out = placed.withColumn("i", F.row_number().over(order).cast("long"))
    return with_cells(out, before, [*keys, "slice"], "before", how="left").withColumn("i", F.col("i") + F.coalesce("before", F.lit(0))).drop("before", "slice", "sliced")


def rank_statistics(rows: DataFrame, cells: DataFrame, keys: list[str], shape: bool) -> DataFrame:
    """Per cell its percentiles (by linear interpolation) and, if shape, normality_p of the scoring space, from one ranking of its values.

    normality_p needs 3 values and spread (Royston's fit is to 5,000; beyond it extrapolates). Logarithms keep the order, so a positive value's rank
    among positive ones is its rank less the number of others.
    """
    at = ranked(rows, cells, keys)
    place = {p: F.lit(p / 100) * (F.col("n") - 1) for p in POINTS}
    low = {p: F.max(F.when(F.col("i") == F.floor(x) + 1, F.col("value"))) for p, x in place.items()}
    high = {p: F.max(F.when(F.col("i") == F.ceil(x) + 1, F.col("value"))) for p, x in place.items()}
    sums = [F.max("n").alias("n"), *(c.alias(f"{side}{k}") for side, of in (("lo", low), ("hi", high)) for k, c in enumerate(of.values()))]
    if shape:
        x = F.when(is_log(), F.when(F.col("value") > 0, F.ln("value"))).otherwise(F.col("value"))
        at = at.withColumn("k", F.when(is_log(), F.col("n_log")).otherwise(F.col("n"))).withColumns({"x": x, "j": F.col("i") - (F.col("n") - F.col("k"))})
        m = F.expr(norm_ppf(f"((j - {num(0.375)}) / (k + {num(0.25)}))"))
        at = at.withColumn("m", F.when(F.col("x").isNotNull() & (F.col("k") >= 3), F.when((F.col("k") % 2 == 1) & (2 * F.col("j") == F.col("k") + 1), F.lit(0.0)).otherwise(m)))
        end = lambda k, c: F.max(F.when(F.col("x").isNotNull() & (F.col("j") == k), F.col(c)))
        sums += [
            F.max("k").alias("k"), F.sum(F.col("m") * F.col("m")).alias("mm"), F.sum(F.col("m") * F.col("x")).alias("mx"), F.var_pop("x").alias("v"), F.min("x").alias("least"), F.max("x").alias("most"),
            end(F.col("k"), "m").alias("m1"), end(F.col("k") - 1, "m").alias("m2"), end(F.col("k"), "x").alias("x1"), end(F.col("k") - 1, "x").alias("x2"), end(F.lit(1), "x").alias("y1"), end(F.lit(2), "x").alias("y2"),
        ]
    out = at.groupBy(*keys).agg(*sums)
    # As a + (b - a) * t, with t the part of the place beyond the lower rank.
    between = [F.col(f"lo{k}") + (F.col(f"hi{k}") - F.col(f"lo{k}")) * (place[p] - F.floor(place[p])) for k, p in enumerate(POINTS)]
    out = out.withColumn("percentiles", F.array(*between))
    if shape:
        fit = (F.col("k") >= 3) & (F.col("most") > F.col("least"))
        # One column a step: written out as one expression this grows beyond what a planner can hold.
        for name, text in SHAPIRO_STEPS.items():
            out = out.withColumn(name, F.expr(text))
        out = out.withColumn("normality_p", F.when(fit, F.col("normality_p")))
    return out.select(*keys, "percentiles", *(["normality_p"] if shape else []))


def shapiro(rows: DataFrame, keys: list[str]) -> DataFrame:
    """normality_p of the scoring space of each cell (keys, metric and band among them, and value)."""
    cells = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count(F.when(is_log() & (F.col("value") > 0), 1)).alias("n_log"))
    return rank_statistics(rows, cells, keys, True).select(*keys, "normality_p")


_U = "(1 / sqrt(k))"
_LOG = "ln(k)"
_GAMMA = f"({num(0.459)} * k - {num(2.273)})"
#: Royston's AS R94 from a cell's sums: end weights a1 and a2, inner weights m / sqrt(phi), the statistic and its p.
SHAPIRO_STEPS = {
    "a1": f"CASE WHEN k = 3 THEN sqrt({num(0.5)}) ELSE {low_first(SW_C1, _U)} + m1 / sqrt(mm) END",
    "a2": f"{low_first(SW_C2, _U)} + m2 / sqrt(mm)",
    "phi": "CASE WHEN k > 5 THEN (mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2) ELSE (mm - 2 * m1 * m1) / nullif(1 - 2 * a1 * a1, 0) END",
    "top": "CASE WHEN k = 3 THEN a1 * (x1 - y1) WHEN k > 5 THEN a1 * (x1 - y1) + a2 * (x2 - y2) + (mx - m1 * (x1 - y1) - m2 * (x2 - y2)) / sqrt(phi) ELSE a1 * (x1 - y1) + (mx - m1 * (x1 - y1)) / sqrt(phi) END",
    "w": f"least(top * top / nullif(k * v, 0), {num(1 - 1e-16)})",
    "y": f"CASE WHEN k <= 11 THEN (-ln(greatest({_GAMMA} - ln(1 - w), {num(1e-300)})) - {low_first(SW_MEAN_SMALL, 'k')}) / exp({low_first(SW_SD_SMALL, 'k')}) ELSE (ln(1 - w) - {low_first(SW_MEAN_LARGE, _LOG)}) / exp({low_first(SW_SD_LARGE, _LOG)}) END",
    "normality_p": f"CASE WHEN w IS NULL THEN NULL WHEN k = 3 THEN greatest({num(0.0)}, {num(1.909859317102744)} * (asin(sqrt(w)) - asin(sqrt({num(0.75)})))) WHEN k <= 11 AND ln(1 - w) >= {_GAMMA} THEN {num(0.0)} ELSE {norm_cdf('(-y)')} END",
}


def norm_cells(metrics: DataFrame, edges: list[int] = EDGES, shape: bool = True, percentiles: bool = True) -> DataFrame:
    """The norm cells of long metrics (subject_id, age, sex, condition, channel, band, metric, value); shape: with normality_p.

    percentiles (needed by shape): without them the cells are one aggregation, and no value is ranked.
    """
    spark = metrics.sparkSession
    rows = fan_out(metrics, edges)
    if percentiles or shape:
        rows = written(rows)
    positive = F.when(is_log() & (F.col("value") > 0), F.ln("value"))
    cells = rows.groupBy(*KEYS).agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("sd"),
        F.avg(positive).alias("log_mean"), F.count(positive).alias("n_log"), F.coalesce(F.stddev_samp(positive), F.when(F.count(positive) > 0, 0.0)).alias("log_sd"),
        F.skewness("value").alias("skewness"), F.kurtosis("value").alias("kurtosis"),
    ).withColumn("log_transformed", is_log())
    usable = (F.col("n") >= 3) & (F.col("sd") > 0)
    cells = cells.withColumn("skewness", F.when(usable, F.col("skewness"))).withColumn("kurtosis", F.when(usable, F.col("kurtosis")))
    # Quantiles of t for few distinct df: a table of fixed size, an expansion beyond it.
    table = spark.createDataFrame([(i + 1, float(t)) for i, t in enumerate(t_table())], "df long, t double")
    cells = cells.withColumn("df", F.when(is_log(), F.col("n_log")).otherwise(F.col("n")) - 1).join(F.broadcast(table), "df", "left")
    t = F.coalesce("t", F.when(F.col("df") > 0, F.expr(t_beyond("df"))))
    k = (F.col("df") + 1).cast("double")
    center, spread = F.when(is_log(), F.col("log_mean")).otherwise(F.col("mean")), F.when(is_log(), F.col("log_sd")).otherwise(F.col("sd"))
    ok = (F.col("df") >= 1) & (spread > 0)

    def bound(sign: int, width: Column) -> Column:
        raw = center + sign * t * spread * width
        return F.when(ok, F.when(is_log(), F.exp(raw)).otherwise(raw))

    mean_width, value_width = 1 / F.sqrt(k), F.sqrt(1 + 1 / k)
    cells = cells.select(
        "*", bound(-1, mean_width).alias("ci_lower"), bound(1, mean_width).alias("ci_upper"), bound(-1, value_width).alias("pi_lower"), bound(1, value_width).alias("pi_upper"),
    ).drop("df", "t")
    if not (percentiles or shape):
        return cells
    ranks = rank_statistics(rows, written(cells.select(*KEYS, "n", "n_log")), KEYS, shape)
    cells = with_cells(cells, ranks, KEYS, *ranks.columns[len(KEYS) :], how="left")
    return cells.withColumn("transform_normalized", F.col("normality_p") >= 0.05) if shape else cells


def best_cells(cells: DataFrame) -> DataFrame:
    """Of cells with the same keys the one of largest n, then least bin label."""
    w = Window.partitionBy("bin_lo", "bin_hi", "sex", "condition", "channel", "band", "metric").orderBy(F.desc("n"), "bin")
    return cells.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def spark_bins(spark: SparkSession, edges: list[int]) -> DataFrame:
    return spark.createDataFrame(list(zip(edges[:-1], edges[1:], strict=True)), "bin_lo int, bin_hi int")


def score(metrics: DataFrame, cells: DataFrame, match: str = "label", use_sex: bool = True, edges: list[int] | None = None) -> DataFrame:
    """z scores of long metrics against cells. match 'label': the label's whole years, both ends included (29.5 has no bin).

    edges: those that the cells were built with, if known; else their bins are collected from the cells. A sex without cells is scored
    against the pooled ones. Cells must be unique by key (see best_cells). Without percentiles among their columns, rank and what follows from it
    (robust_z, z_discrepancy, discrepant) are left out.
    """
    top = F.col("bin_hi") - 1 if match == "label" else F.col("bin_hi")
    bins = spark_bins(metrics.sparkSession, edges) if edges else cells.select("bin_lo", "bin_hi").distinct()
    inside = (F.col("age") >= F.col("bin_lo")) & ((F.col("age") <= top) if match == "label" else (F.col("age") < top))
    # Subjects meet the few bins first, so that cells join on equal keys only; a cell's sexes are one row, so that one join is left.
    keys = ["bin_lo", "bin_hi", "condition", "channel", "band", "metric"]
    rows = metrics.withColumn("own", F.upper(F.trim("sex"))).join(F.broadcast(bins), inside)
    ranks = "percentiles" in cells.columns
    cell = F.struct("n", "mean", "sd", "log_mean", "log_sd", "log_transformed", *(["percentiles"] if ranks else []), "pi_lower", "pi_upper", F.col("sex").alias("used"))
    sexes = cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("sex", cell.alias("cell")))).alias("cells"))
    own = F.coalesce(F.col("cells")[F.col("own")], F.col("cells")["pooled"]) if use_sex else F.col("cells")["pooled"]
    rows = rows.join(sexes, keys).withColumn("cell", own)
    rows = rows.where("cell is not null").select("subject_id", "age", "condition", "channel", "band", "metric", "value", "cell.*")
    log_ok = is_log() & (F.col("value") > 0) & F.col("log_mean").isNotNull() & (F.col("log_sd") > 0)
    z = F.when(log_ok, (F.ln("value") - F.col("log_mean")) / F.col("log_sd")).when(F.col("sd") > 0, (F.col("value") - F.col("mean")) / F.col("sd")).when(F.col("mean") != 0, (F.col("value") - F.col("mean")) / F.abs("mean")).otherwise(0.0)
    # Ten decimals, so that equal deviations are ties whatever the order of sums was.
    rows = rows.withColumn("z", F.round(z, 10))
    if ranks:
        rows = rows.withColumn("rank", percentile_rank())
        edge = F.when(F.col("n") < 200, F.greatest(F.lit(1.0), F.least(F.lit(99.0), F.col("rank")))).otherwise(F.greatest(F.lit(0.5), F.least(F.lit(99.5), F.col("rank")))) / 100
        rows = rows.withColumn("robust_z", edge).withColumn("robust_z", F.expr(norm_ppf("robust_z")))
    a = F.abs("z")
    tier = F.when(a < 0.5, 0).when(a < 1.0, 1).when(a < 1.5, 2).when(a < 2.0, 3).when(a < 3.0, 4).otherwise(5)
    return rows.withColumns({
        "p": F.expr(two_tailed("z")), **({"z_discrepancy": F.abs(F.col("z") - F.col("robust_z")), "discrepant": F.abs(F.col("z") - F.col("robust_z")) > 1.0} if ranks else {}), "low_confidence": F.col("n") < 10,
        "se_z": F.sqrt(1 / F.col("n") + F.col("z") * F.col("z") / (2 * F.col("n"))), "cohen_d": F.when(F.col("sd") > 0, (F.col("value") - F.col("mean")) / F.col("sd")), "severity": tier,
        "in_prediction": F.col("value").between(F.col("pi_lower"), F.col("pi_upper")),
    })


def percentile_rank() -> Column:
    """Where value lies among the cell's points, by lines between them: the first segment that holds it, ties in its middle."""
    points = F.array(*(F.lit(float(p)) for p in POINTS))
    last = len(POINTS)

    def segment(i: Column) -> Column:
        lo, hi = F.element_at("percentiles", i), F.element_at("percentiles", i + 1)
        a, b = F.element_at(points, i), F.element_at(points, i + 1)
        return F.when((F.col("value") >= lo) & (F.col("value") <= hi), F.when(hi > lo, a + (b - a) * (F.col("value") - lo) / (hi - lo)).otherwise((a + b) / 2))

    found = F.coalesce(*(segment(F.lit(i)) for i in range(1, last)))
    return F.when(F.col("value") <= F.element_at("percentiles", 1), POINTS[0]).when(F.col("value") >= F.element_at("percentiles", last), POINTS[-1]).otherwise(found)


def false_discovery(scores: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Benjamini-Hochberg within each subject and condition; ties in p are ordered by the other keys."""
    part = Window.partitionBy("subject_id", "condition")
    ranked = scores.withColumn("k", F.row_number().over(part.orderBy("p", "channel", "band", "metric"))).withColumn("m", F.count("*").over(part))
    ranked = ranked.withColumn("threshold", alpha * F.col("k") / F.col("m"))
    return ranked.withColumn("largest", F.coalesce(F.max(F.when(F.col("p") <= F.col("threshold"), F.col("k"))).over(part), F.lit(0))).withColumn("significant", F.col("k") <= F.col("largest"))


def global_patterns(scores: DataFrame, cut: float = 1.5, share: float = 0.6) -> DataFrame:
    """Bands and metrics where most channels deviate in one direction; channels without z count in the share's base."""
    keys = ["subject_id", "condition", "band", "metric"]
    # Both directions are counted in one row and parted after the shuffle.
    counts = scores.groupBy(*keys).agg(F.count("*").alias("n_channels"), F.count_if(F.col("z") > cut).alias("high"), F.count_if(-F.col("z") > cut).alias("low"))
    sides = F.explode(F.array(*(F.struct(F.lit(d).alias("direction"), F.col(d).alias("n_deviant")) for d in ("high", "low"))))
    found = counts.select(*keys, "n_channels", sides.alias("side")).select(*keys, "side.direction", "n_channels", "side.n_deviant")
    return found.withColumn("share", F.col("n_deviant") / F.col("n_channels")).where(F.col("share") >= share)


def clusters(scores: DataFrame, cut: float = 1.5, neighbours: dict[str, list[str]] | None = None) -> DataFrame:
    """Connected channels that deviate in one direction, two at least. Labels spread over a fixed adjacency of few channels."""
    spark = scores.sparkSession
    near = neighbours or NEIGHBOURS
    keys = ["subject_id", "condition", "band", "metric", "direction"]
    rows = scores.where(F.abs("z") > cut).withColumn("direction", F.when(F.col("z") > 0, "high").otherwise("low")).select(*keys, "channel", "z")
    # One row for each pattern: its channels fit in an array, whose labels spread in place.
    names = sorted(set(near) | {b for bs in near.values() for b in bs})
    sets = rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("channel", "z"))).alias("zs")).withColumn("label", F.transform_values("zs", lambda k, _: k))
    around = F.create_map(*(x for n in names for x in (F.lit(n), F.array(*(F.lit(b) for b in near.get(n, []))))))
    near_labels = lambda label, k: F.filter(F.transform(F.coalesce(around[k], F.array().cast("array<string>")), lambda b: label[b]), lambda x: x.isNotNull())
    step = lambda label, _: F.transform_values(label, lambda k, v: F.array_min(F.concat(F.array(v), near_labels(label, k))))
    # A label needs one turn less than there are channels to reach all.
    sets = sets.withColumn("label", F.aggregate(F.sequence(F.lit(1), F.lit(len(names))), F.col("label"), step))
    out = sets.select(*keys, F.explode(F.map_entries("label")).alias("e"), "zs").select(*keys, F.col("e.value").alias("root"), F.col("e.key").alias("channel"), F.col("zs")[F.col("e.key")].alias("z"))
    return out.groupBy(*keys, "root").agg(F.count("*").alias("size"), F.array_join(F.array_sort(F.collect_list("channel")), ",").alias("channels"), F.avg(F.abs("z")).alias("mean_abs_z"), F.max(F.abs("z")).alias("max_abs_z")).where("size >= 2")


#: Pairs of metrics whose deviations should agree, the words for the second, and what it means if they do not.
PAIRS = [("absolute_power", "corrected_absolute_power", "periodic", "aperiodic"), ("absolute_power", "relative_power", "relative", "broadband")]


def pair_disagreements(scores: DataFrame, pairs: list[tuple[str, str, str, str]] = PAIRS, cut: float = 1.5) -> DataFrame:
    """Places where the two metrics of a pair deviate in opposite directions, one of them beyond the cut, with what it means: a row a pair."""
    names = sorted({m for first, second, *_ in pairs for m in (first, second)})
    z = F.struct(*(F.max(F.when(F.col("metric") == m, F.col("z"))).alias(m) for m in names))
    pair = F.explode(F.array(*(F.struct(*(F.lit(x).alias(k) for x, k in zip(p, ("first", "second", "word", "what"), strict=True)), F.col("z")[p[0]].alias("a"), F.col("z")[p[1]].alias("b")) for p in pairs)))
    keys = ["subject_id", "condition", "channel", "band"]
    found = scores.groupBy(*keys).agg(z.alias("z")).select(*keys, pair.alias("p")).select(*keys, "p.*").where((F.col("a") * F.col("b") < 0) & (F.greatest(F.abs("a"), F.abs("b")) > cut))
    way = lambda c: F.when(F.col(c) > 0, "elevated").otherwise("reduced")
    text = F.concat(F.lit("total power "), way("a"), F.lit(", "), "word", F.lit(" power "), way("b"), F.lit(" at "), "channel", F.lit(" "), "band", F.lit(": the deviation is "), "what")
    return found.select(*keys, "first", "second", "a", "b", text.alias("interpretation"))


def disagreements(scores: DataFrame, cut: float = 1.5) -> DataFrame:
    """Places where total and periodic power deviate in opposite directions, one of them beyond the cut, with what it means."""
    return pair_disagreements(scores, PAIRS[:1], cut).drop("first", "second").withColumnsRenamed({"a": "absolute_z", "b": "corrected_z"})


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT * FROM metrics")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the norms, score every subject, control the false-discovery rate."""
    rows = metrics(spark, sf_dir)
    return false_discovery(score(rows, best_cells(norm_cells(rows, shape=False)), edges=EDGES)).drop("percentiles", "log_transformed")


__all__ = ["best_cells", "clusters", "false_discovery", "flagship", "global_patterns", "norm_cdf", "norm_cells", "score", "shapiro"]
