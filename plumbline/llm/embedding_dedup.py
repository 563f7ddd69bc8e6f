"""Operator 1, embedding near-dedup by PCA-ordered tiled comparison.

Method: vectors are normalised and turned to the axes of a principal component analysis, so leading dimensions carry most.
Tiles of vectors that lie together on the first axis are compared in pairs. A pair of tiles whose boxes on the leading
axes lie too far apart is skipped. Within a tile pair the products of the leading dimensions are summed first; the rest is at
most the product of the suffix norms, so comparison stops where the cosine cannot reach the threshold. What is left is
decided by the cosine of the original vectors in double precision.

Equal vectors are one class first. Each task counts the links of its rows and gives a spanning forest of them, so links are
counted all but never listed; a hot group is spread over all its tile pairs. The sizes of tiles are fixed, so a task's memory
is too; the tile pairs of n vectors are compared in (n / tile)**2 / 2 tasks' steps, less those that the boxes exclude.

Results per row: vec_id, n_links (other rows with cosine >= threshold, equal vectors included), component_id (smallest id
reachable) and kept. Null, empty or zero vectors and ones with null or non-finite parts link with nothing; neither do vectors of
different lengths, whose cosine is not defined: each length is compared by itself. Rows that share an id are one node but count as
links of their own. A null id links with nothing and is kept; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import components, partitions, prepare, release, stored, table
from plumbline.llm.text import mix

THRESHOLD = 0.95
TILE = 2_048
#: Dimensions that each step of the comparison adds.
STEP = 8
#: Ranges on the first axis at most; their bounds are all that the driver gets.
RANGES = 1_000
BOX = 4
SLACK = 1e-9


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a column as doubles, and their norms."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x, np.linalg.norm(x, axis=1)


def _moments(dim: int):
    """Second moments of the unit vectors of each partition: dim * dim numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x, norm = _matrix(batch.column("v"), dim)
            x = x / norm[:, None]
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["k", "x"])

    return run


def _leads(ids: np.ndarray, x: np.ndarray, norm: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Places on the first axis, spread a little by id, so that vectors of one direction don't share one place."""
    spread = mix(ids.astype(np.uint64)) / 2.0**64
    return (x / norm[:, None]) @ axes[:, 0] + 1e-3 * spread


def _project(dim: int, axes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_leads(ids, *_matrix(batch.column("v"), dim), axes))], names=["lead"])

    return run


def _assign(dim: int, axes: np.ndarray, bounds: np.ndarray, parts: int):
    """The tile of each vector: its range on the first axis, and within it one of `parts` by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            lead = _leads(ids, *_matrix(batch.column("v"), dim), axes)
            part = mix(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(parts)
            tile = np.searchsorted(bounds, lead) * parts + part.astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "n", "v")), pa.array(tile)], names=["id", "n", "v", "tile"])

    return run


def _pack(axes: np.ndarray, kind: type):
    """One row for a tile: its ids, class sizes, vectors (as wide as they came) and the box of its first places."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        x = np.vstack(part["v"].to_numpy()).astype(np.float64)
        y = (x / np.linalg.norm(x, axis=1)[:, None]) @ axes[:, :BOX]
        return pd.DataFrame({
            "tile": [int(part["tile"].iloc[0])], "ids": [part["id"].to_numpy(np.int64).tobytes()], "sizes": [part["n"].to_numpy(np.int64).tobytes()],
            "vectors": [x.astype(kind).tobytes()], "lo": [y.min(axis=0).tolist()], "hi": [y.max(axis=0).tolist()],
        })

    return run


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links a-b among n nodes: each node with its component's smallest node (min-label with jumps)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def compare(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float) -> np.ndarray:
    """Whether rows of x and y have cosine >= threshold (a boolean matrix), by leading dimensions first."""
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    px, py = x @ axes, y @ axes
    sum_ = np.zeros((len(x), len(y)))
    live = None
    for k in range(0, px.shape[1], STEP):
        sum_ += px[:, k : k + STEP] @ py[:, k : k + STEP].T
        rest = np.outer(np.linalg.norm(px[:, k + STEP :], axis=1), np.linalg.norm(py[:, k + STEP :], axis=1))
        live = sum_ + rest >= threshold - SLACK
        if live.mean() < 0.02:
            break
    if live.mean() > 0.05:
        return live & (x @ y.T >= threshold)
    i, j = np.nonzero(live)
    link = np.zeros(live.shape, bool)
    for s in range(0, len(i), 50_000):
        a, b = i[s : s + 50_000], j[s : s + 50_000]
        link[a, b] = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
    return link


def _compare_tiles(dim: int, axes: np.ndarray, threshold: float, kind: type):
    """Per tile pair: links of each row as (id, n, -1) and a spanning forest as (id, -1, other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                raw = {c: batch.column(c)[r].as_buffer() for c in ("ids", "sizes", "vectors", "ids2", "sizes2", "vectors2")}
                ids, sizes, ids2, sizes2 = (np.frombuffer(raw[c], np.int64) for c in ("ids", "sizes", "ids2", "sizes2"))
                x, y = (np.frombuffer(raw[c], kind).astype(np.float64).reshape(-1, dim) for c in ("vectors", "vectors2"))
                same = batch.column("tile")[r].as_py() == batch.column("tile2")[r].as_py()
                link = compare(x, y, axes, threshold)
                if same:
                    np.fill_diagonal(link, False)
                counts = [(ids, link @ sizes2)] if same else [(ids, link @ sizes2), (ids2, sizes @ link)]
                i, j = np.nonzero(link)
                node, root = forest(len(ids) + len(ids2), i, j if same else j + len(ids))
                both = np.concatenate([ids, ids2])
                who = np.concatenate([k[n > 0] for k, n in counts])
                many = np.concatenate([n[n > 0] for _, n in counts])
                empty = np.full(len(node), -1)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([who, both[node]])), pa.array(np.concatenate([many, empty])), pa.array(np.concatenate([np.full(len(who), -1), both[root]]))], names=["a", "links", "b"])

    return run


def _links(good: DataFrame, dim: int, kind: type, threshold: float, tile: int) -> tuple[DataFrame, DataFrame]:
    """Of vectors (h1, h2, id, v) of one length: the classes (h1, h2, id, n) and what their tile pairs give (a, links, b)."""
    spark = good.sparkSession
    # A class's node is its smallest id; if two classes share that id (repeated ids), edges to it still mean the same node.
    classes = stored(good.groupBy("h1", "h2").agg(F.min(F.struct("id", "v")).alias("m"), F.count("*").alias("n")).select("h1", "h2", "m.id", "m.v", "n"))
    total = classes.count()
    moments = classes.select("v").mapInArrow(_moments(dim), "k long, x double").groupBy("k").agg(F.sum("x").alias("x")).orderBy("k").collect()
    _, axes = np.linalg.eigh(np.array([m["x"] for m in moments]).reshape(dim, dim))
    axes = np.ascontiguousarray(axes[:, ::-1])
    # Ranges of about a tile's vectors each; with more than RANGES of them, ids split each range into several tiles.
    ranges = min(RANGES, 1 + total // tile)
    parts = 1 + total // (ranges * tile) if ranges == RANGES else 1
    cuts = [i / ranges for i in range(1, ranges)]
    lead = classes.select("id", "v").mapInArrow(_project(dim, axes), "lead double")
    bounds = np.array(lead.select(F.percentile_approx("lead", cuts, 20 * ranges)).first()[0] if cuts else [])
    tiles = classes.select("id", "n", "v").mapInArrow(_assign(dim, axes, bounds, parts), "id long, n long, v array<double>, tile long")
    tiles = stored(tiles.groupBy("tile").applyInPandas(_pack(axes, kind), "tile long, ids binary, sizes binary, vectors binary, lo array<double>, hi array<double>"))
    # Boxes farther apart than the chord of the threshold hold no link. Only ids and boxes take part in this choice.
    chord = 2 - 2 * threshold + SLACK
    box = tiles.select("tile", "lo", "hi")
    gap = F.aggregate(F.zip_with(F.zip_with("lo", "hi2", lambda a, b: a - b), F.zip_with("lo2", "hi", lambda a, b: a - b), lambda p, q: F.greatest(p, q, F.lit(0.0))), F.lit(0.0), lambda s, g: s + g * g)
    cell = lambda side, more: F.floor(F.col(side)[0] / float(chord**0.5)) + more
    near = box.withColumn("cell", F.explode(F.sequence(cell("lo", -1), cell("hi", 1))))
    other = box.select(F.col("tile").alias("tile2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"), F.explode(F.sequence(cell("lo", 0), cell("hi", 0))).alias("cell"))
    pairs = stored(near.join(other, "cell").where((F.col("tile") <= F.col("tile2")) & (gap <= chord)).select("tile", "tile2").distinct())
    second = tiles.select(F.col("tile").alias("tile2"), F.col("ids").alias("ids2"), F.col("sizes").alias("sizes2"), F.col("vectors").alias("vectors2"))
    first = tiles.select("tile", "ids", "sizes", "vectors")
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, "4")  # tiles are large rows
    try:
        found = stored(pairs.repartition(max(partitions(spark), 1), "tile", "tile2").join(first, "tile").join(second, "tile2").mapInArrow(_compare_tiles(dim, axes, threshold, kind), "a long, links long, b long"))
    finally:
        spark.conf.set(rows, before)
    release(tiles, pairs)
    return classes.select("h1", "h2", "id", "n"), found


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(id, n_links, component_id, kept) of each row of vectors."""
    spark = vectors.sparkSession
    prepare(spark)
    kind = np.float32 if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else np.float64
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0) & F.col("id").isNotNull()
    # -0.0 is 0.0, so that equal vectors have equal hashes: 128 bits name a class.
    rows = rows.withColumn("v", F.when(F.coalesce(fine, F.lit(False)), F.transform("v", lambda x: x + F.lit(0.0))))
    rows = rows.withColumns({"h1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "h2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), F.reverse("v")))})
    lengths = [r["d"] for r in rows.where("v is not null").groupBy(F.size("v").alias("d")).count().orderBy("d").collect()]
    if not lengths:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    classes = found = None
    for dim in lengths:
        one, more = _links(rows.where(F.size("v") == dim).select("h1", "h2", "id", "v"), dim, kind, threshold, tile)
        classes, found = (one, more) if classes is None else (classes.union(one), found.union(more))
    links = found.where("links >= 0").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "id")
    nodes = components(found.where("links < 0").select("a", "b"))
    classes = classes.join(links, "id", "left").join(nodes.withColumnRenamed("node", "id"), "id", "left")
    per = stored(classes.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")))
    out = rows.select("id", "h1", "h2").join(per, ["h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a, min(b) AS component FROM r GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component AS component_id, c.component = v.vec_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id JOIN c ON c.a = v.vec_id
"""
