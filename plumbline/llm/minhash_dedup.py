"""Operator 4, MinHash near-dedup by tensored banding.

Method: two small collections of half keys, each the hash of `r` minhashes, are computed per shingle set. Table (i, j)
is keyed by the pair of the i-th half key of one collection and the j-th of the other, so `side`**2 tables cost only
2 * `side` * r minhashes. Candidates are verified on the full sets.

At the threshold J a set pair meets in some table with probability (1 - (1 - J**r)**side)**2. With r = 3 and side = 12
that is 0.9996 at J = 0.8 and more above it.

Equal sets are one class first, whatever their number. Within a scan block only the smallest member of a table's bucket
goes on to the shuffle, so a bucket gets at most one row from each block. Then, as only reachability counts:

1. Turn after turn, every set is compared with the PARTNERS bucket leaders that it shares most tables with, leaders being
   others each turn, and confirmed links are joined; buckets within one component drop out.
2. Once the pairs across components are no more than a few a row, they are compared one by one.
3. If after TURNS more are left (a hot group whose stragglers stay just below the threshold), its sets are dealt to tiles of each
   half key, and the tiles outside the key's main component are compared with all others, in blocks inside the tasks: no pair is
   emitted but the links that join components, confirmed on full sets. Tiles are bounded, so the size of a group adds tasks and not memory.

So every candidate pair is either compared or already known to be in one component. Results per document: n_shingles,
component_id (smallest reachable id) and kept. Long texts are whole; an empty table gives an empty one; further columns are ignored. Null or wordless text has an empty set and no link; fewer words than the
shingle size are one shingle. Rows that share an id are one node; a null id links with nothing and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import components, give_back, partitions, prepare, release, semi, small_join, stored, table
from plumbline.llm.embedding_dedup import forest
from plumbline.llm.text import BASE, MIX2, NOT_SPACE, chunks, mix, pair_hash, word_hashes

SIDE = 12
ROWS = 3
TURNS = 2
PARTNERS = 6
#: Pairs left to compare, for each row of a bucket, that are few.
ENOUGH = 4
#: Sets of a tile: an eighth of the group, within these bounds.
TILE_LEAST, TILE_MOST = 128, 1_024
#: Shingles of all sets of a tile, on average at most: long texts make smaller tiles.
TILE_SHINGLES = 500_000
#: Shingles that a block of the tiles' comparison covers.
BLOCK = 4_096
#: Bytes of each hash that tiles are sent; full sets confirm their links.
WIDTH = 4


def shingles(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, rows' offsets): the distinct shingles of `size` words of each row, sorted."""
    h, _, _, rows = word_hashes(data, off, NOT_SPACE)
    n = np.diff(rows)
    many = np.maximum(n - size + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), many)
    first = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + rows[:-1][row]
    last = np.minimum(first + size, rows[1:][row])
    out = np.full(len(first), np.uint64(size))
    for k in range(size):
        at = first + k
        live = at < last
        out[live] = pair_hash(out[live], h[at[live]])
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    out, row = out[keep], row[keep]
    return out, np.searchsorted(row, np.arange(len(n) + 1))


def half_keys(sets: np.ndarray, off: np.ndarray, side: int, r: int) -> np.ndarray:
    """(rows, 2 * side) half keys of nonempty sets."""
    out = np.empty((len(off) - 1, 2 * side), np.uint64)
    for s in range(2 * side):
        key = np.full(len(off) - 1, np.uint64(s))
        for k in range(r):
            seed = np.uint64((BASE * (s * r + k + 1)) % 2**64)
            x = (sets ^ seed) * np.uint64(MIX2)
            x ^= x >> np.uint64(29)
            x *= np.uint64(BASE)
            key = pair_hash(key, np.minimum.reduceat(x, off[:-1]))
        out[:, s] = key
    return out


def _signatures(size: int, side: int, r: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for i, data, off in chunks(batch.column("text")):
                sets, at = shingles(data, off, size)
                n = np.diff(at)
                full = np.flatnonzero(n)
                h1, h2, sig = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64), np.zeros((len(n), 2 * side), np.uint64)
                if len(full):
                    ends = np.append(at[:-1][full], len(sets))
                    h1[full] = np.add.reduceat(mix(sets), ends[:-1])
                    h2[full] = np.add.reduceat(mix(sets ^ np.uint64(MIX2)), ends[:-1])
                    sig[full] = half_keys(sets, ends, side, r)
                yield pa.RecordBatch.from_arrays([ids.slice(i, len(n)), pa.array(n), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array([x.tobytes() for x in sig], pa.binary())], names=["id", "n", "h1", "h2", "sig"])

    return run


def _table_keys(side: int, block: int = 20_000):
    """(key, id, leader): for each block of sets the rows of every bucket, with the smallest id of the block in it as leader."""

    def tables(ids: np.ndarray, sig: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(side):
            key = pair_hash(sig[:, i : i + 1], sig[:, side:] + np.arange(i * side, (i + 1) * side, dtype=np.uint64)).ravel()
            who = np.repeat(ids, side)
            order = np.lexsort((who, key))
            key, who = key[order], who[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            leader = who[new][np.cumsum(new) - 1]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(who), pa.array(leader)], names=["key", "id", "leader"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append((batch.column("id").to_numpy(), np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint64).reshape(-1, 2 * side)))
            n += len(held[-1][0])
            if n >= block:
                yield from tables(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, n = [], 0
        if n:
            yield from tables(*(np.concatenate(x) for x in zip(*held, strict=True)))
        del held
        give_back()

    return run


def _bucket_leaders(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one partition of keys: the buckets that hold several block leaders, with the smallest as leader."""
    held = list(frames)
    if not held:
        return
    key, who = (np.concatenate([f[c].to_numpy() for f in held]) for c in ("key", "id"))
    del held
    order = np.lexsort((who, key))
    key, who = key[order], who[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.cumsum(new) - 1
    several = np.bincount(at, minlength=1)[at] > 1
    yield pd.DataFrame({"key": key[several], "id": who[several], "leader": who[new][at][several]})


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, off in chunks(batch.column("text")):
                sets, at = shingles(data, off, size)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, len(off) - 1), pa.array([sets[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["id", "words"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("wa"), batch.column("wb"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    ok.append(False)
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. Only sets in some pair are shuffled."""
    ids = stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    sets = semi(sets, ids, "id")
    left = sets.select(F.col("id").alias("a"), F.col("words").alias("wa"))
    right = sets.select(F.col("id").alias("b"), F.col("words").alias("wb"))
    out = stored(pairs.join(left, "a").join(right, "b").mapInArrow(_confirm(percent), "a long, b long"))
    release(ids)
    return out


def _half_rows(side: int):
    """(half, id, component, n): a row for each half key of the first collection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint64).reshape(-1, 2 * side)[:, :side]
            half = pair_hash(sig, np.broadcast_to(np.arange(side, dtype=np.uint64), sig.shape)).ravel()
            rows = pa.array(np.repeat(np.arange(batch.num_rows), side))
            yield pa.RecordBatch.from_arrays([pa.array(half.view(np.int64)), *(batch.column(c).take(rows) for c in ("id", "component", "n"))], names=["half", "id", "component", "n"])

    return run


def _narrow(width: int):
    """(id, words): the leading `width` bytes of each hash, in order; what is equal in full stays equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = (np.frombuffer(v.as_buffer(), np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes() for v in batch.column("words"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.binary())], names=["id", "words"])

    return run


def _joining(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of links a-b that join the n groups as all the links do: each turn every group takes its first link outwards."""
    label, at, chosen = np.arange(n), np.arange(len(a)), [np.zeros(0, np.int64)]
    while len(at := at[label[a[at]] != label[b[at]]]):
        x, y = label[a[at]], label[b[at]]
        first = np.full(n, len(at))
        np.minimum.at(first, x, np.arange(len(at)))
        np.minimum.at(first, y, np.arange(len(at)))
        take = np.unique(first[first < len(at)])
        chosen.append(at[take])
        node, root = forest(n, x[take], y[take])
        to = np.arange(n)
        to[node] = root
        label = to[label]
    return np.concatenate(chosen)


def _compare_tiles(percent: int, width: int):
    """Links that join the components within two tiles (or one), by sets of `width` bytes a hash.

    Narrow hashes that are equal by chance can only add links: the k-th of a value in one set counts as equal to the k-th in another.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        ids, size = part["id"].to_numpy(), part["words"].str.len().to_numpy() // width
        names, group = np.unique(part["component"].to_numpy(), return_inverse=True)
        wide = np.zeros((int(size.sum()), 8), np.uint8)
        wide[:, 8 - width :] = np.frombuffer(b"".join(part["words"]), np.uint8).reshape(-1, width)
        value, row = wide.view(">u8").ravel().astype(np.uint64), np.repeat(np.arange(len(part)), size)
        at = np.arange(len(value))
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
        again = at - np.maximum.accumulate(np.where(new, at, 0))
        order = np.lexsort((again, value))
        value, again, row = value[order], again[order], row[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (again[1:] != again[:-1])
        # Only what components share counts: a column for each value of several.
        start = np.flatnonzero(new)
        several = np.minimum.reduceat(group[row], start) < np.maximum.reduceat(group[row], start)
        live = several[np.cumsum(new) - 1]
        row, column = row[live], (np.cumsum(several) - 1)[(np.cumsum(new) - 1)[live]]
        others = np.flatnonzero(group != np.bincount(group).argmax())
        common = np.zeros((len(others), len(part)), np.float32)
        for lo in range(0, columns := int(several.sum()), BLOCK):
            i, j = np.searchsorted(column, [lo, lo + BLOCK])
            block = np.zeros((len(part), min(BLOCK, columns - lo)), np.float32)
            block[row[i:j], column[i:j] - lo] = 1
            common += block[others] @ block.T
        common = common.astype(np.int64)
        near = (100 * common >= percent * (size[others, None] + size[None] - common)) & (group[others, None] != group[None])
        a, b = np.nonzero(near)
        a = others[a]
        take = _joining(len(names), group[a], group[b])
        where = {c: np.full(len(take), part[c].iloc[0]) for c in ("half", "x", "y") if c in part}
        return pd.DataFrame({**where, "a": np.minimum(ids[a], ids[b])[take], "b": np.maximum(ids[a], ids[b])[take]})

    return run


def _in_tiles(bucket: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, side: int) -> DataFrame:
    """Links (a, b) that join the components of the buckets (key, id, component) that are left, where links do.

    Tiles get narrow sets, which are all that is copied; the links that they choose are confirmed on full sets. Where one fails
    (hashes that differ only beyond WIDTH bytes), its tiles are compared again on full sets. Tiles are bounded in sets and in shingles.
    """
    ids = stored(bucket.select("id", "component").distinct())
    sets = semi(sets, ids.select("id"), "id")
    half = stored(semi(classes.select("id", "sig", "n"), ids.select("id"), "id").join(ids, "id").mapInArrow(_half_rows(side), "half long, id long, component long, n long"))
    per = half.groupBy("half", "component").agg(F.count("*").alias("count"), F.sum("n").alias("words")).groupBy("half")
    per = per.agg(F.max(F.struct("count", "component", "words")).alias("main"), F.sum("count").alias("n"), F.sum("words").alias("words")).where("main.count < n")
    tile = F.greatest(F.lit(TILE_LEAST), F.least(F.lit(TILE_MOST), (F.col("n") / 8).cast("long")))
    tiles = lambda count, words: F.greatest(F.ceil(count / tile), F.ceil(words / TILE_SHINGLES))
    # Tiles 0 to rest - 1 hold what is outside the main component, the next ones what is in it.
    rest = tiles(F.col("n") - F.col("main.count"), F.col("words") - F.col("main.words")).alias("rest")
    per = stored(per.select("half", F.col("main.component").alias("top"), rest, tiles(F.col("main.count"), F.col("main.words")).alias("more")))
    inside = F.col("component") == F.col("top")
    place = F.when(inside, F.col("rest") + F.pmod(F.xxhash64("id"), "more")).otherwise(F.pmod(F.xxhash64("id"), "rest"))
    dealt = small_join(half, per, "half").withColumn("tile", place)
    with_rest = F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)
    with_all = F.sequence(F.lit(0).cast("long"), F.col("rest") + F.col("more") - 1)
    dealt = dealt.select("half", "id", "component", "tile", F.explode(F.when(inside, with_rest).otherwise(with_all)).alias("other"))
    dealt = dealt.select("half", "id", "component", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"))

    def compared(rows: DataFrame, width: int) -> DataFrame:
        narrow = sets.mapInArrow(_narrow(width), "id long, words binary")
        return stored(rows.join(narrow, "id").groupBy("half", "x", "y").applyInPandas(_compare_tiles(percent, width), "half long, x long, y long, a long, b long"))

    found = compared(dealt, WIDTH)
    out = _verified(found.select("a", "b").distinct(), sets, percent)
    # Tiles of which a link failed chose it in place of others: they are compared again, on full sets.
    failed = stored(found.join(out, ["a", "b"], "left_anti").select("half", "x", "y").distinct())
    if not failed.isEmpty():
        out = out.union(compared(small_join(dealt, failed, ["half", "x", "y"], "left_semi"), 8).select("a", "b")).distinct()
    release(ids, half, per, found, failed)
    return out


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, side: int = SIDE, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row of docs."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = stored(docs.mapInArrow(_signatures(size, side, rows), "id long, n long, h1 long, h2 long, sig binary"))
    # One class for each set; its smallest id stands for it. Counts and minima aggregate before the shuffle.
    classes = stored(signed.where("n > 0 and id is not null").groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "sig")).alias("m")).select("h1", "h2", "n", "m.id", "m.sig"))
    keys = classes.select("id", "sig").mapInArrow(_table_keys(side), "key long, id long, leader long")
    keys = keys.where("id <> leader").union(keys.where("id = leader").select("key", "id").repartition(max(partitions(spark), keys_parts(classes, side)), "key").mapInPandas(_bucket_leaders, "key long, id long, leader long"))
    members = stored(keys)
    # Sets of all that share a bucket, from the classes' texts (equal rows give equal sets).
    bucket = stored(members.select("key", "id").union(members.select("key", F.col("leader").alias("id"))).distinct())
    release(members)
    needed = stored(bucket.select("id").distinct())
    sets = stored(semi(docs.where("id is not null"), needed, "id").select("id", "text").mapInArrow(_sets(size), "id long, words binary"))
    none = spark.createDataFrame([], "node bigint, component bigint")
    links = tested = known = None
    for turn in range(TURNS + 1):
        # Buckets whose members are in several components so far, each row with its bucket's leader of this turn and that one's component.
        release(known)
        known = components(links) if links is not None else none
        before, bucket = bucket, small_join(bucket.select("key", "id"), known.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
        lead = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("r"), "id", "component")).alias("m")
        mixed = bucket.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), lead).where("lo < hi")
        bucket = stored(bucket.join(mixed.select("key", "n", F.col("m.id").alias("leader"), F.col("m.component").alias("top")), "key"))
        release(before)
        # Pairs that would now be compared if all outside the leader's component met their whole bucket.
        left = bucket.agg(F.coalesce(F.sum(F.when(F.col("component") != F.col("top"), F.col("n"))), F.lit(0)), F.count("*")).first()
        if not left[1]:
            break
        few_left = left[0] <= ENOUGH * left[1]
        if turn == TURNS and not few_left:
            found = _in_tiles(bucket, classes, sets, percent, side)
            links = found if links is None else links.union(found)
            break
        outside = bucket.where("component <> top")
        if few_left:
            # Pairs within the leader's component are joined already, so one side of each pair lies outside it.
            other = bucket.select("key", F.col("id").alias("b"), F.col("component").alias("cb"))
            pairs = outside.select("key", "id", "component").join(other, "key").where("component <> cb").select(*_ordered("id", "b"))
        else:
            # A set meets the few leaders that it shares most tables with. Dealt by id once for both counts.
            meet = outside.select("id", "leader").repartition("id").groupBy("id", "leader").count()
            few = meet.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("count", "leader")), False), 1, PARTNERS).alias("few"))
            pairs = few.select("id", F.explode("few.leader").alias("leader")).select(*_ordered("id", "leader"))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs.distinct())
        found = _verified(pairs, sets, percent)
        links = found if links is None else links.union(found)
        tested = pairs if tested is None else tested.union(pairs)
        if few_left:
            break
    joined = components(links) if links is not None else none
    release(bucket, needed, sets)
    joined = classes.join(joined, classes["id"] == joined["node"], "left").select("h1", "h2", "n", F.coalesce("component", "id").alias("component"))
    out = signed.select("id", "n", "h1", "h2").join(joined, ["h1", "h2", "n"], "left").select("id", "n", F.coalesce(F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("component")), "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keys_parts(classes: DataFrame, side: int, most: int = 2_000_000) -> int:
    """Partitions for the table keys, so that each holds about `most` rows."""
    return 1 + classes.count() * side * side // most


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 2 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w),
u AS (SELECT min(doc_id) AS rep, list_sort(sh) AS sh FROM s WHERE len(sh) > 0 GROUP BY 2),
e AS (SELECT rep, unnest(sh) AS x FROM u),
n AS (SELECT rep, len(sh) AS n FROM u),
i AS (SELECT a.rep AS a, b.rep AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep GROUP BY ALL),
l AS (SELECT i.a, i.b FROM i JOIN n p ON p.rep = i.a JOIN n q ON q.rep = i.b WHERE 100 * c >= 80 * (p.n + q.n - c)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rep AS a, rep AS b FROM u UNION SELECT r.a, g.b FROM r JOIN g ON g.a = r.b),
c AS (SELECT a, min(b) AS component FROM r GROUP BY a)
SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id, coalesce(c.component, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN u ON u.sh = list_sort(s.sh) LEFT JOIN c ON c.a = u.rep
"""
