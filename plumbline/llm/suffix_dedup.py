"""Operator 8, suffix-array dedup: byte strings of `width` that occur more than once are cut.

Method: longest-previous-factor (LPF) arrays. A suffix array orders the suffixes of a shard; the previous and
the next suffix in that order which start earlier in the text give each position its longest earlier match.
So that a corpus of any size needs only small shards, content picks where to look:

1. Every `width`-byte window owns one anchor, the k-gram of least hash inside it, so equal windows own equal
   k-grams at equal offsets. One anchor owns a run of window starts (about 170), whose bytes are its context.
2. Anchors whose k-gram occurs once are done: nothing in their runs repeats. If a whole context occurs again
   (copies, the inside of passages), its run repeats. Both are counts that aggregate before the shuffle.
3. What is left are the edges of matches. One context of each kind goes to the shard of its k-gram, where the
   LPF array tells which windows occur elsewhere. A k-gram with over `group` different contexts (the edge of a
   very common passage) is counted window by window instead, which no group size can hurt.

Results: `mode='all'` cuts every byte covered by a string that also starts anywhere else; `mode='later'` keeps the
first occurrence in (id, position) order and cuts later ones. Null or short text has nothing to cut. Repeated rows
are separate documents. Texts are whole and matches never cross documents. Columns beyond id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import partitions, prepare, release, semi, small_join, stored, table
from plumbline.llm.text import MIX, chunks, prefix_hash, span_hash

GRAM = 64
GROUP = 48
#: Bits of a position within a chunk; the rest of a 64-bit key is hash.
POS_BITS = 28


# --- kernels -------------------------------------------------------------------------------------------------


def window_owner(grams: np.ndarray, window: int) -> np.ndarray:
    """Position of the least gram hash among each `window` grams, the leftmost of equals (van Herk's sliding minimum)."""
    n = len(grams)
    mask = np.uint64((1 << POS_BITS) - 1)
    key = (grams & ~mask) | np.arange(n, dtype=np.uint64)
    pad = -n % window
    key = np.concatenate([key, np.full(pad, ~np.uint64(0))]).reshape(-1, window)
    head = np.minimum.accumulate(key, axis=1).ravel()
    tail = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(tail[: n - window + 1], head[window - 1 : n]) & mask).astype(np.int64)


def anchors(data: np.ndarray, off: np.ndarray, width: int, gram: int):
    """Arrays (row, anchor, first start, last start, gram hash, context hash) of a chunk; positions are the row's."""
    long = np.flatnonzero(np.diff(off) >= width)
    if not len(long) or len(data) < width:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    prefix = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hash(prefix, at, at + gram)
    owner = window_owner(grams, width - gram + 1)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(owner)]
    whole = np.arange(len(owner)) + width <= off[1:][row]
    change = np.empty(len(owner), bool)
    change[0] = True
    change[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(change & whole)
    stop = np.flatnonzero(np.append(change[1:], True) & whole | whole & ~np.append(whole[1:], False))
    r, a = row[start], owner[start]
    context = span_hash(prefix, start, stop + width)
    return r, a - off[r], start - off[r], stop - off[r], grams[a], context ^ ((a - start).astype(np.uint64) * np.uint64(MIX))


def suffix_ranks(data: np.ndarray, starts: np.ndarray, width: int, exact: bool) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Rank of the suffixes at `starts` by their first `width` bytes, and for shorter prefixes what tells them apart.

    Prefix doubling, last to first halved: prefixes of up to an eighth of the width are told apart by their hashes, in whose
    order they stand (any fixed order of the first symbols serves a suffix array), longer ones by ranks of pairs.
    """
    n = len(data)
    sizes = [width]
    while sizes[-1] > 1:
        sizes.append((sizes[-1] + 1) // 2)
    prefix, at, levels, rank, before = prefix_hash(data), np.arange(n), [], None, 0
    for k in reversed(sizes):
        if 8 * k <= width or k == 1:
            if exact or 16 * k > width:
                rank = span_hash(prefix, at, np.minimum(at + k, n))
                levels.append((k, rank))
        else:
            if levels[-1][1] is rank and 8 * before <= width:  # hashes become ranks
                rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
            place = starts if k == width else at
            after = np.zeros(len(place), np.uint64)
            fits = place + k <= n
            after[fits] = rank[place[fits] + k - before]
            rank = np.unique(rank[place] * np.uint64(n + 1) + after, return_inverse=True)[1].astype(np.uint64)
            if k < width:
                levels.append((k, rank))
        before = k
    return rank, levels


def common_prefix(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, which differ within the width."""
    n = len(levels[0][1])
    length = np.zeros(len(a), np.int64)
    a, b = a.copy(), b.copy()
    for k, rank in reversed(levels):
        same = (np.maximum(a, b) + k <= n) & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        length[same] += k
        a[same] += k
        b[same] += k
    return length


def smaller(position: np.ndarray, step: int) -> np.ndarray:
    """For each place of a suffix order, the nearest place before (step -1) or after (step 1) with a smaller position, else -1.

    Pointers jump over larger positions until all are settled, so no Python loop runs over the suffixes.
    """
    n = len(position)
    link = np.arange(n) + step
    link[link >= n] = -1
    live = np.flatnonzero(link >= 0)
    while len(live):
        j = link[live]
        live, j = live[position[j] > position[live]], j[position[j] > position[live]]
        link[live] = link[j]
        live = live[link[live] >= 0]
    return link


def longest_factors(data: np.ndarray, starts: np.ndarray, width: int, forward: bool = True, exact: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """For each of the (rising) starts, the longest match up to width with an earlier start: the LPF array; and with a later one.

    Without `exact`, matches shorter than width are not measured and count as 0.
    """
    rank, levels = suffix_ranks(data, starts, width, exact)
    by_rank = np.argsort(rank, kind="stable")
    order, rank = starts[by_rank], rank[by_rank]
    out = []
    for position in (order, -order) if forward else (order,):
        best = np.zeros(len(order), np.int64)
        for step in (-1, 1):
            link = smaller(position, step)
            has = np.flatnonzero(link >= 0)
            same = rank[has] == rank[link[has]]
            best[has[same]] = width
            if not exact:
                continue
            has = has[~same & (best[has] < width)]
            best[has] = np.maximum(best[has], common_prefix(levels, order[has], order[link[has]]))
        back = np.empty(len(order), np.int64)
        back[by_rank] = best
        out.append(back)
    return out[0], out[-1]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2] - 1


# --- plan ----------------------------------------------------------------------------------------------------


def _anchor_rows(width: int, gram: int):
    names = ["key", "rank", "anchor", "first", "last", "gram", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "rank"))
            for i, data, off in chunks(batch.column("text")):
                r, a, s, e, g, c = anchors(data, off, width, gram)
                yield pa.RecordBatch.from_arrays([pa.array(keys[i + r]), pa.array(ranks[i + r]), *(pa.array(x) for x in (a, s, e, g.view(np.int64), c.view(np.int64)))], names=names)

    return run


def _contexts(width: int):
    """Cut the bytes of each wanted context out of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                data = (text or "").encode()
                out += [(w["gram"], w["key"], w["rank"], w["first"], w["last"], w["first"] - w["anchor"], w["n"], w["hot"], data[w["first"] : w["last"] + width]) for w in wanted]
            cols = list(zip(*out, strict=True)) or [()] * 9
            kinds = [pa.int64()] * 7 + [pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["gram", "key", "rank", "first", "last", "lead", "n", "hot", "bytes"])

    return run


def window_starts(rows: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, place) of each window of the joined contexts, and the places where contexts start."""
    size = rows["bytes"].str.len().to_numpy()
    base = np.cumsum(size) - size
    count = size - width + 1
    which = np.repeat(np.arange(len(rows)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + base[which], base


def _match(width: int, later: bool, most: int = 1_500_000):
    """LPF over the contexts of a shard, k-grams one after another, `most` bytes at a time."""

    def shard(rows: pd.DataFrame) -> list[tuple[int, int, int, int]]:
        data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
        which, starts, base = window_starts(rows, width)
        earlier, after = longest_factors(data, starts, width, not later, exact=False)
        hit = np.maximum(earlier, after) >= width
        first, last = runs(hit)
        cut = np.flatnonzero(np.diff(which)) + 1  # runs end where contexts do
        out = []
        for f, e in zip(first, last, strict=True):
            inner = cut[np.searchsorted(cut, f, "right") : np.searchsorted(cut, e, "right")]
            for x, y in zip([f, *inner], [*(inner - 1), e], strict=True):
                r = which[x]
                out.append((int(rows["key"].iloc[r]), int(rows["rank"].iloc[r]), int(rows["first"].iloc[r] + starts[x] - base[r]), int(rows["first"].iloc[r] + starts[y] - base[r])))
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        have = 0

        def done() -> pd.DataFrame:
            rows = pd.concat(held).sort_values(["rank", "key", "first"] if later else ["gram", "key", "first"])
            return pd.DataFrame(shard(rows), columns=["key", "rank", "first", "last"])

        last_gram = None
        for frame in frames:
            for gram, group in frame.groupby("gram", sort=False):
                if have > most and gram != last_gram:
                    yield done()
                    held, have = [], 0
                held.append(group)
                have += int(group["bytes"].str.len().sum())
                last_gram = gram
        if held:
            yield done()

    return run


def _window_hashes(width: int, most: int = 2_000):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for i in range(0, len(whole), most):
                frame = whole.iloc[i : i + most]
                which, starts, base = window_starts(frame, width)
                data = np.frombuffer(b"".join(frame["bytes"]), np.uint8)
                at = starts - base[which]
                h = span_hash(prefix_hash(data), starts, starts + width) ^ ((frame["lead"].to_numpy()[which] + at).astype(np.uint64) * np.uint64(MIX))
                yield pd.DataFrame({"window": h.view(np.int64), "at": frame["first"].to_numpy()[which] + at} | {c: frame[c].to_numpy()[which] for c in ("gram", "key", "n", "rank")})

    return run


def repeated_windows(docs: DataFrame, width: int = 400, gram: int = GRAM, group: int = GROUP, mode: str = "all") -> DataFrame:
    """(key, rank, first, last): runs of starts whose `width` bytes occur elsewhere. docs: (key, rank, text); rank orders documents, both name a row."""
    later = mode == "later"
    row = ["key", "rank"]
    found = stored(docs.select(*row, "text").mapInArrow(_anchor_rows(width, gram), "key long, rank long, anchor long, first long, last long, gram long, context long"))
    twice = stored(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    some = stored(semi(found, twice, "gram"))
    release(found, twice)
    least = F.min(F.struct("rank", "key", "anchor", "first", "last")).alias("m")
    kinds = stored(some.groupBy("gram", "context").agg(F.count("*").alias("n"), least).select("gram", "context", "n", "m.*"))
    several = kinds.groupBy("gram").agg(F.count("*").alias("k"), F.min("n").alias("least")).where("k > 1").select("gram", (F.col("k") > group).alias("hot"), (F.col("least") == 1).alias("open"))
    # Runs whose whole context occurs again: all of them, or all but the first.
    again = stored(kinds.where("n > 1").select("gram", "context", *(F.col(c).alias("m_" + c) for c in ("key", "rank", "first"))))
    whole = small_join(some, again, ["gram", "context"])
    if later:
        whole = whole.where("key <> m_key or rank <> m_rank or first <> m_first")
    whole = whole.select(*row, "first", "last")
    # One context of each kind, where a k-gram has several and some are not decided yet.
    several = stored(several.where("true" if later else "open").select("gram", "hot"))
    wanted = small_join(kinds, several, "gram").select(*row, F.struct("gram", *row, "anchor", "first", "last", "n", "hot").alias("w"))
    wanted = stored(wanted.groupBy(*row).agg(F.collect_list("w").alias("wanted")))
    texts = semi(docs.select(*row, "text"), wanted.select("key").distinct(), "key").dropDuplicates(row)
    cut = texts.join(wanted, row).select("text", "wanted").mapInArrow(_contexts(width), "gram long, key long, rank long, first long, last long, lead long, n long, hot boolean, bytes binary")
    cut = stored(cut)
    release(kinds, several, wanted)
    shards = cut.where("not hot").repartition(partitions(docs.sparkSession), "gram").sortWithinPartitions("gram")
    edges = shards.mapInPandas(_match(width, later), "key long, rank long, first long, last long")
    windows = cut.where("hot").mapInPandas(_window_hashes(width), "window long, at long, gram long, key long, n long, rank long")
    spread = stored(windows.groupBy("gram", "window").agg(F.sum("n").alias("total"), F.min(F.struct("rank", "key", "at")).alias("m")).where("total > 1").select("gram", "window", "m"))
    common = small_join(windows, spread, ["gram", "window"])
    if later:
        common = common.where("key <> m.key or rank <> m.rank or at <> m.at")
    common = common.select(*row, F.col("at").alias("first"), F.col("at").alias("last"))
    return whole.union(edges).union(common)


def _cut(width: int):
    """Per document: bytes, removed bytes, removed runs and the bytes that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data, merged = (text or "").encode(), []
                for s, e in sorted((s["first"], s["last"] + width) for s in spans or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                edges = [0, *(x for m in merged for x in m), len(data)]
                kept = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 400, mode: str = "all", **how) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes)."""
    prepare(docs.sparkSession)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Rows with equal id and text share a key and a fate; counts still see each of them.
    keyed = keyed.withColumn("key", F.xxhash64("id", "text")).withColumn("rank", F.coalesce("id", F.lit(2**62)))
    found = repeated_windows(keyed, width, mode=mode, **how)
    spans = found.groupBy("key", "rank").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    joined = keyed.join(spans, ["key", "rank"], "left").select("id", "text", "spans")
    return joined.mapInArrow(_cut(width), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").withColumnRenamed("id", id_col)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of each document, and cut: whether it lost bytes."""
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("kept").withColumn("cut", F.col("n_removed") > 0)
