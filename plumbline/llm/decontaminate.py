"""Operator 2, benchmark decontamination with suffix arrays of the training texts.

Method: each block of documents is a shard with a suffix array over its words. Every suffix of the benchmark is found
in it by binary search, which gives its longest verbatim match there and the places of all its occurrences of a
window's length. Documents whose hit words are a large enough share are contaminated.

Words that no benchmark item has cannot be part of a match, so the array only orders suffixes that start a run of
benchmark words as long as the shortest window. The benchmark travels in blocks of bounded size, one scan of the
documents each; with a single block (any benchmark of up to BLOCK_WORDS words) nothing is shuffled at all.

A window is `window` consecutive words of an item; an item of fewer, but not none, is one window. A document word inside
any occurrence of a window is hit. Null text has no words and no hits. Each row gives one result, repeated rows too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import anti, named, prepare, stored, table
from plumbline.llm.text import ALNUM, chunks, word_hashes

BLOCK_WORDS = 1_000_000
WINDOW = 13
SPAN = "struct<first: long, last: long, start: long, end: long>"
MATCH = "struct<item: string, item_word: long, first: long, words: long>"


class Tests:
    """One block of benchmark items: their words as ids and their windows."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        hashes = [_words(t) for _, t in items]
        size = np.array([len(h) for h in hashes], np.int64)
        self.vocabulary, ids = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]), return_inverse=True)
        self.names = [i for i, _ in items]
        first = np.cumsum(size) - size
        self.words = ids.astype(np.int64) + 1
        length = np.minimum(size, window)
        count = np.where(size > 0, size - length + 1, 0)
        self.item = np.repeat(np.arange(len(items)), count)
        self.start = np.arange(len(self.item)) - np.repeat(np.cumsum(count) - count, count) + first[self.item]
        self.length = length[self.item]
        self.offset = self.start - first[self.item]
        self.shortest = int(self.length.min()) if len(self.length) else 0


def _words(text: str | None) -> np.ndarray:
    (_, data, off), *_ = chunks(pa.array([text], pa.string()))
    return word_hashes(data, off, ALNUM)[0]


def _column(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The word at each place; past the end it is 0, as are words no test has."""
    return np.where(at < len(words), words[np.minimum(at, len(words) - 1)], 0)


class Shard:
    """A suffix array over the words of a block of documents (0: a word that no test has, or the end of a document)."""

    def __init__(self, words: np.ndarray, depth: int, shortest: int) -> None:
        self.words = words
        live = words > 0
        until = np.arange(len(words)) + 1
        stop = np.where(live, len(words), np.arange(len(words)))
        stop = np.minimum.accumulate(stop[::-1])[::-1]
        run = stop - until + 1
        at = np.flatnonzero(live & (run >= shortest))
        # Ranks by prefix doubling over the candidates' first `depth` words.
        rank, k = words, 1
        while k < depth:
            step = min(k, depth - k)
            pair = rank * (int(rank.max(initial=0)) + 1) + _column(rank, np.arange(len(words)) + step)
            new = np.zeros(len(words), np.int64)
            _, new[live] = np.unique(pair[live], return_inverse=True)
            new[live] += 1
            rank, k = new, k + step
        self.suffixes = at[np.argsort(rank[at], kind="stable")] if len(at) else at

    def search(self, query: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query suffix the range of places in the suffix array whose first `length` words equal its own."""
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(self.suffixes), np.int64)
        for k in range(int(length.max(initial=0))):
            live = np.flatnonzero((k < length) & (lo < hi))
            if not len(live):
                break
            want = query[start[live] + k]
            lo[live], hi[live] = self._bound(lo[live], hi[live], want, k, False), self._bound(lo[live], hi[live], want, k, True)
        return lo, hi

    def _bound(self, lo: np.ndarray, hi: np.ndarray, want: np.ndarray, k: int, after: bool) -> np.ndarray:
        """First place in each range whose k-th word is at least `want` (beyond it if `after`)."""
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            word = _column(self.words, self.suffixes[np.minimum(mid, len(self.suffixes) - 1)] + k)
            less = open_ & ((word <= want) if after else (word < want))
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        return lo


def _flat(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def _longest(tests: Tests, which: np.ndarray, where: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(item, its first word, place, words) of the longest verbatim matches: windows that follow each other on both sides."""
    if not len(which):
        return
    order = np.lexsort((where, where - tests.start[which], tests.item[which]))
    which, where = which[order], where[order]
    new = np.ones(len(which), bool)
    new[1:] = (tests.item[which[1:]] != tests.item[which[:-1]]) | (which[1:] != which[:-1] + 1) | (where[1:] != where[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(which)) - 1
    for a, b in zip(first, last, strict=True):
        yield int(tests.item[which[a]]), int(tests.offset[which[a]]), int(where[a]), int(b - a + tests.length[which[a]])


def _hits(tests: Tests, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, off in chunks(batch.column("text")):
                h, start, end, rows = word_hashes(data, off, ALNUM)
                n_words = np.diff(rows)
                # Ids of test words, with an end after each document.
                at = np.minimum(np.searchsorted(tests.vocabulary, h), max(0, len(tests.vocabulary) - 1))
                ids = np.where(tests.vocabulary[at] == h, at + 1, 0) if len(tests.vocabulary) else np.zeros(len(h), np.int64)
                seq = np.insert(ids, rows[1:], 0)
                doc = np.repeat(np.arange(len(n_words)), n_words + 1)
                hit = np.zeros(len(seq) + 1, np.int64)
                offset = rows[:-1] + np.arange(len(n_words))
                matches: list[list] = [[] for _ in n_words]
                if tests.shortest and len(seq):
                    shard = Shard(seq, window, tests.shortest)
                    lo, hi = shard.search(tests.words, tests.start, tests.length)
                    which, place = _flat(lo, hi)
                    where = shard.suffixes[place] if len(place) else place
                    np.add.at(hit, where, 1)
                    np.add.at(hit, where + tests.length[which], -1)
                    for item, at_word, place_, n in _longest(tests, which, where):
                        d = doc[place_]
                        matches[d].append({"item": tests.names[item], "item_word": at_word, "first": int(place_ - offset[d]), "words": n})
                covered = np.cumsum(hit[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                spans: list[list] = [[] for _ in n_words]
                for s, e in zip(edge[::2], edge[1::2], strict=True):
                    d = doc[s]
                    spans[d].append({"first": int(s - offset[d]), "last": int(e - offset[d] - 1), "start": int(start[rows[d] + s - offset[d]] - off[d]), "end": int(end[rows[d] + e - offset[d] - 1] - off[d])})
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))
                match = pa.list_(pa.struct([("item", pa.string()), *((c, pa.int64()) for c in ("item_word", "first", "words"))]))
                rest = [c for c in batch.schema.names if c != "text"]
                cols = [batch.column(c).slice(i, len(n_words)) for c in rest]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words), pa.array(spans, kind), pa.array(matches, match)], names=[*rest, "n_words", "spans", "matches"])

    return run


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hits of several benchmark blocks in one document: the union of their word spans and items."""
    for frame in frames:
        out = []
        for spans in frame["spans"]:
            merged: list[dict] = []
            for s in sorted((x for part in spans for x in part), key=lambda x: x["first"]):
                if merged and s["first"] <= merged[-1]["last"] + 1:
                    if s["last"] > merged[-1]["last"]:
                        merged[-1] |= {"last": s["last"], "end": s["end"]}
                else:
                    merged.append({c: s[c] for c in ("first", "last", "start", "end")})
            out.append(merged)
        yield frame.assign(spans=out)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, spans (hit words and their bytes) and
    matches (the longest verbatim ones: item, its word, the document's word, words)."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tests = items.where(F.col(item_text).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
    # Bytes bound words; blocks are by hash of the item, so that each stays small whatever the benchmark's size.
    total = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + int(total) // (2 * block_words)
    kind = f"n_words long, spans array<{SPAN}>, matches array<{MATCH}>"
    id_type = docs.schema["id"].dataType.simpleString()
    if blocks == 1:
        hits = docs.mapInArrow(_hits(Tests([tuple(r) for r in tests.collect()], window), window), f"id {id_type}, {kind}")
    else:
        # 128 bits of hash name a row.
        keyed = docs.withColumn("key", F.struct(F.xxhash64("id", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "id").alias("h2")))
        tagged = tests.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
        # One scan for each block: only documents with hits go to the union.
        found = None
        for b in range(blocks):
            part = Tests([tuple(r) for r in tagged.where(F.col("block") == b).select("item", "text").collect()], window)
            one = keyed.mapInArrow(_hits(part, window), f"id {id_type}, key struct<h1: long, h2: long>, {kind}").where("size(spans) > 0").select("key", "spans", "matches")
            found = one if found is None else found.union(one)
        found = found.distinct().groupBy("key").agg(F.collect_list("spans").alias("spans"), F.flatten(F.collect_list("matches")).alias("matches"))
        none = keyed.select("id", "key", "text").mapInArrow(_hits(Tests([], window), window), f"id {id_type}, key struct<h1: long, h2: long>, {kind}").select("id", "key", "n_words")
        all_spans = none.join(found, "key", "left").select("id", "n_words", F.coalesce("spans", F.array().cast(f"array<array<{SPAN}>>")).alias("spans"), F.coalesce("matches", F.array().cast(f"array<{MATCH}>")).alias("matches"))
        hits = all_spans.mapInPandas(_merge, f"id {id_type}, {kind}")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    out = hits.withColumn("items", F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))).withColumn("n_hit", n_hit)
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans", "matches",
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents that are not contaminated, with all their columns. Equal rows share their fate."""
    prepare(docs.sparkSession)
    keyed = named(docs, id_col, text_col)
    rows = keyed.select(F.struct("h1", "h2").alias("row"), F.col("doc")[text_col].alias("text"))
    bad = stored(contamination(rows, items, "row", "text", **how).where("contaminated").select("row.h1", "row.h2").distinct())
    return anti(keyed, bad, ["h1", "h2"]).select(*(F.col("doc")[c].alias(c) for c in docs.columns))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "matches")


OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
t AS (SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS s
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
k AS (SELECT DISTINCT k FROM t),
o AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS s FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) >= k)),
m AS (SELECT o.r, o.i, o.k, t.item_id FROM o JOIN t ON o.k = t.k AND o.s = t.s),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM m) GROUP BY r),
i AS (SELECT r, count(DISTINCT item_id) AS n_items, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS ids FROM m GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(array_to_string(i.ids, ','), '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)
"""
