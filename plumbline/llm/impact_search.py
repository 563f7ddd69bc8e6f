"""Operator 12, ranked lexical search by NRA (no random access) over impact-sorted lists.

Method: one scan counts each document's terms that any item has, behind a bitmap of fixed size. Documents are dealt to shards by
hash, so each shard has a bounded number of postings whatever the corpus and no term gathers in one task. A shard keeps, for each term, its
documents by falling impact. For an item the lists are read in turn from the top, deeper each round: a document's lower bound is
the sum of what was read of it, its upper bound adds the next unread impact of each list it was not yet met in. Reading goes on
until no document that may still reach the lowest of the best ones has bounds apart, so membership, ties and scores are all final.
The best of all shards meet in one ranking; a shard's own best ten hold all that can be among the best ten of all.

A term is a run of letters, digits and characters beyond ASCII, A-Z lowered; terms are named by 64 bits of hash. Items travel in
blocks of bounded size and meet every shard; documents without a term of any item count in N and L and are then left.

Each row of documents is a document and each row of items an item, repeated ids too. Null and empty texts have no terms and are in no
result; items without terms, or whose terms no document has, give no rows. Equal scores go by ascending id, null ids last. An empty
table on either side gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import prepare, release, stored, table
from plumbline.llm.text import ALNUM, chunks, word_hashes

TOP = 10
#: Bits of the filter over the items' terms: 2 MB.
BITS = 2**24
#: Postings in a shard and terms in a block of items, about.
SHARD, BLOCK = 1_000_000, 500_000
#: Entries of each list that the first round reads; each next round goes as many times deeper.
FIRST, DEEPER = 64, 4
SHARD_ROW = "terms binary, starts binary, places binary, impacts binary, ids array<long>"


def _ends(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of each row's distinct terms, by row."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return rows[at], hashes[at], np.diff(np.append(at, len(rows)))


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _count(bitmap: np.ndarray | None):
    """Per text: its number of terms, and the distinct ones that the bitmap has (all without one) with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [c for c in batch.schema.names if c != "text"]
            for i, data, off in chunks(batch.column("text")):
                h, _, _, first = word_hashes(data, off, ALNUM)
                n = np.diff(first)
                rows = np.repeat(np.arange(len(n)), n)
                if bitmap is not None:
                    bit = h & np.uint64(BITS - 1)
                    keep = ((bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                    rows, h = rows[keep], h[keep]
                rows, h, tf = _ends(rows, h)
                ends = np.searchsorted(rows, np.arange(len(n) + 1))
                cols = [batch.column(c).slice(i, len(n)) for c in rest]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n), _lists(h.view(np.int64), ends), _lists(tf, ends)], names=[*rest, "n", "terms", "counts"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, documents) of each batch."""
    for batch in batches:
        term, df = np.unique(batch.column("terms").flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df)], names=["term", "df"])


def _bitmap(terms: DataFrame) -> np.ndarray:
    """BITS bits, set where the low bits of a term point to: a fixed size, whatever the number of terms."""
    place = (F.col("term").bitwiseAND(F.lit(BITS - 1)) + 1).alias("place")
    parts = terms.select(place).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    out = np.zeros(BITS // 8, np.uint8)
    for x in parts:
        raw = np.frombuffer(bytes(x["bits"]), np.uint8)
        out[(x["part"] - 1) * 4_096 : (x["part"] - 1) * 4_096 + len(raw)] = raw
    return out


def _pack(n_docs: int, n_terms: int):
    """One row of a shard's documents: for each term its documents (as places in ids) by falling impact."""

    def run(part: pa.Table) -> pa.Table:
        terms, counts = part.column("terms").combine_chunks(), part.column("counts").combine_chunks()
        size = terms.value_lengths().to_numpy()
        doc = np.repeat(np.arange(len(size)), size)
        n = part.column("n").to_numpy()
        m = 100 - 75 + (75 * n * n_docs) // n_terms
        term, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        order = np.lexsort((doc, -impact, term))
        names, starts = np.unique(term[order], return_index=True)
        row = [names, np.append(starts, len(term)), doc[order].astype(np.int32), impact[order].astype(np.int32)]
        return pa.table([*(pa.array([x.tobytes()], pa.binary()) for x in row), pa.array([part.column("id").to_pylist()], pa.list_(pa.int64()))], names=["terms", "starts", "places", "impacts", "ids"])

    return run


def resolve(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, top: int, first: int = FIRST) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that are among the best `top`, those that tie with the last included. lists: (documents, falling scores)."""
    lower = np.zeros(n_docs, np.int64)
    read, depth = 0, first
    while True:
        beyond, unread = np.zeros(n_docs, np.int64), 0
        for doc, score in lists:
            np.add.at(lower, doc[read:depth], score[read:depth])
            if depth < len(doc):
                # What this list can still give to a document that it has not yet shown.
                unread += int(score[depth])
                np.add.at(beyond, doc[:depth], score[depth])
        upper = lower + unread - beyond
        least = max(1, int(np.partition(lower, n_docs - top)[n_docs - top])) if n_docs > top else 1
        if not unread or not (upper[upper >= least] > lower[upper >= least]).any():
            best = np.flatnonzero(lower >= least)
            return best, lower[best]
        read, depth = depth, depth * DEEPER


def _search(items: list, top: int):
    """The best documents of each shard for each item (number, id, terms, weights times repeats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                kinds = {"terms": np.int64, "starts": np.int64, "places": np.int32, "impacts": np.int32}
                terms, starts, places, impacts = (np.frombuffer(batch.column(c)[r].as_buffer(), k) for c, k in kinds.items())
                ids = batch.column("ids").slice(r, 1).flatten()
                # Null ids come last among equal scores.
                by = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
                place_of = np.empty(len(by), np.int64)
                place_of[by] = np.arange(len(by))
                found: list[tuple] = []
                for number, name, wanted, weights in items:
                    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
                    here = np.flatnonzero(terms[at] == wanted)
                    lists = [(places[starts[a] : starts[a + 1]], impacts[starts[a] : starts[a + 1]].astype(np.int64) * w) for a, w in zip(at[here], weights[here], strict=True) if w]
                    if not lists:
                        continue
                    doc, score = resolve(lists, len(ids), top)
                    best = np.lexsort((place_of[doc], -score))[:top]
                    found.append((np.full(len(best), number), [name] * len(best), doc[best], score[best]))
                if found:
                    number, doc, score = (np.concatenate([f[k] for f in found]) for k in (0, 2, 3))
                    yield pa.RecordBatch.from_arrays([pa.array(number), pa.array([x for f in found for x in f[1]], pa.string()), ids.take(pa.array(doc)), pa.array(score)], names=["number", "item", "id", "score"])

    return run


def lexical_search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", top: int = TOP, shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """(item, rank, document, score): the best `top` documents of each item."""
    spark = docs.sparkSession
    prepare(spark)
    item_type = items.schema[item_col].dataType.simpleString()
    lists = "n long, terms array<long>, counts array<long>"
    named = items.select(F.monotonically_increasing_id().alias("number"), F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
    queries = stored(named.mapInArrow(_count(None), f"number long, item string, {lists}").where("n > 0"))
    asked = stored(queries.select("number", F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("number", F.col("x.terms").alias("term"), F.col("x.counts").alias("repeats")))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counted = stored(texts.mapInArrow(_count(_bitmap(asked)), f"row long, id long, {lists}"))
    n_docs, n_terms, postings = counted.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.sum(F.size("terms"))).first()
    empty = spark.createDataFrame([], f"number long, item string, {id_col} long, score long, rank int")
    best = None
    if postings:
        df = counted.select("terms").mapInArrow(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(1000 * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
        weighted = stored(asked.join(df, "term").withColumn("weight", weight * F.col("repeats")))
        shards = 1 + int(postings) // shard
        dealt = counted.where(F.size("terms") > 0).groupBy(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"))
        packed = stored(dealt.applyInArrow(_pack(n_docs, n_terms), SHARD_ROW))
        blocks = 1 + weighted.count() // block
        for b in range(blocks):
            of = F.pmod(F.xxhash64("number"), F.lit(blocks)) == b
            names = {r["number"]: r["item"] for r in queries.where(of).select("number", "item").collect()}
            rows = weighted.where(of).groupBy("number").agg(F.collect_list(F.struct("term", "weight")).alias("x")).collect()
            part = [(r["number"], names[r["number"]], np.array([x["term"] for x in r["x"]], np.int64), np.array([x["weight"] for x in r["x"]], np.int64)) for r in rows]
            one = packed.mapInArrow(_search(part, top), "number long, item string, id long, score long")
            best = one if best is None else best.unionAll(one)
        best = stored(best)
        release(weighted, packed)
    release(counted, asked, queries)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumnRenamed("id", id_col) if best is not None else empty
    return ranked.select(F.col("item").cast(item_type).alias(item_col), "rank", id_col, "score")


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
a AS (SELECT q, item_id, term, count(*) AS repeats FROM (SELECT q, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM a) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * max(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY term),
i AS (SELECT p.r, p.term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(d.w) * n_docs) // n_terms)) AS impact FROM p JOIN d USING (r), s),
t AS (SELECT q, item_id, i.r, sum(repeats * weight * impact)::BIGINT AS score FROM a JOIN w USING (term) JOIN i USING (term) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT q, item_id, d.doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, d.doc_id NULLS LAST) AS rank FROM t JOIN d USING (r) WHERE score > 0) WHERE rank <= 10
"""
