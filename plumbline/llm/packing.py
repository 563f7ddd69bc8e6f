"""Operator 11, harmonic packing of tokenised documents into sequences.

Method: class k holds pieces of length in (capacity / (k + 1), capacity / k], and a sequence of class k takes just k pieces, whatever they are,
so a worker fills its sequences as pieces come, by counting alone, and workers need not know of each other. A document gives whole
sequences (class 1) and a rest; a rest that would leave over WASTE of its class's sequence open is cut at the next class's upper
bound, capacity // (k + 1), which fills that class, and what is left of it is classed in turn. Sequences that a worker could
not fill (under k pieces of each class) meet those of SPAN workers, then of SPAN such groups, and so on; the last few, of all
classes and bounded in number by the classes alone, are packed by first fit, longest first.

Texts are tokenised where they are read and never shuffled; only pieces of unfilled sequences are. Tokens come from the given tokenizer
(its file is a parameter). A worker keeps ids of the words that it has met, up to a bound; words are cut where the tokenizer
cuts in any case (white space, and between an ASCII letter and another ASCII character that no apostrophe precedes).

Results per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with tokens=True the ids. `sequences` puts the
pieces of a sequence together and pads them, but not where their length is a power of two. Each row is a document, repeated rows too; null and empty texts
have the end id alone; a null id stays. An empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import prepare, stored, table
from plumbline.llm.text import NOT_SPACE, chunks, prefix_hash, span_hash

CAPACITY = 2_048
#: Share of a sequence that its class may leave open.
WASTE = 1 / 32
#: Workers whose unfilled sequences meet in one task.
SPAN = 64
END = 1
#: Words that a worker keeps at most.
KEPT_WORDS = 500_000
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
APOSTROPHE = 39
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, worker long, sequence_id long, offset long"


def spans(data: np.ndarray, off: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, rows' first) of the parts of texts that the tokenizer treats apart; special tokens' strings stay whole."""
    mask, letter, plain = NOT_SPACE[data], LETTER[data], data < 128
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = (letter[1:] != letter[:-1]) & plain[1:] & plain[:-1] & (data[:-1] != APOSTROPHE)
    raw = data.tobytes()
    for token in special:
        at = raw.find(token)
        while at >= 0:
            edge[at + 1 : at + len(token)] = False
            at = raw.find(token, at + 1)
    edge[off] = edge[0] = edge[-1] = True
    first, last = mask & edge[:-1], mask & edge[1:]
    first[1:] |= mask[1:] & ~mask[:-1]
    last[:-1] |= mask[:-1] & ~mask[1:]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


class Encoder:
    """The ids of texts, with those of words met before kept."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [str(t.content).encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, hashes: list[int], words: list[bytes]) -> None:
        """Letters alone go straight to the tokenizer's model, as nothing in them is to be normalised or split but for their case."""
        rest = [w.decode() for w in words if not w.isalpha()]
        model, encoded = self.tokenizer.model, iter(self.tokenizer.encode_batch(rest, add_special_tokens=False))
        new = [[t.id for t in model.tokenize(w.decode().lower())] if w.isalpha() else next(encoded).ids for w in words]
        sizes = np.array([len(x) for x in new], np.int64)
        self.known.update(zip(hashes, range(len(self.sizes), len(self.sizes) + len(new)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.ids = np.concatenate([self.ids, np.array([i for x in new for i in x], np.uint32)])
        self.sizes = np.concatenate([self.sizes, sizes])

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, rows' first) of texts, the end id after each."""
        start, end, rows = spans(data, off, self.special)
        hashes, at, word = np.unique(span_hash(prefix_hash(data), start, end), return_index=True, return_inverse=True)
        if len(self.known) > KEPT_WORDS:
            self.forget()
        names = hashes.tolist()
        new = [k for k, h in enumerate(names) if h not in self.known]
        if new:
            raw = data.tobytes()
            self.learn([names[k] for k in new], [raw[start[at[k]] : end[at[k]]] for k in new])
        which = np.array([self.known[h] for h in names], np.int64)[word]
        n = self.sizes[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.starts[which] - upto[:-1], n) + np.arange(upto[-1])]
        return np.insert(ids, upto[rows[1:]], END).astype("<u4"), upto[rows] + np.arange(len(rows))


@lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(tokens: np.ndarray, capacity: int = CAPACITY, waste: float = WASTE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, class) of the pieces of documents of so many tokens, a document's in order."""
    rows = np.arange(len(tokens))
    full = tokens // capacity
    row = [np.repeat(rows, full)]
    start = [(np.arange(len(row[0])) - np.repeat(np.cumsum(full) - full, full)) * capacity]
    size, kind = [np.full(len(row[0]), capacity)], [np.ones(len(row[0]), np.int64)]
    at, rest = full * capacity, tokens % capacity
    while (rest > 0).any():
        rows, at, rest = (x[rest > 0] for x in (rows, at, rest))
        k = capacity // rest
        whole = (capacity - k * rest <= waste * capacity) | (k >= 1 / waste)
        take = np.where(whole, rest, capacity // (k + 1))
        for to, x in ((row, rows), (start, at), (size, take), (kind, np.where(whole, k, k + 1))):
            to.append(x)
        at, rest = at + take, rest - take
    out = [np.concatenate(x) for x in (row, start, size, kind)]
    order = np.lexsort((out[1], out[0]))
    return tuple(x[order] for x in out)


def fill(kind: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, whether it is full) of pieces of given classes, by counting: each next k pieces of class k are a sequence."""
    order = np.argsort(kind, kind="stable")
    k, size = kind[order], length[order]
    place = np.arange(len(k)) - np.searchsorted(k, k)
    number = place // np.maximum(k, 1)
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (number[1:] != number[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
    before = np.cumsum(size) - size
    full = number < (np.searchsorted(k, k, "right") - np.searchsorted(k, k)) // np.maximum(k, 1)
    out = np.empty(len(k), np.int64), np.empty(len(k), np.int64), np.empty(len(k), bool)
    for to, x in zip(out, (number, before - before[head], full), strict=True):
        to[order] = x
    return out


def first_fit(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) by first fit, longest first: for the few pieces that are left."""
    room = np.zeros(0, np.int64)
    number, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    for i in np.argsort(-length, kind="stable"):
        fits = np.flatnonzero(room >= length[i])
        if not len(fits):
            room, fits = np.append(room, capacity), [len(room)]
        number[i], offset[i] = fits[0], capacity - room[fits[0]]
        room[fits[0]] -= length[i]
    return number, offset


def sequence_ids(turn: int, worker: int, kind: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Unique over turns (3 bits), workers (24 bits), classes (12 bits) and sequences of a class (24 bits)."""
    return (turn << 60) + (worker << 36) + (kind.astype(np.int64) << 24) + number


def _pack(path: str, capacity: int, waste: float, tokens: bool):
    """Pieces of a worker's documents: of full sequences as they fill, the others at the end without a sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, worker = encoder(path), TaskContext.get().partitionId()
        waiting: pa.Table | None = None
        used = np.zeros(capacity + 1, np.int64)
        names = [c.split()[0] for c in PIECE.split(", ")]

        def rows(pieces: pa.Table, number: np.ndarray | None, offset: np.ndarray | None) -> list[pa.RecordBatch]:
            n, kind = pieces.num_rows, pieces.column("class").to_numpy()
            seq = pa.nulls(n, pa.int64()) if number is None else pa.array(sequence_ids(0, worker, kind, number))
            pieces = pieces.append_column("worker", pa.array(np.full(n, worker))).append_column("sequence_id", seq).append_column("offset", pa.nulls(n, pa.int64()) if offset is None else pa.array(offset))
            return pieces.select([*names, *(["ids"] if tokens else [])]).combine_chunks().to_batches()

        for batch in batches:
            for i, data, off in chunks(batch.column("text")):
                ids, first = encode(data, off)
                total = np.diff(first)
                row, start, length, kind = cut(total, capacity, waste)
                at = first[row] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                columns = {"doc_id": batch.column("id").slice(i, len(total)).take(pa.array(row)), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(total[row]), "class": pa.array(kind.astype(np.int32))}
                if tokens:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(at, first[-1]).astype(np.int32)), pa.array(ids.astype(np.int64)))
                new = pa.table(columns)
                waiting = new if waiting is None else pa.concat_tables([waiting, new])
                kind = waiting.column("class").to_numpy()
                number, offset, full = fill(kind, waiting.column("length").to_numpy())
                number += used[kind]
                done = pa.array(full)
                yield from rows(waiting.filter(done), number[full], offset[full])
                np.maximum.at(used, kind[full], number[full] + 1)
                waiting = waiting.filter(pa.array(~full)).combine_chunks()
        if waiting is not None:
            yield from rows(waiting, None, None)

    return run


def _join(turn: int, capacity: int, last: bool):
    """Unfilled sequences of several workers: full ones of each class again, and in the last turn the rest by first fit."""

    def run(part: pa.Table) -> pa.Table:
        kind, length = part.column("class").to_numpy(), part.column("length").to_numpy()
        worker = part.column("worker")[0].as_py()
        number, offset, full = fill(kind, length)
        name = sequence_ids(turn, worker, kind, number)
        known = full.copy()
        if last and not full.all():
            number, offset[~full] = first_fit(length[~full], capacity)
            name[~full] = sequence_ids(turn, worker, np.zeros(len(number)), number)
            known[:] = True
        for column, x in (("sequence_id", name), ("offset", offset)):
            part = part.set_column(part.schema.get_field_index(column), column, pa.array(x, pa.int64(), mask=~known))
        return part

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, waste: float = WASTE, span: int = SPAN, tokens: bool = False) -> DataFrame:
    """One row a piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and ids if tokens."""
    prepare(docs.sparkSession)
    path = path or public_tokenizers.path("word_bpe_49k.json")
    kind = PIECE + (", ids array<long>" if tokens else "")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    pieces = stored(texts.mapInArrow(_pack(path, capacity, waste, tokens), kind))
    done = pieces.where("sequence_id is not null")
    left, workers, turn = pieces.where("sequence_id is null"), 1 + (pieces.agg(F.max("worker")).first()[0] or 0), 1
    # Groups of `span` workers, then of `span` groups: a group has under k pieces of class k from each.
    while workers > 1:
        workers = -(-workers // span)
        grouped = left.withColumn("worker", F.floor(F.col("worker") / span)).groupBy("worker", "class")
        both = stored(grouped.applyInArrow(_join(turn, capacity, False), kind))
        done = done.unionAll(both.where("sequence_id is not null"))
        left, turn = both.where("sequence_id is null"), turn + 1
    # Now under k pieces of each class: a number that the capacity alone bounds.
    done = done.unionAll(left.withColumn("worker", F.lit(0).cast("long")).groupBy("worker").applyInArrow(_join(turn, capacity, True), kind))
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class", *(["ids"] if tokens else [])]
    return done.select(F.col("doc_id").alias(id_col), *columns)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad: int = 0) -> DataFrame:
    """(sequence_id, tokens, ids) of packed pieces with ids: padded to the capacity, but not at a power of two."""
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    lacks = F.when(F.bit_count("tokens") == 1, 0).otherwise(capacity - F.col("tokens")).cast("int")
    return rows.withColumn("ids", F.concat("ids", F.array_repeat(F.lit(pad).cast("long"), lacks)))


def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("class")
