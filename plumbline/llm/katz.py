"""Operator 5, language-model scoring with Katz backoff.

Model: P(w | h) = d(r) * r / c(h) for a pair seen r times in training, else alpha(h) * P(w), where d is the Good-Turing
discount of counts up to CUTOFF, alpha(h) = (1 - sum of the seen P(. | h)) / (1 - sum of the seen P(.)) normalises each
history exactly, and P(w) = (c(w) + 1) / (N + V + 1) covers V known words and one unknown one. An unseen history backs off
with weight 1. Counts above CUTOFF, which Good-Turing leaves as they are, lose TAIL, so that no history is left without mass.

Tables: words and pairs are kept as 64-bit hashes in `buckets` tables partitioned by the hash of the word (of word and history
for words that are a large share of all tokens). A scan packs each block of documents into one row per bucket: sorted
words, their histories, and which documents have the pair how often. A bucket's task sums the counts over all blocks, so c(w) and
r are exact there, and scores what depends on them at once: for each document how many tokens have r = 1..CUTOFF, the sum of
log r of the others, the unigram score. A token's history term -log c(h) is added where h itself is the word. Only what
depends on alpha(h), tokens whose pair was not seen, goes through a join on the history. Discounts come from counts of
counts that the same pass gives, so texts are scanned three times (sizes aside; twice for the very frequent words) and shuffled once.

The order is 2, so the recursion has one step: a block's trigrams would add some 8 bytes a token to the 14 that the shuffle has now,
about 2.9 GB for check_l's 130 million tokens against a disk budget of 2.04 GB.

Results per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null text is empty: only the end
token. A null id counts as training. Rows are scored one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import give_back, prepare, release, stored, table
from plumbline.llm.text import NOT_SPACE, chunks, pair_hash, word_hashes

CUTOFF = 5
TAIL = 0.1
#: Hashes of the start and end of a text. Words' hashes are 64 bits of theirs.
START, END = np.uint64(0x51A7), np.uint64(0xE2D)
#: Stands for a null id in a packed row.
NULL = -(2**63)
BUCKET_TOKENS = 2_500_000
#: Rows of a batch of results, and entries of a bucket that are counted at once.
ROWS = 100_000
BLOCK_BYTES = 3_000_000
BLOCK_ROWS = 30_000
#: A word with more than this share of a bucket's tokens is spread over all buckets by history.
HOT = 0.25


def held_out(ids: list) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids], bool)


def tokens(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words, histories, rows): each text's words and its end."""
    for i, data, off in chunks(texts):
        h, _, _, rows = word_hashes(data, off, NOT_SPACE)
        n = np.diff(rows)
        word = np.insert(h, rows[1:], END)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        first = rows[:-1] + np.arange(len(n))
        before[first] = START
        yield i, word, before, np.repeat(np.arange(len(n)), n + 1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, words, histories, rows) of runs of documents of bounded size."""
    ids: list = []
    parts: list = []
    have = 0
    for batch in batches:
        known = batch.column("id").to_pylist()
        for i, word, before, row in tokens(batch.column("text")):
            n = int(row[-1]) + 1 if len(row) else 0
            parts.append((word, before, row + len(ids)))
            ids += known[i : i + n]
            have += len(word)
            if have > BLOCK_BYTES // 6 or len(ids) > BLOCK_ROWS:
                yield ids, *(np.concatenate(x) for x in zip(*parts, strict=True))
                ids, parts, have = [], [], 0
    if ids:
        yield ids, *(np.concatenate(x) for x in zip(*parts, strict=True))
    del ids, parts
    give_back()


def _frequent(share: float, only: np.ndarray | None = None):
    """(word, n): counts in training of the words of a large share of a block, or of those given; word 0 counts all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, word, _, row in _blocks(batches):
            word = word[~held_out(ids)[row]]
            if only is None:
                w, n = np.unique(word, return_counts=True)
                top = n > share * len(word)
                w, n = w[top], n[top]
            else:
                at = np.searchsorted(only, word)
                at = at[only[np.minimum(at, len(only) - 1)] == word] if len(only) else at[:0]
                n = np.bincount(at, minlength=len(only))
                w = only
            yield pa.RecordBatch.from_arrays([pa.array(np.append(w, np.uint64(0)).view(np.int64)), pa.array(np.append(n, len(word)))], names=["word", "n"])

    return run


PACK = "bucket int, block long, w binary, wn binary, h binary, hi binary, hn binary, doc binary, n binary, rows binary, held binary, ids binary, tokens binary"


def sorted_bytes(x: np.ndarray) -> np.ndarray:
    """Rising 64-bit values as differences, byte plane after byte plane: their leading zeros compress."""
    return np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.copy()


def sorted_values(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def narrow(x: np.ndarray) -> np.ndarray:
    """Counts as bytes if all fit, else as 32-bit numbers."""
    return x.astype(np.uint8 if x.max(initial=0) < 256 else np.int32)


def wide(raw: bytes, n: int) -> np.ndarray:
    """The n counts of narrow()."""
    return np.frombuffer(raw, np.uint8 if len(raw) == n else np.int32)


def _pack(buckets: int, hot: np.ndarray):
    """One row for each bucket and block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        for number, (ids, word, before, row) in enumerate(_blocks(batches)):
            held = held_out(ids)
            count = np.bincount(row, minlength=len(ids))
            w, iw = np.unique(word, return_inverse=True)
            h, ih = np.unique(before, return_inverse=True)
            bits_d, bits_h = max(1, len(ids) - 1).bit_length(), max(1, len(h) - 1).bit_length()
            key = (iw.astype(np.int64) << (bits_d + bits_h)) | (ih.astype(np.int64) << bits_d) | row
            key.sort()
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(key)))
            key = key[at]
            doc, ih, iw = key & ((1 << bits_d) - 1), (key >> bits_d) & ((1 << bits_h) - 1), key >> (bits_d + bits_h)
            bucket = (w >> np.uint64(11)) % np.uint64(buckets)
            spread = np.isin(w, hot, assume_unique=True)
            entry = bucket[iw]
            if spread.any():
                some = spread[iw]
                entry[some] = pair_hash(w[iw[some]], h[ih[some]]) % np.uint64(buckets)
            order = np.argsort(entry.astype(np.int16 if buckets < 32_000 else np.int64), kind="stable")
            doc, ih, iw, n, entry = doc[order], ih[order], iw[order], n[order], entry[order]
            block = part << 20 | number
            # Only buckets that get something: at most as many rows as the block has pairs, however many buckets there are.
            for b in np.union1d(entry, [block % buckets]).tolist():
                s = slice(*np.searchsorted(entry, [b, b + 1]))
                home = block % buckets == b
                x, y = iw[s], ih[s]
                pair = np.ones(len(x), bool)
                pair[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
                p = np.flatnonzero(pair)
                first = np.ones(len(p), bool)
                first[1:] = x[p][1:] != x[p][:-1]
                f = np.flatnonzero(first)
                docs, local = np.unique(doc[s], return_inverse=True)
                hs, hi = np.unique(y[p], return_inverse=True)
                cols = [
                    sorted_bytes(w[x[p][f]]), narrow(np.diff(np.append(f, len(p)))), sorted_bytes(h[hs]), hi.astype(np.uint16 if len(hs) < 2**16 else np.uint32), narrow(np.diff(np.append(p, len(x)))),
                    local.astype(np.uint16), narrow(n[s]), docs.astype(np.int32), held[docs], count.astype(np.int32) if home else np.zeros(0, np.int32),
                    np.array([NULL if i is None else i for i in ids] if home else [], np.int64),
                ]
                raw = [pa.array([c.tobytes()], pa.binary()) for c in cols]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([block]), *raw[:9], raw[10], raw[9]], names=PACK.replace(",", "").split()[::2])

    return run


#: kind 0: of a document (key its row); 1: of a history, seen pairs; 2: of a history in a document, unseen tokens; 3: counts of counts (key r).
OUT = "kind int, key long, doc long, id long, tokens long, n1 long, n2 long, n3 long, n4 long, n5 long, x double, y double, known long"


def _score(hot: np.ndarray, hot_counts: np.ndarray):
    """The tables of one bucket, and all that they alone decide."""

    def frame(kind: int, key, **cols) -> pd.DataFrame:
        out = {"kind": np.full(len(key), kind, np.int32), "key": np.asarray(key, np.int64)}
        for name in ("doc", "id", "tokens", "n1", "n2", "n3", "n4", "n5", "x", "y", "known"):
            kind_ = np.float64 if name in "xy" else np.int64
            out[name] = np.asarray(cols[name], kind_) if name in cols else np.full(len(key), NULL if name == "id" else 0, kind_)
        return pd.DataFrame(out)

    def bucket(rows: list[dict]) -> Iterator[pd.DataFrame]:
        # Documents: blocks' row numbers are unique, so (block, row) is a document.
        base, key, held, parts, total = 0, [], [], [], 0
        for r in rows:
            docs = np.frombuffer(r["rows"], np.int32)
            key.append((np.int64(r["block"]) << 20) | docs)
            held.append(np.frombuffer(r["held"], bool))
            w, h = sorted_values(r["w"]), sorted_values(r["h"])
            hi, doc = np.frombuffer(r["hi"], np.uint16 if len(h) < 2**16 else np.uint32), np.frombuffer(r["doc"], np.uint16)
            parts.append((w, wide(r["wn"], len(w)), h, hi, wide(r["hn"], len(hi)), doc, base, wide(r["n"], len(doc))))
            base += len(docs)
            total += len(hi)
            if len(r["ids"]):
                tokens_ = np.frombuffer(r["tokens"], np.int32)
                yield frame(0, (np.int64(r["block"]) << 20) | np.arange(len(tokens_)), tokens=tokens_, id=np.frombuffer(r["ids"], np.int64))
        if not key:
            return
        key, held = np.concatenate(key), np.concatenate(held)
        doc_n = np.zeros((CUTOFF, base), np.int64)
        doc_x, doc_y, doc_known = np.zeros(base), np.zeros(base), np.zeros(base, np.int64)
        cc, vocabulary = np.zeros(CUTOFF + 2, np.int64), 0
        hist: list = []
        unseen: list = []
        # Words in ranges of their hash, so that the working set is a share of the bucket.
        slices_ = max(1, total // ROWS)
        cuts = [np.uint64(k * (2**64 // slices_)) for k in range(slices_)] + [None]
        ends = [(0, 0)] * len(parts)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            cw, ch, pt, dd, nn, ps = [], [], [], [], [], []
            n_pairs = 0
            for k, (w, wn, h, hi_, hn, doc, at_doc, n) in enumerate(parts):
                a = np.searchsorted(w, lo)
                z = len(w) if hi is None else np.searchsorted(w, hi)
                if a == z:
                    continue
                p0, e0 = ends[k]
                p1 = p0 + int(wn[a:z].sum(dtype=np.int64))
                e1 = e0 + int(hn[p0:p1].sum(dtype=np.int64))
                ends[k] = p1, e1
                cw.append(np.repeat(w[a:z], wn[a:z]))
                ch.append(h[hi_[p0:p1]])
                ps.append(np.repeat(np.arange(p1 - p0, dtype=np.int32) + np.int32(n_pairs), hn[p0:p1]))
                dd.append(doc[e0:e1].astype(np.int32) + np.int32(at_doc))
                nn.append(n[e0:e1].astype(np.int64))
                n_pairs += p1 - p0
            if not cw:
                continue
            cw, ch, ps, dd, nn = (np.concatenate(x) for x in (cw, ch, ps, dd, nn))
            words, iw = np.unique(cw, return_inverse=True)
            hists, ih = np.unique(ch, return_inverse=True)
            del cw, ch
            pair = iw.astype(np.int64) * len(hists) + ih
            pairs, ip = np.unique(pair, return_inverse=True)
            del pair
            train = np.where(held[dd], 0, nn)
            entry = ip[ps]
            r = np.bincount(entry, weights=train, minlength=len(pairs)).astype(np.int64)
            c = np.bincount(iw[ps], weights=train, minlength=len(words)).astype(np.int64)
            at = np.minimum(np.searchsorted(hot, words), max(0, len(hot) - 1))
            is_hot = hot[at] == words if len(hot) else np.zeros(len(words), bool)
            c[is_hot] = hot_counts[at[is_hot]]
            pw, ph = pairs // len(hists), pairs % len(hists)
            cc += np.bincount(np.minimum(r, CUTOFF + 2), minlength=CUTOFF + 3)[: CUTOFF + 2]
            vocabulary += int(((c > 0) & ~is_hot).sum())
            # Documents: tokens by r, log r of the rest, the unigram score, and -log c(h) where this word is the history.
            er, ew = r[entry], pw[entry]
            for k in range(CUTOFF):
                doc_n[k] += np.bincount(dd, weights=nn * (er == k + 1), minlength=base).astype(np.int64)
            log_c1, log_c = np.log10(c + 1.0), np.log10(np.maximum(c, 1))
            doc_x += np.bincount(dd, weights=nn * log_c1[ew], minlength=base)
            big = np.where(er > CUTOFF, np.log10(np.maximum(er, 1) - TAIL), 0.0) - np.where(words[ew] == END, 0.0, log_c[ew])
            doc_y += np.bincount(dd, weights=nn * big, minlength=base)
            doc_known += np.bincount(dd, weights=nn * (c[ew] > 0), minlength=base).astype(np.int64)
            # Histories: what their seen pairs take.
            seen = r > 0
            small = [np.bincount(ph, weights=r == k + 1, minlength=len(hists)) for k in range(CUTOFF)]
            rest = np.bincount(ph, weights=np.where(r > CUTOFF, r, 0), minlength=len(hists))
            tail = np.bincount(ph, weights=r > CUTOFF, minlength=len(hists))
            mass = np.bincount(ph, weights=np.where(seen, c[pw] + 1, 0), minlength=len(hists))
            some = mass > 0
            hist.append((hists[some], *(s[some].astype(np.int32) for s in small), rest[some], mass[some], tail[some].astype(np.int32)))
            # Unseen tokens: log10(c(w) + 1) is known here; their history's terms come with the join.
            new = np.flatnonzero(er == 0)
            unseen.append((hists[ph[entry[new]]], dd[new], nn[new], nn[new] * log_c1[ew[new]]))
        yield frame(0, key, x=doc_x, y=doc_y, known=doc_known, **{f"n{k + 1}": doc_n[k] for k in range(CUTOFF)})
        yield frame(3, np.arange(1, CUTOFF + 2), tokens=cc[1:])
        yield frame(3, [0], tokens=[vocabulary])
        for h, d, n, x in unseen:
            for at in range(0, len(h), ROWS):
                s = slice(at, at + ROWS)
                both = pd.DataFrame({"h": h[s].view(np.int64), "d": d[s], "n": n[s], "x": x[s]}).groupby(["h", "d"], as_index=False).sum()
                yield frame(2, both["h"].to_numpy(), doc=key[both["d"].to_numpy()], tokens=both["n"].to_numpy(), x=both["x"].to_numpy())
        del unseen[:], parts[:]
        if hist:
            hs, i = np.unique(np.concatenate([x[0] for x in hist]), return_inverse=True)
            sums = [np.bincount(i, weights=np.concatenate([x[k] for x in hist]), minlength=len(hs)) for k in range(1, CUTOFF + 4)]
            del hist[:]
            for at in range(0, len(hs), ROWS):
                s = slice(at, at + ROWS)
                yield frame(1, hs[s].view(np.int64), x=sums[CUTOFF][s], y=sums[CUTOFF + 1][s], known=sums[CUTOFF + 2][s].astype(np.int64), **{f"n{k + 1}": sums[k][s].astype(np.int64) for k in range(CUTOFF)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come bucket after bucket."""
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    yield from (pa.RecordBatch.from_pandas(f, preserve_index=False) for f in bucket(held))
                    held = []
                    give_back()
                held.append(row)
        if held:
            yield from (pa.RecordBatch.from_pandas(f, preserve_index=False) for f in bucket(held))
        del held
        give_back()

    return run


def discounts(counts: dict[int, int]) -> list[float]:
    """Good-Turing discounts d(1)..d(CUTOFF) from counts of counts; where these give none below 1, r loses TAIL."""
    n = [0.0] + [float(counts.get(r, 0)) for r in range(1, CUTOFF + 2)]
    top = (CUTOFF + 1) * n[CUTOFF + 1] / n[1] if n[1] else 1.0
    out = []
    for r in range(1, CUTOFF + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top) if n[r] and top < 1 else 1.0
        out.append(d if 0 < d < 1 else 1 - TAIL / r)
    return out


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    buckets = 1 + ((size["b"] or 0) // 6 + size["n"]) // bucket_tokens
    # Words that would fill a bucket: candidates from blocks' shares, then exact counts of those few.
    share = HOT / buckets
    # What blocks below share / 2 leave out is less than that share of all, so no hot word is missed; the sum of word 0, all tokens, is
    # the largest, and at most 2 / share words (one in bucket_tokens / 8 tokens) get to the driver.
    found = stored(docs.mapInArrow(_frequent(share / 2), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = found.where("word = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = found.where((F.col("word") != 0) & (F.col("n") > share / 2 * total)).collect()
    release(found)
    candidates = np.sort(np.array([t["word"] for t in top], np.int64).view(np.uint64))
    exact = docs.mapInArrow(_frequent(0, candidates), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {t["word"]: t["n"] for t in exact}
    train = counts.pop(0, 0)
    hot = np.sort(np.array([w for w, n in counts.items() if n > share * train], np.int64).view(np.uint64)) if buckets > 1 else np.zeros(0, np.uint64)
    hot_counts = np.array([counts[int(w)] for w in hot.view(np.int64)], np.int64)
    packed = docs.mapInArrow(_pack(buckets, hot), PACK)
    found = packed.repartition(4 * buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_score(hot, hot_counts), OUT)
    found = stored(found, "kind")
    per_r = {r["key"]: r["n"] for r in found.where("kind = 3").groupBy("key").agg(F.sum("tokens").alias("n")).collect()}
    vocabulary = per_r.pop(0, 0) + len(hot)
    d = discounts(per_r)
    norm = math.log10(train + vocabulary + 1)
    # alpha(h): one row for each history with seen pairs. c(h) is the sum of its pairs' counts.
    taken = sum((F.col(f"n{k + 1}") * ((k + 1) * d[k]) for k in range(CUTOFF)), F.col("rest") - TAIL * F.col("tail"))
    every = sum((F.col(f"n{k + 1}") * (k + 1) for k in range(CUTOFF)), F.col("rest"))
    sums = found.where("kind = 1").groupBy("key").agg(*(F.sum(f"n{k + 1}").alias(f"n{k + 1}") for k in range(CUTOFF)), F.sum("x").alias("rest"), F.sum("y").alias("mass"), F.sum("known").alias("tail"))
    sums = sums.select("key", every.cast("double").alias("c"), taken.cast("double").alias("taken"), "mass")
    left = 1 - F.col("taken") / F.col("c")
    lower = F.lit(float(train + vocabulary + 1)) - F.col("mass")
    alpha = F.log10(left) - F.log10(lower) + norm
    sums = sums.select("key", F.log10("c").alias("log_c"), alpha.alias("alpha"))
    unseen = found.where("kind = 2").select("key", "doc", "tokens", "x")
    unseen = unseen.join(sums, "key", "left")
    # The history term taken at the history's own word was -log c(h): undo it, and add the backed-off probability.
    back = F.col("x") + F.col("tokens") * (F.coalesce(F.col("alpha") + F.when(F.col("key") == int(START), F.lit(0.0)).otherwise(F.col("log_c")), F.lit(0.0)) - norm)
    zero = F.lit(0).cast("long")
    # Of seen tokens all is known by now but their first history: one sum a row goes through the shuffle.
    seen = F.col("y") + sum((F.col(f"n{k + 1}") * math.log10((k + 1) * d[k]) for k in range(CUTOFF)), F.lit(0.0))
    part = found.where("kind = 0").select("key", F.expr(f"nullif(id, {NULL + 1} - 1)").alias("id"), "tokens", "x", seen.alias("y"), "known", zero.alias("gone"))
    part = part.union(unseen.select(F.col("doc").alias("key"), F.lit(None).cast("long"), zero, F.lit(0.0), back, zero, F.when(F.col("key") == int(START), F.col("tokens")).otherwise(zero)))
    per = part.groupBy("key").agg(F.max("id").alias("id"), *(F.sum(c).alias(c) for c in ("tokens", "x", "y", "known", "gone")))
    # The first token's history is the start, which has no word of its own: its count is the number of training texts.
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 7 == 2, F.lit(False))
    starts = docs.where(~held).count()
    first = F.when(F.col("gone") > 0, 0.0).otherwise(-math.log10(max(1, starts)))
    return per.select(
        F.col("id").alias(id_col), held.alias("held_out"), F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(int(train)).cast("long").alias("train_tokens"),
        (F.col("x") - F.col("tokens") * norm).alias("base_score"), (F.col("y") + first).alias("score"),
    )


def op5_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"))
