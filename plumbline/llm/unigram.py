"""Operator 7, SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Pieces come from a model file (its path is a parameter). The given file is of the BPE kind: its scores are negated merge ranks, no
log probabilities. So `fit` learns those from the texts as the unigram trainer does: distinct segments of all texts are counted, and
rounds of expectation (forward-backward over all segmentations of each) and maximization (digammas of the expected counts)
follow; pieces of hardly any count go out of use, single characters stay. No text is left out, ids keep their pieces, and no
new pieces are sought. Without `fit`, the file's own scores are used. Decoding is exact under any. Spaces become markers, a
marker stands before the text, and the segmentation of the greatest score sum is taken; of equal sums the one whose last piece is
longest. A character that no piece covers costs UNKNOWN and becomes its UTF-8 bytes, as does a literal marker character, so
that decoding gives back every text exactly. Null and empty texts have no pieces.

Text is cut where no piece can reach across, before markers and around characters that only single pieces hold; segments
repeat, so each distinct one of a batch is segmented once. They walk the trie together in blocks of bounded size, one byte a step
in numpy, and the Viterbi steps run over all segments of a block at once. Memory is bounded by the batch; no row is cut short.

Rows are encoded one by one: ties and repeated rows give equal results, null ids pass through, an empty table gives an empty one, and
columns beyond id and text are ignored.
"""

from __future__ import annotations

import copy
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import give_back, prepare, release, stored, table
from plumbline.llm.text import chunks, prefix_hash, span_hash

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁".encode()
#: What a character outside all pieces costs beyond the least score.
UNKNOWN = 10.0
#: Bytes of distinct segments that one run of the Viterbi takes; a longer segment is a run of its own.
BLOCK_BYTES = 250_000
#: Bytes of distinct segments that a task of a round takes.
TASK_BYTES = 1_000_000
#: Rounds of expectation and maximization.
ROUNDS = 4
#: Expected counts are summed as whole multiples of 1 / UNIT, so that sums and scores do not hang on the order of tasks.
UNIT = 1 << 16
#: A piece of a lower expected count goes out of use, as in the trainer of the library.
LEAST_COUNT = 0.5


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of log gamma, for x > 0."""
    x, out = x.astype(float), np.zeros(len(x))
    for _ in range(7):
        small = x < 7
        out[small] -= 1 / x[small]
        x[small] += 1
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def by_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by place, and the bounds of equal places in it. Short keys sort by radix."""
    key = place.astype(np.int16) if place.max(initial=0) < 2**15 else place
    order = np.argsort(key, kind="stable")
    return order, np.append(np.flatnonzero(np.diff(key[order], prepend=-1)), len(order))


class Trie:
    """A double-array trie over bytes: from state s byte b leads to base[s] + b if check of that place is s."""

    def __init__(self, pieces: list[bytes]) -> None:
        kids: list[dict[int, int]] = [{}]
        self_value = [-1]
        for i, piece in enumerate(pieces):
            node = 0
            for b in piece:
                nxt = kids[node].get(b)
                if nxt is None:
                    nxt = kids[node][b] = len(kids)
                    kids.append({})
                    self_value.append(-1)
                node = nxt
            self_value[node] = i if self_value[node] < 0 else self_value[node]
        size = 256 + 2 * len(kids)
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = np.ones(size, bool)
        free[0] = False
        at = {0: 0}
        low = 1
        queue = [0]
        for node in queue:
            here = at[node]
            self.value[here] = self_value[node]
            if not kids[node]:
                self.base[here] = size  # leads nowhere
                continue
            codes = np.fromiter(kids[node], np.int64)
            while not free[low]:
                low += 1
            # The first place where all children are free, tried for a window of free places at once.
            least, seen, span, b = int(codes.min()), low, 64, None
            while b is None:
                if seen + span + 300 >= len(free):
                    more = len(free)
                    free = np.concatenate([free, np.ones(more, bool)])
                    self.base, self.check, self.value = (np.concatenate([x, np.full(more, f, np.int32)]) for x, f in ((self.base, 0), (self.check, -1), (self.value, -1)))
                tries = np.flatnonzero(free[seen : seen + span]) + seen - least
                tries = tries[tries >= 0]
                fits = free[tries[:, None] + codes].all(axis=1) if len(codes) > 1 else np.ones(len(tries), bool)
                b = int(tries[fits.argmax()]) if fits.any() else None
                seen, span = seen + span, min(4 * span, 4_096)
            self.base[here] = b
            free[b + codes] = False
            self.check[b + codes] = here
            for c, k in kids[node].items():
                at[k] = b + c
                queue.append(k)
        self.base[self.base == size] = len(self.check)
        # Steps beyond the end of the arrays find a place that no state owns.
        self.base, self.check, self.value = (np.concatenate([x, np.full(300, f, np.int32)]) for x, f in ((self.base, 0), (self.check, -1), (self.value, -1)))


class Pieces:
    """What encoding and decoding need of a model."""

    def __init__(self, path: str = MODEL, names: list[tuple[str, float, str]] | None = None) -> None:
        rows = names or self.read(path)
        self.fallback = np.full(256, -1, np.int32)
        self.bytes = [b""] * len(rows)
        ids, raw = [], []
        for i, (name, _, kind) in enumerate(rows):
            if kind == "byte":
                value = int(name[3:5], 16)
                self.fallback[value] = i
                self.bytes[i] = bytes([value])
            elif kind == "normal":
                ids.append(i)
                raw.append(name.encode())
                self.bytes[i] = name.encode().replace(MARKER, b" ")
        self.ids, self.scores = np.array(ids, np.int32), np.array([rows[i][1] for i in ids])
        self.trie = Trie(raw)
        self.least = float(self.scores.min(initial=0.0)) - UNKNOWN
        # Characters (by lead byte) after which, and before which, pieces go on: elsewhere a text can be cut.
        self.joins_marker = any(MARKER in r[1:] and not r.startswith(MARKER * (r.count(MARKER))) for r in raw)
        inner = set().union(*(set(r) for r in raw if len(r.decode()) > 1)) if raw else set()
        #: ASCII bytes that stand in no piece of several characters.
        self.alone = np.array([b < 128 and b not in inner for b in range(256)])
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.offsets = np.cumsum(self.lengths) - self.lengths

        #: Characters of each piece.
        self.chars = np.array([len(r.decode()) for r in raw], np.int64)

    def fitted(self, log_p: np.ndarray) -> Pieces:
        """The same pieces with log probabilities for scores. Those of -inf go out of use; single characters among them get the least."""
        out = copy.copy(self)
        least = float(log_p[np.isfinite(log_p)].min())
        out.scores = np.where((self.chars == 1) & ~np.isfinite(log_p), least, log_p)
        out.trie = copy.copy(self.trie)
        used = np.append(np.isfinite(out.scores), False)
        out.trie.value = np.where(used[self.trie.value], self.trie.value, -1).astype(np.int32)
        out.least = least - UNKNOWN
        return out

    def maximized(self, counts: np.ndarray) -> Pieces:
        """The pieces with the scores that expected counts give."""
        log_p = np.full(len(counts), -np.inf)
        used = counts >= LEAST_COUNT
        if not used.any():
            return self
        log_p[used] = digamma(counts[used]) - digamma(counts[used].sum(keepdims=True))
        return self.fitted(log_p)

    @staticmethod
    def read(path: str) -> list[tuple[str, float, str]]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"
        return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]

    def segments(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Places where segments start, in texts of bytes whose spaces are markers (one byte, 0, stands for a marker)."""
        start = np.zeros(len(data), bool)
        if not len(data):
            return np.flatnonzero(start)
        start[off[:-1][off[:-1] < len(data)]] = True
        marker = data == 0
        if not self.joins_marker:
            start[1:] |= marker[1:] & ~marker[:-1]
        alone = self.alone[data] & ~marker
        start |= alone
        start[1:] |= alone[:-1]
        return np.flatnonzero(start)

    def lattice(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(bytes, segments' first, segments' end, starts, lengths, gains, pieces): all places of all pieces in the segments; -1 is a lone character."""
        # Markers take their three bytes, so that the trie sees what the pieces hold.
        wide = np.where(data == 0, 3, 1)
        at = np.cumsum(wide) - wide
        flat = np.empty(int(wide.sum()), np.uint8)
        flat[at] = np.where(data == 0, MARKER[0], data)
        m = at[data == 0]
        flat[m + 1], flat[m + 2] = MARKER[1], MARKER[2]
        literal = np.zeros(len(flat), bool)
        raw = np.flatnonzero((data[:-2] == MARKER[0]) & (data[1:-1] == MARKER[1]) & (data[2:] == MARKER[2])) if len(data) > 2 else np.zeros(0, np.int64)
        literal[at[raw]] = True
        n = len(flat)
        end_at = np.append(at, n)
        first, end = end_at[first], end_at[first + size]
        seg_end = np.repeat(end, end - first)
        lead = (flat & 0xC0) != 0x80
        lead_at = np.flatnonzero(lead)
        # Every match of every piece, byte by byte down the trie.
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        pos, state, depth = lead_at[~literal[lead_at]], np.zeros(int((~literal[lead_at]).sum()), np.int64), 0
        starts, lens, which = [], [], []
        while len(pos):
            go = pos + depth < seg_end[pos]
            pos, state = pos[go], state[go]
            # A literal marker character inside a piece would decode to a space.
            nxt = base[state] + flat[pos + depth].astype(np.int64)
            ok = (check[nxt] == state) & ~literal[pos + depth]
            pos, state, depth = pos[ok], nxt[ok], depth + 1
            hit = value[state] >= 0
            starts.append(pos[hit])
            lens.append(np.full(int(hit.sum()), depth))
            which.append(value[state[hit]])
        starts, lens, which = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, lens, which))
        # A character that no piece is: its bytes.
        width = np.diff(np.append(lead_at, n))
        single = np.zeros(n, bool)
        char = np.zeros(n, np.int64)
        char[lead_at] = width
        single[starts[lens == char[starts]]] = True
        lone = lead_at[~single[lead_at]]
        starts = np.concatenate([starts, lone])
        lens = np.concatenate([lens, char[lone]])
        gain = np.concatenate([self.scores[which], np.full(len(lone), self.least)]) if len(which) else np.full(len(lone), self.least)
        which = np.concatenate([which, np.full(len(lone), -1)])
        return flat, first, end, starts, lens, gain, which

    def expected(self, data: np.ndarray, first: np.ndarray, size: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces over all segmentations of the segments, each taken `weight` times, in units of 1 / UNIT."""
        _, first, end, starts, lens, gain, which = self.lattice(data, first, size)
        seg = np.repeat(np.arange(len(first)), end - first)[starts]
        # As in viterbi(): a place for each byte and one more for the end of each segment.
        source = starts + seg
        target = source + lens
        goal, origin = end + np.arange(len(first)), first + np.arange(len(first))
        # Pieces of one start have different ends and pieces of one end different starts, so no sum meets itself.
        a, b = np.full(int(end[-1]) + len(first), -np.inf), np.full(int(end[-1]) + len(first), -np.inf)
        a[origin] = b[goal] = 0.0
        for place, total, here, there in ((starts - first[seg], a, source, target), (end[seg] - starts - lens, b, target, source)):
            order, bounds = by_place(place)
            here, there, more = here[order], there[order], gain[order]
            for i, j in zip(bounds[:-1], bounds[1:], strict=True):
                at = there[i:j]
                total[at] = np.logaddexp(total[at], total[here[i:j]] + more[i:j])
        share = np.exp(a[source] + gain + b[target] - a[goal][seg])
        known = which >= 0
        return np.bincount(which[known], weights=np.rint(share[known] * weight[seg[known]] * UNIT), minlength=len(self.ids)).astype(np.int64)

    def occurring(self, data: np.ndarray, first: np.ndarray, size: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Characters in all places of each piece, overlapping ones too, in units of 1 / UNIT: the counts that the first round starts from."""
        _, first, _, starts, _, _, which = self.lattice(data, first, size)
        known = which >= 0
        seg = np.searchsorted(first, starts[known], "right") - 1
        return np.bincount(which[known], weights=weight[seg] * self.chars[which[known]] * UNIT, minlength=len(self.ids)).astype(np.int64)

    def viterbi(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids' offsets, score) of the segments data[first : first + size]; byte 0 is a marker and 255 a NUL."""
        if not len(first):
            return np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0)
        flat, first, end, starts, lens, gain, which = self.lattice(data, first, size)
        n = len(flat)
        seg_first = np.repeat(first, end - first)
        # Viterbi: all pieces that start at the k-th byte of their segments at once; their ends differ, so none meets another.
        k = starts - seg_first[starts] if n else starts
        order, bounds = by_place(k)
        starts, lens, gain, which = starts[order], lens[order], gain[order], which[order]
        best, back = np.full(n + 1, -np.inf), np.full(n + 1, -1, np.int64)
        # The score at the end of a segment is kept at its last byte + 1 of an array with a gap for each segment.
        shift = np.zeros(n + 1, np.int64)
        seg_no = np.repeat(np.arange(len(first)), end - first)
        shift[:n] = seg_no
        best, back = np.full(n + len(first) + 1, -np.inf), np.full(n + len(first) + 1, -1, np.int64)
        best[first + np.arange(len(first))] = 0.0
        source = starts + shift[starts]
        target = source + lens
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            s, t = source[a:b], target[a:b]
            new = best[s] + gain[a:b]
            up = new > best[t]
            best[t[up]] = new[up]
            back[t[up]] = np.arange(a, b)[up]
        # Backwards from all ends at once.
        where = end + np.arange(len(first))
        goal = first + np.arange(len(first))
        score = best[where]
        live = np.flatnonzero(where > goal)
        got_seg, got_piece = [], []
        where = where.copy()
        while len(live):
            piece = back[where[live]]
            got_seg.append(live)
            got_piece.append(piece)
            where[live] = source[piece]
            live = live[where[live] > goal[live]]
        if not got_seg:
            return np.zeros(0, np.int32), np.zeros(len(first) + 1, np.int64), score
        seg, piece = np.concatenate(got_seg)[::-1], np.concatenate(got_piece)[::-1]
        order = np.argsort(seg, kind="stable")
        seg, piece = seg[order], piece[order]
        # Ids; an uncovered character gives one for each of its bytes.
        lone = which[piece] < 0
        count = np.where(lone, lens[piece], 1)
        out = np.repeat(self.ids[np.maximum(which[piece], 0)] if len(self.ids) else np.zeros(len(piece), np.int32), count)
        inner = np.arange(len(out)) - np.repeat(np.cumsum(count) - count, count)
        from_bytes = np.repeat(lone, count)
        raw = flat[(np.repeat(starts[piece], count) + inner)[from_bytes]]
        out[from_bytes] = self.fallback[np.where(raw == 255, 0, raw)]
        return out.astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(seg, weights=count, minlength=len(first)).astype(np.int64))]), score

    def marked(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, rows' offsets, segments' first, segments' last + 1) of texts with their markers."""
        # A marker before each text that isn't empty; 0 stands for markers. NUL itself becomes the byte 255, which UTF-8 lacks.
        full = np.flatnonzero(np.diff(off))
        data = np.insert(np.where(data == 32, 0, np.where(data == 0, 255, data)).astype(np.uint8), off[:-1][full], 0)
        off = off + np.concatenate([[0], np.cumsum(np.diff(off) > 0)])
        first = self.segments(data, off)
        return data, off, first, np.append(first[1:], len(data))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, rows' offsets) of a column of texts."""
        all_ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for _, data, off in chunks(texts):
            data, off, first, last = self.marked(data, off)
            h = span_hash(prefix_hash(data), first, last)
            _, sample, which = np.unique(h, return_index=True, return_inverse=True)
            ids, at = self._blocks(data, first[sample], (last - first)[sample])
            count = np.diff(at)[which]
            if len(count):
                all_ids.append(ids[np.repeat(at[:-1][which] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))])
            row = np.searchsorted(off, first, "right") - 1
            sizes.append(np.bincount(row, weights=count, minlength=len(off) - 1).astype(np.int64))
        size = np.concatenate(sizes)
        return np.concatenate(all_ids), np.concatenate([[0], np.cumsum(size)])

    def _blocks(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids' offsets) of the segments, BLOCK_BYTES of them at a time: what the Viterbi arrays hold stays bounded."""
        block = (np.cumsum(size) - size) // BLOCK_BYTES
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(first)]])
        out, count = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            a, n = first[lo:hi], size[lo:hi]
            place = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            ids, at, _ = self.viterbi(data[place], np.cumsum(n) - n, n)
            out.append(ids)
            count.append(np.diff(at))
        return np.concatenate(out), np.cumsum(np.concatenate(count))

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, rows' offsets): markers become spaces, and the first of each text goes."""
        size = self.lengths[ids]
        out = self.blob[np.repeat(self.offsets[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        ends = np.concatenate([[0], np.cumsum(size)])[off]
        full = np.flatnonzero(np.diff(ends))
        return np.delete(out, ends[:-1][full]), ends - np.concatenate([[0], np.cumsum(np.diff(ends) > 0)])


#: The pieces of a model, built once a process.
loaded = functools.cache(Pieces)


def _encode(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, off = pieces.encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), lists], names=[*(c for c in batch.schema.names if c != "text"), "ids"])
            del ids, off, lists
        give_back()

    return run


def _decode(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, off = pieces.decode(flat, np.concatenate([[0], np.cumsum(size)]))
            text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
            rest = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), text.cast(pa.binary()).cast(pa.string())], names=[*rest, "text"])

    return run


def _segments(pieces: Pieces):
    """The distinct segments of a run of rows, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, off in chunks(batch.column("text")):
                data, off, first, last = pieces.marked(data, off)
                _, sample, count = np.unique(span_hash(prefix_hash(data), first, last), return_index=True, return_counts=True)
                first, size = first[sample], (last - first)[sample]
                at = np.cumsum(size) - size
                flat = data[np.repeat(first - at, size) + np.arange(int(size.sum()))]
                segment = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.append(at, len(flat)).astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([segment.cast(pa.binary()), pa.array(count.astype(np.int64))], names=["segment", "n"])
        give_back()

    return run


def _counts(pieces: Pieces, kernel: str):
    """What a kernel counts for each piece over the segments of a task, BLOCK_BYTES of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pieces.ids), np.int64)
        held: list[bytes] = []
        weights: list[np.ndarray] = []

        def done() -> None:
            size = np.fromiter(map(len, held), np.int64, len(held))
            total[:] += getattr(pieces, kernel)(np.frombuffer(b"".join(held), np.uint8), np.cumsum(size) - size, size, np.concatenate(weights))
            held.clear()
            weights.clear()

        have = 0
        for batch in batches:
            held += batch.column("segment").to_pylist()
            weights.append(batch.column("n").to_numpy(zero_copy_only=False))
            have += batch.column("segment").nbytes
            if have > BLOCK_BYTES:
                done()
                have = 0
        if held:
            done()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["piece", "x"])
        give_back()

    return run


def fit(docs: DataFrame, text_col: str = "text", model: str = MODEL, rounds: int = ROUNDS) -> Pieces:
    """The pieces of the model with log probabilities learned from all texts; with the model's own scores if there is no text.

    Only sums by piece come to the driver, as many as the model has pieces.
    """
    spark = docs.sparkSession
    prepare(spark)
    pieces = loaded(model)
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(_segments(pieces), "segment binary, n long")
    distinct = stored(found.groupBy("segment").agg(F.sum("n").alias("n")))
    size = distinct.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    segments = stored(distinct.repartition(1 + size // TASK_BYTES))
    release(distinct)

    def counts(kernel: str) -> np.ndarray:
        out = np.zeros(len(pieces.ids))
        for piece, x in segments.mapInArrow(_counts(pieces, kernel), "piece int, x long").groupBy("piece").agg(F.sum("x")).collect():
            out[piece] = x / UNIT
        return out

    seed = counts("occurring")
    if seed.any():
        with np.errstate(divide="ignore"):
            pieces = pieces.fitted(np.log(seed / seed.sum()))
        for _ in range(rounds):
            pieces = pieces.maximized(counts("expected"))
    release(segments)
    return pieces


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, pieces: Pieces | None = None) -> DataFrame:
    """(id, ids array<int>) of each row, by pieces from fit() or else by the model's own scores."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_encode(pieces or loaded(model)), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, text) of each row of ids."""
    prepare(encoded.sparkSession)
    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(_decode(loaded(model)), f"id {kind}, text string").withColumnRenamed("id", id_col)


def _round_trip(pieces: Pieces):
    """Encode, decode and compare; per row the number of pieces, of byte pieces, a digest of the ids, and equality."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte = np.isin(np.arange(len(pieces.bytes)), pieces.fallback)
        for batch in batches:
            texts = batch.column("text")
            ids, off = pieces.encode(texts)
            data, at = pieces.decode(ids.astype(np.int64), off)
            raw, out = ids.astype("<i4").tobytes(), data.tobytes()
            n_byte = np.concatenate([[0], np.cumsum(byte[ids])])
            same = [out[a:b] == (t or "").encode() for a, b, t in zip(at[:-1], at[1:], texts.to_pylist(), strict=True)]
            digest = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(off)), pa.array(n_byte[off[1:]] - n_byte[off[:-1]]), pa.array(digest), pa.array(same)], names=["id", "n_pieces", "n_byte_pieces", "ids_sha256", "round_trip"])

    return run


def op7_sentencepiece(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    """Each document's segmentation by scores learned from all documents, and whether decoding gives the text back."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return docs.mapInArrow(_round_trip(fit(docs, model=model)), "id long, n_pieces long, n_byte_pieces long, ids_sha256 string, round_trip boolean").withColumnRenamed("id", "doc_id")
