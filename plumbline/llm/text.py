"""Text kernels shared by the corpus operators: UTF-8 bytes, words and hashes in numpy.

All functions take a column of texts as an Arrow array and work on its bytes at once, so that a batch
costs a few passes of numpy and no Python loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Odd multipliers of the polynomial hashes and of the bit mixer. Fixed values.
BASE = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9
MIX2 = 0x94D049BB133111EB
CHUNK_BYTES = 2_000_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words between white space: every byte but space and 09-0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Words of letters and digits: 0-9, a-z after lowering, and all bytes of characters beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_rng = np.random.default_rng(20240229)
#: A random 64-bit value for each byte: the digits of the polynomial hashes.
DIGIT = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


class Powers:
    """BASE**i and BASE**-i modulo 2**64, grown when a longer text comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES + 1)
            inverse = pow(BASE, -1, 2**64)
            for name, b in (("up", BASE), ("down", inverse)):
                x = np.full(n, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up, self.down


POWERS = Powers()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash: span_hash() gets the hash of any span from them."""
    up, _ = POWERS.get(len(data) + 1)
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(DIGIT[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes start..end, the same wherever they stand."""
    _, down = POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def chunks(texts: pa.Array, most: int = CHUNK_BYTES):
    """(first row, bytes, offsets) of runs of rows of about `most` bytes; a longer text is a run of its own."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, rows' first words) of the words in lowered bytes; no word crosses two rows."""
    mask = is_word[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = False
    np.not_equal(mask[1:], mask[:-1], out=edge[1 : max(1, len(data))])
    inner = off[(off > 0) & (off < len(data))]
    first = mask.copy()
    first[1:] &= edge[1 : len(data)]
    first[inner] = mask[inner]
    last = np.zeros(len(data) + 1, bool)
    last[1:-1] = edge[1 : len(data)] & mask[:-1] if len(data) else False
    if len(data):
        last[-1] = mask[-1]
        last[inner] = mask[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As words(), with a 64-bit hash of each word; A-Z count as a-z."""
    low = LOWER[data]
    start, end, rows = words(low, off, is_word)
    return span_hash(prefix_hash(low), start, end), start, end, rows


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(MIX2) + mix(b ^ np.uint64(BASE)))
