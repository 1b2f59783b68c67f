"""Numpy work on Arrow batches of texts: words, hashes, shingles, all as flat arrays with offsets.

Texts are UTF-8 bytes. Words are runs of bytes that a 256-entry table marks, so a class of ASCII
separators never splits a character. A null text is an empty one. Long batches are worked through
in pieces of about `PIECE` bytes, so memory is bounded by that and by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_BLOCK = 1 << 17
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], dtype=bool)


#: words between whitespace: [^\x20\x09-\x0D]+
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: words of letters, digits and all that is not ASCII, on lower-cased bytes
ALNUM = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
#: A-Z to a-z
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their n + 1 offsets."""
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    arr = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = arr.buffers()
    offs = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about `size` bytes together."""
    data, offs = flat(column)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def spans(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the n + 1 offsets of each row's words among them."""
    inside = table[data]
    if len(inside) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    cuts = offs[:-1][offs[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    cuts = offs[1:][offs[1:] > 0] - 1
    after[cuts] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_Powers.up) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            setattr(_Powers, name, np.cumprod(steps))
    return _Powers.up[:n], _Powers.down[:n]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span: its bytes as digits of a number, mixed with its length."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + _BLOCK, "right")))
        top = int(ends[j - 1]) - base
        up, down = _powers(max(top, _BLOCK))
        sums = np.zeros(top + 1, np.uint64)
        np.cumsum((data[base : base + top].astype(np.uint64) + np.uint64(1)) * up[:top], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * _MIX[1] + np.uint64(seed))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive entries; k - 1 fewer than there are entries, at least none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= _BASE
        out += h[i : i + n]
    return mix(out + np.uint64(k))


def shingle_set(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct k-word shingles of one text's word hashes; fewer words are one shingle."""
    if len(h) == 0:
        return h
    return np.unique(grams(h, min(k, len(h))))


def row_words(column: pa.Array, table: np.ndarray, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every text."""
    for i, _, data, offs in pieces(column):
        if lower:
            data = LOWER[data]
        starts, ends, wo = spans(data, offs, table)
        h = hashes(data, starts, ends)
        for r in range(len(wo) - 1):
            yield i + r, h[wo[r] : wo[r + 1]]


def int64s(values) -> pa.Array:
    """Unsigned 64-bit hashes as the signed longs that Spark has."""
    return pa.array(np.asarray(values, np.uint64).view(np.int64), pa.int64())


def sliced(batches, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, where a task makes more of each row than it reads."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
