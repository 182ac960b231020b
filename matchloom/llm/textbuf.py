"""Words, n-grams and their 64-bit names, computed over whole Arrow text columns at once.

A column's UTF-8 bytes are one NumPy array. Separators are ASCII, so words can be cut on bytes. A word's name is a
polynomial hash of its bytes from prefix sums, mixed afterwards; an n-gram's name combines those of its words. Equal
words get equal names in every task, so no dictionary is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

U64 = np.uint64
#: Bytes of text handled at a time; one longer document is handled alone.
PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer, elementwise."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTES_LOWER = _BYTES[_LOWER]
_P, _Q = 0x9E3779B97F4A7C15 | 1, 0xD1B54A32D192ED03 | 1
_PI = pow(_P, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but digits and letters (A-Z are lower-cased first).
NON_WORD = np.zeros(256, bool)
NON_WORD[:0x80] = True
NON_WORD[0x30:0x3A] = NON_WORD[0x41:0x5B] = NON_WORD[0x61:0x7B] = False

_POW = {_P: np.ones(1, U64), _PI: np.ones(1, U64)}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POW[base]) < n:
        x = np.full(max(n, PIECE), base, U64)
        x[0] = 1
        _POW[base] = np.multiply.accumulate(x)
    return _POW[base]


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each."""
    col = batch.column(column)
    if not len(col):
        return
    ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64))
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _length(k: int) -> np.uint64:
    return U64(k * 0xE7037ED1A0B428DB % (1 << 64))


class Words:
    """Words of a text column in order: ``doc`` (row), byte ``start`` and ``end``, name ``h``; ``first``/``count`` by row."""

    def __init__(self, col: pa.Array, sep: np.ndarray = SPACE, lower: bool = False):
        col = pa.compute.fill_null(col, "").cast(pa.large_string())
        col = pa.concat_arrays([col]) if col.offset else col
        offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        raw = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and offsets[-1] else np.empty(0, np.uint8)
        self.bytes = raw = raw[offsets[0] : offsets[-1]]
        self.offsets = offsets = offsets - offsets[0]
        n = len(raw)
        inside = ~sep[raw]
        cut = np.ones(n + 1, bool)
        cut[1:n] = ~inside[:-1] if n else cut[1:n]
        cut[offsets] = True
        self.start = np.flatnonzero(inside & cut[:n])
        gap = np.ones(n + 1, bool)
        gap[:n] = ~inside
        gap[offsets] = True
        self.end = np.flatnonzero(inside & gap[1:]) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.count = np.bincount(self.doc, minlength=len(col)).astype(np.int64)
        self.first = np.cumsum(self.count) - self.count
        v = (_BYTES_LOWER if lower else _BYTES)[raw]
        v *= _powers(_P, n)[:n]
        c = np.zeros(n + 1, U64)
        np.cumsum(v, out=c[1:])
        del v
        h = (c[self.end] - c[self.start]) * _powers(_PI, n + 1)[self.start]
        self.h = mix(h + (self.end - self.start).astype(U64) * U64(0xA0761D6478BD642F))

    def __len__(self) -> int:
        return len(self.h)

    def ranges(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Names (not mixed) of the word sequences [low, high)."""
        n = len(self.h)
        c = np.zeros(n + 1, U64)
        np.cumsum(self.h * _powers(_P, n)[:n], out=c[1:])
        return (c[high] - c[low]) * _powers(_PI, n + 1)[low] + (high - low).astype(U64) * U64(0xE7037ED1A0B428DB)

    def grams(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(index of its first word, name) of every run of k words within one row."""
        n = len(self.h) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, U64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        x = np.zeros(n, U64)
        q = 1
        for j in range(k):
            x += self.h[j : j + n] * U64(q)
            q = q * (_Q + 2 * salt) % (1 << 64)
        return at, mix(x[at] + _length(k))

    def short(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(row, name of its whole word sequence) of rows with 1 to k-1 words."""
        rows, names = [], []
        for m in range(1, k):
            r = np.flatnonzero(self.count == m)
            x, q = np.zeros(len(r), U64), 1
            for j in range(m):
                x += self.h[self.first[r] + j] * U64(q)
                q = q * (_Q + 2 * salt) % (1 << 64)
            rows.append(r)
            names.append(mix(x + _length(m)))
        return (np.concatenate(rows), np.concatenate(names)) if rows else (np.empty(0, np.int64), np.empty(0, U64))


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, name) of each row's distinct k-word shingles, by row and name; shorter rows have their whole sequence as one."""
    at, h = w.grams(k)
    r, s = w.short(k)
    doc, h = np.concatenate([w.doc[at], r]), np.concatenate([h, s])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    if len(doc):
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        doc, h = doc[new], h[new]
    return doc, h


def signed(x: np.ndarray) -> pa.Array:
    """Names as Spark's longs."""
    return pa.array(x.view(np.int64))
