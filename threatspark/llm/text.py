"""Words, lines and their 64-bit hashes, vectorised over Arrow text batches.

A word is a run of bytes other than blank and 0x09-0x0D. These separators are
ASCII, so splitting UTF-8 by bytes never cuts a character. A segment's hash is
a polynomial over random byte values modulo 2**64, read off one running sum
for any start and end, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # text handled at once, unless one document is longer

_CHUNK = 1 << 16
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII byte that is no letter or digit: for features made of bare words.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_BASE, _CHUNK), _powers(pow(_BASE, -1, 1 << 64), _CHUNK)
_BYTE = [mix(np.arange(256, dtype=np.uint64) + np.uint64(0x1234567 + 1000 * k)) for k in range(2)]
_LOWER = np.arange(256)
_LOWER[65:91] += 32


class Segments:
    """Hashes of byte ranges of one buffer; two families (0 and 1) make 128 bits."""

    def __init__(self, data: np.ndarray, lower: bool = False, family: int = 0):
        table, n = _BYTE[family][_LOWER] if lower else _BYTE[family], len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        chunks = n // _CHUNK + 1
        step, back = pow(_BASE, _CHUNK, 1 << 64), pow(pow(_BASE, -1, 1 << 64), _CHUNK, 1 << 64)
        self.back = _powers(back, chunks)
        high, carry = 1, np.uint64(0)
        for at in range(0, n, _CHUNK):
            v = table[data[at:at + _CHUNK]]
            v *= _POW[:len(v)]
            v *= np.uint64(high)
            out = self.sums[at + 1:at + 1 + len(v)]
            np.cumsum(v, out=out)
            out += carry
            carry = out[-1]
            high = high * step & _MASK

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = self.sums[end] - self.sums[start]
        h *= _INV[start & (_CHUNK - 1)]
        h *= self.back[start >> 16]
        return mix(h + (end - start).astype(np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents with about ``most`` bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def pieces(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of documents of a column."""
    data, offsets = buffers(column)
    for i, j in slices(offsets, most):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document number of every word; ``between``: the bytes that separate words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~between[data]
    first, last = offsets[:-1], offsets[1:]
    full = last > first
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[first[full]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[last[full] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (before the line feed) and document of every line; a
    document without text has one empty line."""
    feeds = np.flatnonzero(data == 10)
    start = np.concatenate([offsets[:-1], feeds + 1])
    doc = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
    end = np.concatenate([feeds, offsets[1:]])
    end_doc = np.concatenate([doc[len(offsets) - 1:], doc[:len(offsets) - 1]])
    a, b = np.lexsort((start, doc)), np.lexsort((end, end_doc))
    return start[a], end[b], doc[a]


def characters(data: np.ndarray) -> np.ndarray:
    """Running count of code points before each byte position."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def grams(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words of one document, and where they start."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:])
    g = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        g *= np.uint64(_BASE)
        g += h[j:len(h) - n + 1 + j]
    return mix(g[at] + np.uint64(n)), at


def repeated(key: np.ndarray) -> np.ndarray:
    """True where a value occurs more than once."""
    order = np.argsort(key)
    s = key[order]
    same = s[1:] == s[:-1]
    both = np.zeros(len(key), bool)
    both[1:] |= same
    both[:-1] |= same
    out = np.zeros(len(key), bool)
    out[order] = both
    return out


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """True for each of ``total`` words inside one of the n-word windows at ``at``."""
    d = np.zeros(total + 1, np.int32)
    d[at] += 1
    d[at + n] -= 1
    return np.cumsum(d[:-1]) > 0


def per_doc(doc: np.ndarray, weight: np.ndarray | None, docs: int) -> np.ndarray:
    """Sum of whole-number weights (or count) by document."""
    if weight is None:
        return np.bincount(doc, minlength=docs)
    return np.rint(np.bincount(doc, weights=weight, minlength=docs)).astype(np.int64)
