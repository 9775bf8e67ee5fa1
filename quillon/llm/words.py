"""Vectorised words and shingles over Arrow text columns.

Words are runs of [^\\x20\\x09-\\x0D], compared after lower-casing A-Z when asked.
Each word becomes a 64-bit hash by one polynomial prefix sum over the bytes of many texts,
so no Python object is made per word. Texts are handled whole, in chunks of whole texts.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
CHUNK = 1 << 19


def mix64(x):
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix64(np.arange(1, 257, dtype=U) * U(0xD1B54A32D192ED03))


class _Powers:
    def __init__(self):
        self.p = self.i = np.ones(1, U)

    def upto(self, n):
        if len(self.p) < n:
            size = max(n, 2 * len(self.p))
            for name, base in (("p", _P), ("i", _PINV)):
                a = np.full(size, base, U)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=U))
        return self.p, self.i


_powers = _Powers()


def powers(n):
    """The first n powers of an odd number and of its inverse, for hashes of ranges by prefix sums."""
    return _powers.upto(n)


@dataclass
class Chunk:
    """Rows lo..hi of a batch: bytes, byte offsets by row, word bounds and hashes, word offsets by row."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    ptr: np.ndarray


def text_buffers(column):
    """Bytes and offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data, offsets


def pieces(offsets, limit=CHUNK, rows=None):
    """Row ranges of about limit bytes, and of `rows` rows at most; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1), n if rows is None else lo + rows)
        yield lo, hi
        lo = hi


def chunks(column, lower=True, space=SPACE):
    """Chunks of a text column with their words; space says by byte what parts words."""
    data, offsets = text_buffers(column)
    for lo, hi in pieces(offsets):
        part, offs = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        yield _words(lo, hi, part, offs, lower, space)


def _words(lo, hi, data, offs, lower, space):
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Chunk(lo, hi, data, offs, z, z, z.astype(U), np.zeros(hi - lo + 1, np.int64))
    solid = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers.upto(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(_BYTE[LOWER[data] if lower else data] * power[:n], out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))
    return Chunk(lo, hi, data, offs, starts, ends, hashes, np.searchsorted(starts, offs))


def windows(h, k):
    """Hashes of k successive word hashes, as if the chunk were one text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = h[:n].copy()
    for j in range(1, k):
        out = mix64(out * U(0x9E3779B97F4A7C15) + h[j : j + n])
    return out


def shingle_rows(c, k):
    """Shingle hashes with repeats, one array a row; with fewer words the whole sequence is one."""
    w = windows(c.hashes, k)
    for r in range(c.hi - c.lo):
        a, b = c.ptr[r], c.ptr[r + 1]
        if b - a >= k:
            yield w[a : b - k + 1]
        elif b > a:
            yield windows(c.hashes[a:b], b - a) ^ U(0x5851F42D4C957F2D)
        else:
            yield w[:0]


def shingle_sets(c, k):
    """Sorted distinct shingle hashes, one array a row."""
    for x in shingle_rows(c, k):
        if len(x) > 1:
            x = np.sort(x)
            x = x[np.concatenate(([True], x[1:] != x[:-1]))]
        yield x
