"""Word and shingle hashes of Arrow string columns, computed by numpy over raw UTF-8 bytes.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. A word's hash is
a polynomial over random 64-bit values of its bytes, taken as a difference of prefix sums,
so that a whole chunk of documents costs a few vector operations whatever its word count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20

_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
GRAM = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 62, 16, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, by doubling."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.ones(n, U64)
        k = 1
        while k < n:
            m = min(k, n - k)
            p[k:k + m] = p[:m] * U64(pow(b, k, 1 << 64))
            k += m
        out.append(p)
    return out[0], out[1]


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them) of runs of rows of about ``limit``
    bytes; a longer row comes alone and whole. Null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_bounds(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the index of its first word (rows + 1)."""
    n = len(buf)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs), np.int64)
    keep = ~_SEP[buf]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = keep[:-1]
    first = offs[:-1]
    before[first[first < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = keep[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    starts, ends = np.flatnonzero(keep & ~before), np.flatnonzero(keep & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each lower-cased word."""
    n = len(buf)
    size = CHUNK_BYTES
    while size < n:
        size *= 2
    up, down = _powers(size)
    sums = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[_LOWER[buf]] * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive hashes of ``h``."""
    n = len(h) - k + 1
    out = h[:n] * GRAM[0]
    for i in range(1, k):
        out += h[i:i + n] * GRAM[i]
    return mix(out)


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles of one document: k consecutive words, or all of them where fewer."""
    if not len(h):
        return np.empty(0, U64)
    if len(h) < k:
        return grams(h, len(h)) ^ U64(len(h))
    g = np.sort(grams(h, k))
    return g[np.concatenate(([True], g[1:] != g[:-1]))]
