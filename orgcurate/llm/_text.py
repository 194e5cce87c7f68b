"""Vectorised text primitives on Arrow string columns.

A batch is cut into slices of bounded bytes; a slice is one uint8 array with the
row boundaries, and words are found and hashed with whole-array numpy steps. All
hashes are 64 bits, seeded by fixed constants, and the same on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
MULT = 0xD6E8FEB86659FD93  # odd: has an inverse modulo 2**64
SLICE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit sums so that every output bit depends on all input bits."""
    h = h ^ (h >> U64(32))
    h = h * U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(32)
    return h


def random_table(seed: int, n: int = 256) -> np.ndarray:
    """n fixed pseudo-random 64-bit values, none of them 0."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed * 1_000_003)) * U64(0xA24BAED4963EE407)) | U64(1)


@lru_cache(maxsize=4)
def powers(n: int, base: int = MULT) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; n is rounded up by the caller."""
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def power_pair(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of MULT and of its inverse, at least n of each."""
    n = max(1 << 16, 1 << (n - 1).bit_length())
    return powers(n), powers(n, pow(MULT, -1, 1 << 64))


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 row offsets of a string column; null counts as empty."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = a.cast(pa.large_string())
    if a.null_count:
        a = a.fill_null("")
    _, offsets, data = a.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(data: np.ndarray, off: np.ndarray, most: int = SLICE_BYTES, keep: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about `most` bytes;
    a row longer than that is a slice of its own. Freed memory is given back at the end unless `keep`."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j
    if not keep:
        trim()


@lru_cache(maxsize=1)
def _allocator():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


def trim() -> None:
    """Gives memory that whole-array steps have freed back to the system: a worker is reused by
    many tasks, and would else keep what the largest of them took."""
    pa.default_memory_pool().release_unused()
    if _allocator():
        _allocator()(0)


class Words:
    """The words of a slice: maximal runs, within a row, of bytes that `lut` keeps.

    start, end: byte bounds of each word; row: its row; first: n_rows + 1 offsets
    of the rows' words; h: 64-bit hash of each word's mapped bytes.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, lut: np.ndarray, values: np.ndarray):
        """lut: 256 mapped bytes, 0 for bytes outside words; values: 256 hash values."""
        self.bytes = lut[data]
        inside = self.bytes != 0
        n = len(data)
        begin = np.empty(n, bool)
        begin[:1] = inside[:1]
        np.greater(inside[1:], inside[:-1], out=begin[1:])
        cuts = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < n)]
        begin[cuts] = inside[cuts]  # a word ends where its row ends
        self.start = np.flatnonzero(begin)
        stop = np.empty(n, bool)
        if n:
            np.greater(inside[:-1], inside[1:], out=stop[:-1])
            stop[-1] = inside[-1]
            stop[cuts - 1] = inside[cuts - 1]
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, off)
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(self.first))
        self.inside = inside
        if len(self.start):
            up, down = power_pair(n)
            with np.errstate(over="ignore"):
                v = np.where(values == 0, U64(0), values)[self.bytes] * up[:n]
                self.h = mix(np.add.reduceat(v, self.start) * down[self.start])
        else:
            self.h = np.zeros(0, U64)


def combine(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries, len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, k):
            out *= U64(MULT)
            out += h[j : j + n]
        return mix(out)


def table_of(keep, seed: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(lut, values) for Words: keep(b) says whether byte b belongs to words."""
    lut = np.array([(b + 32 if lower and 65 <= b <= 90 else b or 255) if keep(b) else 0 for b in range(256)], np.uint8)  # 255 is never in UTF-8
    values = random_table(seed)
    values[0] = 0
    return lut, values


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[0] .. start[0] + length[0] - 1, start[1] .. and so on."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = length > 0
    s, n = start[keep], length[keep]
    at = np.cumsum(n) - n
    out[at] = s
    out[at[1:]] -= s[:-1] + n[:-1] - 1
    return np.cumsum(out)
