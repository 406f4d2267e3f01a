"""Numpy helpers shared by the text operators: Arrow buffers, words, rolling hashes, minima."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_STEP, _SIZE, _LEFT, _SEED = (U64(x) for x in np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 4, dtype=np.uint64) * 2 + 1)
#: The low bytes of a little-endian word.
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def lean(run: Callable) -> Callable:
    """``run`` for mapInArrow, giving freed memory back to the system after every batch.

    Python workers live on between tasks and stages, and allocators keep what was freed; without this, the peaks of
    one stage add to those of the next.
    """

    def release() -> None:
        pa.default_memory_pool().release_unused()
        if hasattr(ctypes.pythonapi, "malloc_trim"):
            ctypes.pythonapi.malloc_trim(0)

    def fed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            release()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(fed(batches))
        release()

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, a longer row alone, so that work arrays stay small."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (runs without white space), and the word offsets of the rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~SPACES[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one value; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes wherever they stand.

    Every eight bytes are mixed with their place in the span and the results are added up: unlike a polynomial
    modulo 2**64, which maps a Thue-Morse word and its complement to one value, no pattern of bytes cancels.
    """
    size = np.asarray(ends) - np.asarray(starts)
    n = (size + 7) // 8
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    chunk = eights(data)[np.repeat(starts, n) + 8 * place]
    chunk &= _LOW[np.minimum(np.repeat(size, n) - 8 * place, 8)]
    chunk = mix(mix(chunk + _SEED) + place.astype(U64) * _STEP)
    out = np.zeros(len(size), U64)
    some = n > 0
    if some.any():
        out[some] = np.add.reduceat(chunk, first[some])
    return mix(out ^ size.astype(U64) * _SIZE)


def _stir(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values, in place: enough between values that are multiplied again."""
    x *= _STEP
    x ^= x >> U64(32)
    return x


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbours, by pair."""
    x = a * _LEFT
    x += b
    return _stir(x)


def gram_hashes(values: np.ndarray, k: int, step: int = 1) -> np.ndarray:
    """Hash of each ``k`` values that are ``step`` apart, by halves; one entry per start, len(values) - (k - 1) * step in all."""
    count = len(values) - (k - 1) * step
    if count <= 0:
        return np.zeros(0, U64)
    level, size, out, done = _stir(values + _SEED), 1, None, 0
    while True:
        if k & size:
            part = level[done * step : done * step + count]
            out = part if out is None else _join(out, part)
            done += size
        if done == k:
            return mix(out) if step == 1 else out
        level = _join(level[: -size * step], level[size * step :])
        size *= 2


def byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` bytes (eight or more); one entry per start."""
    if len(data) < k:
        return np.zeros(0, U64)
    eight = eights(data)[: len(data) - 7]
    out = gram_hashes(eight, k // 8, 8)[: len(data) - k + 1]
    return _join(out, _stir(eight[k - 8 :] + _SEED)) if k % 8 else out


class Prefixes:
    """Comparison of any two stretches of a text by polynomial sums modulo the prime 2**31 - 1, two bases."""

    P = U64((1 << 31) - 1)
    BASES = (1_130_406_883, 1_987_206_151)

    def __init__(self, data: np.ndarray):
        self.lanes = []
        for base in self.BASES:
            up, down = (self._powers(b, len(data) + 1) for b in (base, pow(base, -1, int(self.P))))
            terms = self._fold((data.astype(U64) + U64(1)) * up[:-1])
            self.lanes.append((np.concatenate([np.zeros(1, U64), np.cumsum(terms)]), down))

    @classmethod
    def _fold(cls, x: np.ndarray) -> np.ndarray:
        x = (x & cls.P) + (x >> U64(31))
        x = (x & cls.P) + (x >> U64(31))
        return np.where(x >= cls.P, x - cls.P, x)

    @classmethod
    def _powers(cls, base: int, n: int) -> np.ndarray:
        out = np.ones(1, U64)
        while len(out) < n:
            out = np.concatenate([out, cls._fold(out * U64(pow(base, len(out), int(cls.P))))])
        return out[:n]

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` bytes from a equal those from b."""
        out = np.ones(len(a), bool)
        for sums, down in self.lanes:
            x, y = (self._fold(self._fold(sums[at + size] - sums[at]) * down[at]) for at in (a, b))
            out &= x == y
        return out


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive entries."""
    if len(a) < w:
        return a[:0]
    size = 1
    while size * 2 <= w:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    if size < w:
        a = np.minimum(a[: len(a) - (w - size)], a[w - size :])
    return a


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for counts[i] entries, all i in turn."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - first, counts)
