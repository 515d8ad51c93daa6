"""Batch text helpers for Arrow tasks: bytes, words and 64-bit hashes in numpy.

All texts of an Arrow batch are handled as one byte array, in sub-batches of a
bounded number of bytes (one text may exceed the bound and then is a sub-batch
of its own).  Hashes are 64-bit sums of per-byte random values times powers of
an odd number, finished with an avalanche step; they serve as identities of
words, shingles and lines.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SUB_BATCH_BYTES = 1 << 20
#: Bytes of a sub-batch whose arrays of 64-bit values stay in the processor's cache.
SMALL_BATCH_BYTES = 1 << 18
#: Values of sets of pairs that are sorted at once.
PAIR_VALUES = 1 << 16

try:
    _libc = ctypes.CDLL("libc.so.6")
    _libc.malloc_trim  # noqa: B018 - a C library without it has no such memory to give back
except (OSError, AttributeError):
    _libc = None

_MULT = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20260)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """Powers 0..n of an odd base modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n + 1:
        size = max(n + 1, SUB_BATCH_BYTES + 4096)
        out = np.empty(size, np.uint64)
        out[0] = 1
        out[1:] = np.uint64(base)
        np.cumprod(out, out=out)
        if size > 4 * SUB_BATCH_BYTES:  # a rare very long text: don't keep its table
            return out
        _powers[base] = have = out
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche step (a bijection of the 64-bit values)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class PrefixHash:
    """Prefix sums over a byte array that give the hash of any slice."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power_table(_BASE, n)[:n], out=self.sums[1:])
        self.inverse = _power_table(_INV, n)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end] (equal slices give equal hashes)."""
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(np.uint64) * _MULT)

    def rolling(self, width: int) -> np.ndarray:
        """Hashes of all slices of one width, by start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.inverse[:n])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z as a-z."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


def is_space(data: np.ndarray) -> np.ndarray:
    """The bytes 0x20 and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def give_back() -> None:
    """Return freed memory to the system: a reused worker otherwise keeps what its largest batch took."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def text_batches(column: pa.Array, limit: int = SUB_BATCH_BYTES, max_rows: int = 60_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of sub-batches; null is empty.

    ``offsets`` has one entry more than rows and starts at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets_buffer, data_buffer = column.buffers()
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(offsets_buffer, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        last = min(n, max(last, row + 1), row + max_rows)
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last
    give_back()


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every white-space separated word, and word counts by row.

    Words don't cross the rows' borders.
    """
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~is_space(data)
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]  # non-empty rows
    begins[first] = inside[1:-1][first]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[1:-1][last]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    bounds = np.searchsorted(start, offsets)
    return start, end, np.diff(bounds)


def shingles(word_hash: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width``-word shingles in row order, and how many each row has.

    A row with fewer words, but at least one, has its whole sequence as its
    only shingle.
    """
    n, total = len(counts), len(word_hash)
    per_row = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    first_word = np.concatenate(([0], np.cumsum(counts)))[:-1]
    first_out = np.concatenate(([0], np.cumsum(per_row)))
    if total == 0:
        return np.empty(0, np.uint64), per_row
    row_of = np.repeat(np.arange(n), per_row)
    at = np.arange(first_out[-1]) - first_out[row_of] + first_word[row_of]
    out = np.zeros(len(at), np.uint64)
    size = np.minimum(counts, width)[row_of]
    uniform = bool((size == width).all()) if len(size) else True
    for k in range(width):
        factor = np.uint64(pow(_BASE, k + 1, 1 << 64))
        if uniform:
            out += word_hash[at + k] * factor
        else:
            ok = size > k
            out[ok] += word_hash[at[ok] + k] * factor
    return mix(out + size.astype(np.uint64) * _MULT), per_row


def row_sets(values: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, ascending within the row, and their counts."""
    values = values.copy()
    bounds = np.concatenate(([0], np.cumsum(per_row)))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values) + 1, np.int64)
    keep[1:-1] = values[1:] != values[:-1]
    keep[bounds] = 1  # a row's first value is new whatever stands before it
    kept = np.concatenate(([0], np.cumsum(keep[:-1])))
    return values[keep[:-1] == 1], np.diff(kept[bounds])


def shared_counts(values: np.ndarray, bounds: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many values the sets x[k] and y[k] have in common; set i holds values[bounds[i]:bounds[i + 1]].

    Many pairs are sorted at once by pair and the upper 56 bits of the values, which are hashes.
    """
    size = np.diff(bounds)
    out = np.zeros(len(x), np.int64)
    ends = np.cumsum(size[x] + size[y])
    low = 0
    while low < len(x):
        high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIR_VALUES, side="right"))
        high = min(len(x), low + 256, max(high, low + 1))
        sets = np.concatenate([x[low:high], y[low:high]])
        n = size[sets]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[sets], n)
        pair = np.tile(np.arange(high - low, dtype=np.uint64), 2) << np.uint64(56)
        both = (values[at] >> np.uint64(8)) | np.repeat(pair, n)
        both.sort()
        out[low:high] = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(56)).astype(np.int64), minlength=high - low)
        low = high
    return out
