"""Vectorised text kernels over Arrow batches: words, lines, spans and their 64-bit hashes.

All kernels work on the UTF-8 bytes of a whole column. Words and blank characters are ASCII
notions here (``\\x20`` and ``\\x09``-``\\x0D``), so multi-byte characters are never cut. Hashes are
polynomial (Rabin-Karp) modulo 2**64 followed by a bijective mix; two different texts share one
with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 21
_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to at least ``n``."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _long_span(values: np.ndarray) -> int:
    power, _ = _power(SEGMENT)
    total, factor = 0, 1
    for i in range(0, len(values), SEGMENT):
        part = values[i : i + SEGMENT].astype(np.uint64) + np.uint64(1)
        total += int((part * power[: len(part)]).sum(dtype=np.uint64)) * factor
        factor = factor * pow(_P, SEGMENT, 1 << 64) & _MASK
    return total & _MASK


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for every span; starts and ends both ascend, spans may overlap.

    Prefix sums over pieces of at most ``SEGMENT`` values give each span in constant time, so
    memory is bounded whatever the length of the column; a longer span is folded piece by piece.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = int(np.searchsorted(ends, low + SEGMENT, side="right"))
        if j <= i:
            out[i] = _long_span(values[low : int(ends[i])])
            i += 1
            continue
        high = int(ends[j - 1])
        power, inverse = _power(SEGMENT)
        prefix = np.zeros(high - low + 1, np.uint64)
        part = values[low:high].astype(np.uint64)
        part += np.uint64(1)
        part *= power[: high - low]
        np.cumsum(part, out=prefix[1:])
        at = starts[i:j] - low
        out[i:j] = (prefix[ends[i:j] - low] - prefix[at]) * inverse[at]
        i = j
    length = (ends - starts).astype(np.uint64)
    return mix(out ^ (length * np.uint64(0xD6E8FEB86659FD93)))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column laid end to end, and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, or of one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


class Words(NamedTuple):
    """Words of a column: byte spans, hashes, and the index of each row's first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every row; ``lower`` folds A-Z before hashing."""
    all_starts, all_ends, all_hashes = [], [], []
    for i, j in slices(offsets):
        low, high = int(offsets[i]), int(offsets[j])
        part = data[low:high]
        solid = ~_BLANK[part]
        before = np.zeros(len(part), bool)
        before[1:] = solid[:-1]
        edge = offsets[i:j][offsets[i:j] < high] - low
        before[edge] = False
        starts = np.flatnonzero(solid & ~before)
        after = np.zeros(len(part), bool)
        after[:-1] = solid[1:]
        after[edge[edge > 0] - 1] = False
        ends = np.flatnonzero(solid & ~after) + 1
        all_hashes.append(span_hashes(_LOWER[part] if lower else part, starts, ends))
        all_starts.append(starts + low)
        all_ends.append(ends + low)
    if not all_starts:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    starts = np.concatenate(all_starts)
    return Words(starts, np.concatenate(all_ends), np.concatenate(all_hashes), np.searchsorted(starts, offsets))


def windows(rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of every run of ``size`` words inside one row, and the row of each."""
    counts = np.maximum(np.diff(rows) - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + rows[:-1][row]
    return first, row


def shingles(table: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and their rows.

    A row with at least one but fewer than ``size`` words has its whole sequence as its one run.
    """
    first, row = windows(table.rows, size)
    last = first + size
    counts = np.diff(table.rows)
    few = np.flatnonzero((counts > 0) & (counts < size))
    if len(few):
        order = np.argsort(np.concatenate([row, few]), kind="stable")
        first = np.concatenate([first, table.rows[few]])[order]
        last = np.concatenate([last, table.rows[few + 1]])[order]
        row = np.concatenate([row, few])[order]
    return span_hashes(table.hashes, first, last), row


def distinct_by_row(hashes: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row in ascending order, and the offsets of the rows. ``row`` ascends."""
    bounds = np.searchsorted(row, np.arange(n_rows + 1))
    parts = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else hashes[:0]), np.concatenate([[0], np.cumsum(sizes)])


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Column of strings from bytes and row offsets."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    ).cast(pa.string() if len(data) < 1 << 31 else pa.large_string())


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def is_blank(data: np.ndarray) -> np.ndarray:
    return _BLANK[data]
