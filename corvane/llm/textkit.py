"""Vectorised word handling over Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. All functions work on slices of a
few MB, so memory is bounded by the slice (or by one document, where that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 21
_SEPARATORS = (0x20, *range(0x09, 0x0E))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random odd-increment splitmix64 values of a seed."""
    with np.errstate(over="ignore"):
        return mix(U(seed) * U(0xD1342543DE82EF95) + np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15))


IS_SEP = np.zeros(256, bool)
IS_SEP[list(_SEPARATORS)] = True
_BYTE = stream(1, 256)
_BYTE[IS_SEP] = 0
_PLACE = stream(2, 1 << 12) | U(1)
_COEF = stream(3, 64) | U(1)
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


@dataclass
class Slice:
    """Some rows of a string column: ``data`` holds their bytes, row i at ``offs[i]:offs[i+1]``."""

    first: int
    data: np.ndarray
    offs: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offs) - 1


@dataclass
class Words:
    """Words of a slice: byte ranges, 64-bit hashes, and ``ptr``: row i has words ptr[i]:ptr[i+1]."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    ptr: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def slices(column: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column (null counts as empty) into slices of about ``size`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    _, o, d = column.buffers()
    offs = np.frombuffer(o, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(d, np.uint8) if d is not None and d.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield Slice(i, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        i = j


def words(s: Slice, data: np.ndarray | None = None) -> Words:
    """The words of a slice; ``data``: the bytes to hash, if they differ (lower-cased, say)."""
    data = s.data if data is None else data
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(0, U), np.zeros(len(s.offs), np.int64))
    solid = ~IS_SEP[data]
    border = np.zeros(n + 1, bool)
    border[s.offs] = True
    before = np.ones(n, bool)
    before[1:] = ~solid[:-1]
    after = np.ones(n, bool)
    after[:-1] = ~solid[1:]
    opening = solid & (before | border[:n])
    start = np.flatnonzero(opening)
    end = np.flatnonzero(solid & (after | border[1:])) + 1
    ptr = np.searchsorted(start, s.offs)
    if not len(start):
        return Words(start, end, np.zeros(0, U), ptr)
    place = np.arange(n)
    place -= np.maximum.accumulate(np.where(opening, place, 0))
    with np.errstate(over="ignore"):
        terms = _BYTE[data] * _PLACE[place & (len(_PLACE) - 1)]
        if (place >= len(_PLACE)).any():
            terms = np.where(data == 0, terms, terms + mix((place // len(_PLACE)).astype(U)) * solid)
        h = mix(np.add.reduceat(terms, start) + (end - start).astype(U) * U(0x9E3779B97F4A7C15))
    return Words(start, end, h, ptr)


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, one for each word at which a run could start, and whether one does."""
    n = len(w.hash)
    ok = np.zeros(n, bool)
    out = np.zeros(n, U)
    if n >= k:
        with np.errstate(over="ignore"):
            acc = w.hash[: n - k + 1] * _COEF[0]
            for i in range(1, k):
                acc = acc + w.hash[i : n - k + 1 + i] * _COEF[i % 64] * U(2 * (i // 64) + 1)
        out[: n - k + 1] = mix(acc)
        last = np.repeat(w.ptr[1:], np.diff(w.ptr)) - k
        ok = np.arange(n) <= last
    return out, ok


def sequence_keys(w: Words, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's word sequence."""
    n = np.diff(w.ptr)
    out = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(rows, U)
        if len(w.hash):
            at = (np.arange(len(w.hash)) - np.repeat(w.ptr[:-1], n)).astype(U)
            with np.errstate(over="ignore"):
                terms = mix(w.hash ^ mix(at * U(0x9E3779B97F4A7C15) + U(seed)))
                full = n > 0
                total[full] = np.add.reduceat(terms, w.ptr[:-1][full])
                total = mix(total + n.astype(U) * U(seed))
        out.append(total)
    return out[0], out[1]


def per_row_sum(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of ``values[ptr[i]:ptr[i+1]]``."""
    c = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return c[ptr[1:]] - c[ptr[:-1]]


def distinct_per_row(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """How many distinct hashes each row has."""
    n = np.bincount(row, minlength=rows)
    if len(h):
        with np.errstate(over="ignore"):
            both = mix(h + row.astype(U) * U(0x9E3779B97F4A7C15))
        s = np.sort(both)
        again = np.unique(s[1:][s[1:] == s[:-1]])
        if len(again):
            at = np.flatnonzero(np.isin(both, again))
            _, once = np.unique(both[at], return_index=True)
            n = n - np.bincount(row[at], minlength=rows) + np.bincount(row[at][once], minlength=rows)
    return n


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """Consecutive runs of ``values`` of the given lengths as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values))


_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[:] = both
    return _powers[0], _powers[1]


def rolling(w: Words, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words that start at each word of the slice, as far as there are ``k`` (row ends don't count)."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, U)
    up, down = _power_tables(n + 1)
    with np.errstate(over="ignore"):
        c = np.concatenate([np.zeros(1, U), np.cumsum(w.hash * up[:n], dtype=U)])
        return mix((c[k:] - c[:-k]) * down[: n - k + 1] + U(k))


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each ``k`` consecutive values, by doubling."""
    out, reach = x, 1
    while 2 * reach <= k:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = k - reach
    return np.minimum(out[: len(x) - k + 1], out[rest : rest + len(x) - k + 1]) if rest else out


def joined(s: Slice, w: Words, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The (kept) words of each row joined by one space: bytes, and where each row's part begins and ends."""
    start, end, row = w.start, w.end, w.row
    if keep is not None:
        start, end, row = start[keep], end[keep], row[keep]
    depth = np.zeros(len(s.data) + 1, np.int8)
    depth[start] += 1
    depth[end] -= 1
    hold = np.cumsum(depth[:-1], dtype=np.int8).astype(bool)
    more = np.zeros(len(start), bool)
    more[:-1] = row[1:] == row[:-1]
    gap = end[more]
    hold[gap] = True
    out = s.data.copy()
    out[gap] = 0x20
    total = np.concatenate([[0], np.cumsum(hold)])
    return out[hold], total[s.offs]
