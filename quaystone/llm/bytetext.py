"""UTF-8 text in Arrow batches as numpy byte arrays: words, hashes and windows without a Python loop per word.

All of it works on one Arrow batch inside a Spark task. A batch is cut into chunks of whole rows of
about ``CHUNK_BYTES``; a single longer text is a chunk of its own, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (multiply and shift, twice)."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, _U)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


#: One random 64-bit value a byte; the same for upper-case A-Z as for lower case in LOWER.
BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
LOWER = BYTE_VALUE.copy()
LOWER[65:91] = BYTE_VALUE[97:123]

_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            table = np.cumprod(np.concatenate([np.ones(1, _U), np.full(size, base, _U)]), dtype=_U)
        if size <= 4 * CHUNK_BYTES:  # one very long text doesn't keep its table
            _powers[base] = table
    return table


def spaces(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags: True for bytes that belong to words, False in the given closed ranges."""
    table = np.ones(256, bool)
    for low, high in ranges:
        table[low:high + 1] = False
    return table


#: Words of ``[^\x20\x09-\x0D]+``.
BLANK_WORDS = spaces((0x20, 0x20), (0x09, 0x0D))


def to_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
    else:
        column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of whole rows of about ``limit`` bytes."""
    data, offsets = to_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


class Rolling:
    """Hash of any byte range of ``data`` in constant time: the hash depends on the range's bytes only."""

    def __init__(self, data: np.ndarray, values: np.ndarray = BYTE_VALUE):
        with np.errstate(over="ignore"):
            weighted = values[data] * _power_table(_BASE, len(data))[:len(data)]
            self.sums = np.concatenate([np.zeros(1, _U), np.cumsum(weighted, dtype=_U)])
        self.inverse = _power_table(_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(_U))

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all ranges of ``length`` bytes, by start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, _U)
        with np.errstate(over="ignore"):
            return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n] + _U(length))


def row_of(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, positions, "right") - 1


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True, cut at row bounds."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before[cuts] = False
    after[cuts - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = BLANK_WORDS) -> tuple[np.ndarray, ...]:
    """(row, start byte, end byte) of each word."""
    starts, ends = runs(table[data], offsets)
    return row_of(offsets, starts), starts, ends


def shingles(rows: np.ndarray, hashes: np.ndarray, n_rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct ``size``-word shingles, sorted by row and hash; a row with fewer words
    has all its words as one; a row without words has none."""
    with np.errstate(over="ignore"):
        counts = np.bincount(rows, minlength=n_rows)
        firsts = np.concatenate([[0], np.cumsum(counts)])[:-1]
        total = len(hashes)
        out_rows, out = [], []
        if total >= size:
            last = total - size + 1
            own = rows[:last] == rows[size - 1:]
            acc = np.zeros(last, _U)
            for j in range(size):
                acc = acc * _U(_BASE) + hashes[j:j + last]
            out_rows.append(rows[:last][own])
            out.append(mix(acc[own] + _U(size)))
        for short in range(1, size):
            few = np.flatnonzero(counts == short)
            if len(few):
                acc = np.zeros(len(few), _U)
                for j in range(short):
                    acc = acc * _U(_BASE) + hashes[firsts[few] + j]
                out_rows.append(few)
                out.append(mix(acc + _U(short)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    row, value = np.concatenate(out_rows), np.concatenate(out)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[keep], value[keep]
