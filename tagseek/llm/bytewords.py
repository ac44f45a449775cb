"""Words and their hashes for whole Arrow batches, worked out on UTF-8 bytes.

A batch is cut into slices of a few megabytes of whole texts; every step then
is one array operation over a slice, and memory stays bounded by the slice or
by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = 0x9E3779B97F4A7C15
_powers = {"p": np.ones(1, np.uint64), "inv": np.ones(1, np.uint64)}


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A 256-entry table that is true for the given byte ranges, ends included."""
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = np.full(max(n, SLICE_BYTES + 1), _P if kind == "p" else pow(_P, -1, 1 << 64), np.uint64)
        base[0] = 1
        _powers[kind] = np.multiply.accumulate(base)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("p", len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes give equal hashes."""
    inverse = _power("inv", len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


@dataclass
class Slice:
    """Whole texts of rows low:high; text i is data[offsets[i]:offsets[i + 1]]."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.high - self.low

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Null texts count as empty. A text longer than ``limit`` is a slice of its own."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield Slice(low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


@dataclass
class Runs:
    """Maximal runs of one class: places in the slice, and the text they are in."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray


def runs(piece: Slice, kind: np.ndarray) -> Runs:
    """``kind``: the class number of each byte of the slice; 0 belongs to no run."""
    n = len(kind)
    if not n:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none)
    cut = np.empty(n + 1, bool)
    cut[0] = cut[n] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:n])
    cut[piece.offsets] = True
    edges = np.flatnonzero(cut)
    start, end = edges[:-1], edges[1:]
    full = kind[start] != 0
    start, end = start[full], end[full]
    return Runs(start, end, np.searchsorted(piece.offsets, start, "right") - 1)


def row_bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each text's runs begin; one more entry for the end."""
    return np.searchsorted(row, np.arange(rows + 1))
