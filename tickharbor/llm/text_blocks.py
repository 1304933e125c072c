"""Texts as byte arrays: word boundaries, hashes of spans and windows of words, in numpy.

A task gets Arrow batches of rows. Their texts are handled in blocks of bounded size, so that
memory does not follow the number of rows in a batch; one text is never split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = (4 << 20) - 1024

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_class(pattern_bytes) -> np.ndarray:
    """A 256-entry table that is true for the given byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(pattern_bytes)] = True
    return table


#: Words of the contracts: any bytes but space and tab to carriage return.
NOT_BLANK = ~byte_class([0x20, *range(0x09, 0x0E)])
#: Letters, digits-free: any bytes but these ASCII ranges (A-Z are lower-cased first).
LETTERS = ~byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


@dataclass
class Block:
    """Consecutive texts as one byte array; ``offsets`` has one entry more than there are texts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Block:
        """With A-Z in lower case; other bytes, also of multi-byte characters, stay."""
        upper = (self.data >= 65) & (self.data <= 90)
        return Block(self.first, self.data + (upper.astype(np.uint8) << np.uint8(5)), self.offsets)


def text_array(column: pa.Array) -> pa.Array:
    """The column as large strings, NULL as the empty text."""
    if column.null_count:
        column = column.fill_null("")
    return column.cast(pa.large_binary())


def blocks(column: pa.Array, budget: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column in blocks of at most ``budget`` bytes, or one text."""
    column = text_array(column)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + budget, "right")) - 1
        last = min(max(last, first + 1), n)
        low, high = int(offsets[first]), int(offsets[last])
        yield Block(first, data[low:high], offsets[first : last + 1] - low)
        first = last


def spans(block: Block, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in ``table``: starts, ends, and the first run of each text (one more at the end)."""
    inside = table[block.data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = block.offsets[1:-1]
    cuts = cuts[cuts < len(inside)]
    opens[cuts] = inside[cuts]
    before = cuts[cuts > 0] - 1
    closes[before] = inside[before]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, block.offsets)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        out = np.full(n, np.uint64(base))
        out[0] = 1
        return np.cumprod(out)

    return series(_BASE), series(_INVERSE)


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(n).bit_length()))


@lru_cache(maxsize=8)
def _byte_codes(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """64-bit hashes of any spans of a byte array, each in constant time after one pass."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        up, self._down = _powers_of(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_byte_codes(seed)[data] * up[: len(data)], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive entries; shorter than ``hashes`` by ``n - 1``."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(size, np.uint64(n))
    for i in range(n):
        out = mix(out * _ODD + hashes[i : i + size])
    return out


def owners(firsts: np.ndarray) -> np.ndarray:
    """The text of each run, from the first run of each text."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def whole_windows(firsts: np.ndarray, n: int) -> np.ndarray:
    """Which of the windows of ``n`` runs lie in one text."""
    owner = owners(firsts)
    size = max(len(owner) - n + 1, 0)
    return owner[:size] == owner[n - 1 : n - 1 + size]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    return member(keys, twice)


def member(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted array."""
    if not len(ordered):
        return np.zeros(len(keys), dtype=bool)
    at = np.searchsorted(ordered, keys)
    at[at == len(ordered)] = 0
    return ordered[at] == keys


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a span."""
    depth = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(depth[:size]) > 0


def per_text(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the bounds in ``firsts``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[firsts[1:]] - total[firsts[:-1]]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
