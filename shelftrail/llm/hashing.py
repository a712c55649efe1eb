"""Vectorised words and word-window hashes over the byte buffer of an Arrow text column.

A word is a run of bytes other than space and 0x09-0x0D. All hashes are polynomials
modulo 2**64 over random byte (or word) codes, taken from one prefix sum, so no Python
loop runs over words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_CODES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Bytes (or words) per prefix sum: bounds the memory of the 64-bit temporaries.
_PIECE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    def run(b: int) -> np.ndarray:
        out = np.full(size, b, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return run(base), run(pow(base, -1, 1 << 64))


def text_buffer(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no rows, or too large for one array
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a text column: byte spans, 64-bit hashes, and each row's first word.

    With `longest`, words of more bytes are cut into pieces of that many.
    """

    def __init__(self, column, lower: bool = False, longest: int | None = None):
        self.data, self.bounds = text_buffer(column)
        ink = ~WHITE[self.data]
        edge = self.bounds[(self.bounds > 0) & (self.bounds < len(ink))]
        before, after = np.zeros_like(ink), np.zeros_like(ink)
        before[1:], after[:-1] = ink[:-1], ink[1:]
        before[edge], after[edge - 1] = False, False
        self.starts = np.flatnonzero(ink & ~before)
        self.ends = np.flatnonzero(ink & ~after) + 1
        if longest and len(self.starts):
            pieces = -(-(self.ends - self.starts) // longest)
            order = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            self.starts = np.repeat(self.starts, pieces) + longest * order
            self.ends = np.minimum(self.starts + longest, np.repeat(self.ends, pieces))
        self.offsets = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.offsets)
        self.hashes = self._hash(LOWER[self.data] if lower else self.data)

    def __len__(self) -> int:
        return len(self.starts)

    def _hash(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(out):
            base = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, base + _PIECE, "right")))
            s, e = self.starts[i:j] - base, self.ends[i:j] - base
            size = int(e[-1])
            power, inverse = _powers(_BASE, max(_PIECE, 1 << (size - 1).bit_length()))
            total = np.zeros(size + 1, np.uint64)
            np.cumsum(_CODES[data[base : base + size]] * power[:size], out=total[1:])
            out[i:j] = mix((total[e] - total[s]) * inverse[s])
            i = j
        return out

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def room(self) -> np.ndarray:
        """Words from each word to the end of its row, itself included."""
        return np.repeat(self.offsets[1:], self.counts) - np.arange(len(self))

    def windows(self, size: int) -> np.ndarray:
        """Hash of the `size` words from each position; only sensible where room() >= size."""
        n = len(self)
        out = np.zeros(n, np.uint64)
        for i in range(0, max(n - size + 1, 0), _PIECE):
            part = self.hashes[i : i + _PIECE + size - 1]
            power, inverse = _powers(_WORD_BASE, 2 * _PIECE)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * power[: len(part)], out=total[1:])
            count = len(part) - size + 1
            out[i : i + count] = mix((total[size:] - total[:-size]) * inverse[:count])
        return out


def group_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Positions where a new value begins."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
