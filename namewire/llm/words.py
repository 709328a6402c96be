"""Word and shingle hashes of text columns, computed on the Arrow buffers.

Words are runs of bytes other than space and \\x09-\\x0D. Hashes are 64-bit
polynomials over random byte values, A-Z counting as a-z, and are the same in every
process. No Python string is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_U = np.uint64


def _draw(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, n, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash: every bit depends on every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    n, low = len(offsets) - 1, 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


class Hasher:
    """Hashes the words of a piece of a text column."""

    def __init__(self, fold: bool = True, seed: int = 11, letters: bool = False):
        self.values = _draw(seed, 256)
        if fold:
            self.values[65:91] = self.values[97:123]
        self.base = int(_draw(seed + 1, 1)[0]) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        if letters:  # words are runs of letters and digits
            self.space[:128] = [not chr(k).isalnum() for k in range(128)]
        self.powers = self.backward = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, CHUNK_BYTES + 1024)
            for name, factor in (("powers", self.base), ("backward", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes, byte starts and ends, and n + 1 word offsets of the rows."""
        n = len(data)
        self._grow(n + 1)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~self.space[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:n], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.backward[starts])
        return hashes, starts, ends, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, size: int, seed: int = 17) -> np.ndarray:
    """Hashes of the runs of ``size`` words, in order; fewer words are one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    factors = _draw(seed, size) | _U(1)
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out += hashes[k: n - width + 1 + k] * factors[k]
    return mix(out)


def texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a column with their bytes and offsets."""
    data, offsets = text_buffer(column)
    for low, high in slices(offsets):
        yield low, high, data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low]
