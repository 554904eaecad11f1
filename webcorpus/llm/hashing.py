"""Hashes over Arrow text, vectorised: rolling fingerprints of bytes, word borders, word names.

Fingerprints are polynomials modulo 2**64 over a random value per byte, then mixed.  They choose
candidates; where a link or a removal rests on equality, two independent ones are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that the vectorised code handles at once; a longer text is handled alone.  Each byte takes
#: up to some 80 bytes of arrays and of the tables of powers, which a worker keeps.
SLICE_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Roll:
    """Prefix sums of a polynomial over units; the fingerprint of any range is two look-ups."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, units: np.ndarray, base: int):
        n = len(units)
        self.inverse, powers = self._table(base, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(units * powers[:n], out=self.sums[1:])

    @classmethod
    def _table(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(n, SLICE_BYTES + 1)
            back = pow(base, -1, 1 << 64)
            have = tuple(cls._first_powers(b, size) for b in (back, base))
            if size <= 2 * SLICE_BYTES:
                cls._powers[base] = have
        return have[0][:n], have[1][:n]

    @staticmethod
    def _first_powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed fingerprints of the ranges [start, end); their lengths count too."""
        x = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(x + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def text_slices(column: pa.Array, size: int = SLICE_BYTES):
    """(first row, data, offsets) of consecutive rows with at most `size` bytes, or one row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        at = offsets[row : end + 1] - offsets[row]
        yield row, data[offsets[row] : offsets[end]], at
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each row, and the row borders counted in words."""
    n = len(data)
    inside = ~SEPARATORS[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[(last >= 0) & (offsets[1:] > offsets[:-1])]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def byte_roll(data: np.ndarray, which: int = 0) -> Roll:
    values = BYTE_VALUES if not which else mix(BYTE_VALUES + np.uint64(which))
    return Roll(values[data], BASES[which])


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit name for each word, the same wherever the word stands."""
    return byte_roll(data, which).of(starts, ends)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]
