"""Words of a whole Arrow batch of texts as arrays: bounds, owners and 64-bit hashes, without a Python loop per word.

A word is a run of bytes other than blank and the control characters 9 to 13. A word's hash is the sum of random
64-bit values of its bytes, each times a power of an odd number by its place, mixed at the end; it is taken from one
running sum, so the cost per byte is the same for short and for very long words. Everything is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Everything but ASCII letters and digits and the bytes of other scripts.
NOT_LETTERS = np.array([value < 128 and not chr(value).isalnum() for value in range(256)])


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


_BYTE = [_random(11, 256), _random(12, 256)]
_ODD = [_random(13, 8) | np.uint64(1), _random(14, 8) | np.uint64(1)]
for _table in _BYTE:
    _table[_GAP] = 0
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(odd: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of an odd number and of its inverse."""
    have = _powers.get(odd)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        pair = []
        for base in (odd, pow(odd, -1, 1 << 64)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            pair.append(np.multiply.accumulate(run))
        have = (pair[0], pair[1])
        if size <= 8 * SLICE_BYTES:
            _powers[odd] = have
    return have[0][:n], have[1][:n]


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, lower-cased if asked for
    bounds: np.ndarray  # byte offsets of the texts, one more than texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray  # number of the first word of each text, one more than texts

    def totals(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        running = np.concatenate([[0], np.cumsum(per_byte, dtype=np.int64)])
        return running[self.bounds[1:]] - running[self.bounds[:-1]]

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, lane: int = 0) -> np.ndarray:
        power, inverse = powers(int(_ODD[lane][0]), len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        running = total[1:]
        np.take(_BYTE[lane], self.data, out=running)
        running *= power[:-1]
        np.cumsum(running, out=running)
        return mix((total[self.end] - total[self.start]) * inverse[self.start])

    def text(self, i: int, j: int) -> list[bytes]:
        """Words i to j - 1 as bytes."""
        return [self.data[a:b].tobytes() for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist())]


def run_hashes(words: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` consecutive word hashes."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    power, inverse = powers(int(_ODD[lane][1]), len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:-1], out=total[1:])
    return mix((total[length:] - total[: len(words) - length + 1]) * inverse[: len(words) - length + 1])


def span_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of each run of words from ``start`` up to ``end``, its length included."""
    power, inverse = powers(int(_ODD[lane][1]), len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[:-1], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * _ODD[lane][2])


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if len(column) == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    if buffers[2] is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(buffers[2], np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def split(column: pa.Array, lower: bool = False, gap: np.ndarray = _GAP) -> Words:
    """Words of all texts; ``gap`` marks the bytes between words."""
    data, bounds = texts(column)
    if lower:
        data = _LOWER[data]
    inside = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, bounds, start, end, np.searchsorted(start, bounds))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes of text each, or a single row."""
    _, bounds = texts(column)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high
        low = high


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    least, reach = values, 1
    while 2 * reach <= width:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
