"""Words of many texts at once: where they are, and 64-bit hashes of words and of word sequences.

Words are runs of certain UTF-8 bytes, so one pass over the bytes of a batch finds them all. A
hash is a polynomial over the bytes (or over the word hashes) modulo 2**64, with a random number
for each byte. Two lanes with other numbers give 128 bits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from ledgertag.llm.storage import text_bytes

WORD = np.uint64


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of the bytes that belong to words, from inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Everything but white space: [^\x20\x09-\x0D]+
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
# After lower-casing A-Z: digits, letters, and all that is not ASCII.
LETTERS_DIGITS = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
# Letters only, and all that is not ASCII.
LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the information of every bit over all bits."""
    x = (x ^ (x >> WORD(31))) * WORD(0x9E3779B97F4A7C15)
    x = (x ^ (x >> WORD(29))) * WORD(0xD6E8FEB86659FD93)
    return x ^ (x >> WORD(32))


@lru_cache(maxsize=4)
def lane_numbers(lane: int) -> tuple[np.ndarray, int, int]:
    """The number of each byte, the base of the powers and its inverse."""
    with np.errstate(over="ignore"):
        table = mixed(np.arange(1, 257, dtype=np.uint64) + WORD(1000 * lane + 17))
    base = (0x5851F42D4C957F2D, 0x14057B7EF767814F)[lane]
    return table, base, pow(base, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    kept = _POWERS.get(base)
    if kept is None or len(kept) < count:
        size = 1 << max(16, int(count - 1).bit_length())
        kept = np.full(size, base, np.uint64)
        kept[0] = 1
        np.multiply.accumulate(kept, out=kept)
        if size <= 1 << 23:
            _POWERS[base] = kept
    return kept[:count]


class Words:
    """The words of a column of texts."""

    def __init__(self, texts: pa.Array, members: np.ndarray, lower: bool) -> None:
        data, bounds = text_bytes(texts)
        self.data = LOWER[data] if lower else data
        inside = members[self.data]
        # A word begins where the byte before is outside or belongs to another text.
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = bounds[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = bounds
        # Words of text i are first[i] to first[i + 1].
        self.first = np.searchsorted(self.start, bounds)
        self.count = np.diff(self.first)
        self._sums: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.start)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def _sum(self, lane: int) -> np.ndarray:
        if lane not in self._sums:
            table, base, _ = lane_numbers(lane)
            sums = np.zeros(len(self.data) + 1, np.uint64)
            with np.errstate(over="ignore"):
                np.cumsum(table[self.data] * powers(base, len(self.data)), out=sums[1:])
            self._sums[lane] = sums
        return self._sums[lane]

    def hashes(self, lane: int = 0, first_bytes: int | None = None) -> np.ndarray:
        """A hash of each word, or of its first bytes."""
        sums = self._sum(lane)
        end = self.end if first_bytes is None else np.minimum(self.end, self.start + first_bytes)
        _, _, inverse = lane_numbers(lane)
        with np.errstate(over="ignore"):
            found = (sums[end] - sums[self.start]) * powers(inverse, len(sums))[self.start]
            return mixed(found + (end - self.start).astype(np.uint64))

    def sequences(self, hashes: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
        """A hash for each run of so many words, by the first word; runs over the end are there, too."""
        _, base, _ = lane_numbers(lane)
        size = max(0, len(hashes) - length + 1)
        out = np.zeros(len(hashes), np.uint64)
        total = np.full(size, length, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(length):
                total = total * WORD(base) + hashes[k : k + size]
            out[:size] = mixed(total)
        return out

    def whole(self, length: int) -> np.ndarray:
        """Which words begin a run of so many words inside their text."""
        last = np.repeat(self.first[1:], self.count)
        return np.arange(len(self)) + length <= last


def covered(starts: np.ndarray, lengths: np.ndarray | int, count: int) -> np.ndarray:
    """Which of the positions 0 to count lie in one of the runs."""
    steps = np.zeros(count + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0
