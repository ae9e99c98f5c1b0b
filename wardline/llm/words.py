"""Words of many texts at once, as arrays: where they start and end, their hashes, their texts.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D). Its hash is 64 bits
wide: a polynomial in the words' bytes, read off prefix sums, so that no step works on one word at
a time. Within one table of a million words, the chance that any two words share a hash is
3e-8; lengths are compared as well where words are looked up.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
# Prefix sums run over about this many bytes at a time.
BLOCK_BYTES = 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[ord("a") : ord("z") + 1] = ASCII_LETTER[ord("A") : ord("Z") + 1] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; one to one."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values ^= values >> U64(27)
    values *= U64(0x94D049BB133111EB)
    values ^= values >> U64(31)
    return values


@lru_cache
def byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
    return values[LOWER] if lower else values


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse for i < size."""

    def powers(base: int) -> np.ndarray:
        out = np.full(size, base, U64)
        out[0] = 1
        return np.cumprod(out, dtype=U64)

    return powers(BASE), powers(pow(BASE, -1, 1 << 64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A hash of each span ``data[start:end]``; starts and ends ascend."""
    out, table, at = np.empty(len(starts), U64), byte_values(lower), 0
    while at < len(starts):
        low = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, "right")))
        high = int(ends[stop - 1])
        forward, back = _powers(max(BLOCK_BYTES, 1 << (high - low).bit_length()))
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(table[data[low:high]] * forward[: high - low], out=sums[1:])
        first = starts[at:stop] - low
        out[at:stop] = (sums[ends[at:stop] - low] - sums[first]) * back[first]
        at = stop
    return mix(out)


@dataclass
class Words:
    data: np.ndarray  #: the bytes of all texts, a line end after each
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  #: for each text its first word, and the number of words at the end

    def text(self, word: int) -> bytes:
        return self.data[self.starts[word] : self.ends[word]].tobytes()

    def documents(self) -> np.ndarray:
        """The ordinal of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters of scripts that are written without blanks start, and where the next ones do:
    Thai, Lao, Tibetan, Burmese, Khmer, Chinese, Japanese."""
    at = np.flatnonzero(data >= 0xE0)
    first, second = data[at], data[np.minimum(at + 1, len(data) - 1)]
    size = np.where(first >= 0xF0, 4, 3)
    own = (first == 0xE0) & (second >= 0xB8)
    own |= (first == 0xE1) & ((second <= 0x82) | ((second >= 0x9E) & (second <= 0x9F)))
    own |= (first == 0xE2) & (second >= 0xBA) | (first >= 0xE3) & (first <= 0xE9)
    own |= (first == 0xEF) & ((second >= 0xA4) & (second <= 0xAB) | (second >= 0xBC))
    own |= (first == 0xF0) & (second >= 0xA0)
    # Bytes that are no character are left alone.
    for k in (1, 2, 3):
        own &= (k >= size) | (data[np.minimum(at + k, len(data) - 1)] & 0xC0 == 0x80)
    return at[own], (at + size)[own]


def split_words(texts: list[bytes], lower: bool = True, marks: bool = False, unspaced: bool = False) -> Words:
    """Cut texts into words. ``lower``: hashes take A-Z for a-z. ``marks``: a full stop or comma
    that ends a run, right after a letter, is a word of its own. ``unspaced``: so is each character
    of a script that is written without blanks."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    inside = ~WHITE[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    if marks:
        after = np.flatnonzero(closes & ((data == 0x2E) | (data == 0x2C)))
        before = data[np.maximum(after - 1, 0)]
        # Two-byte Latin letters: all of C3 80 - C3 BF but the signs of multiplication and division.
        latin = (data[np.maximum(after - 2, 0)] == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
        after = after[(after > 0) & (ASCII_LETTER[before] | (latin & (after > 1)))]
        begins[after] = True
        closes[after - 1] = True
    if unspaced:
        at, after = _unspaced(data)
        begins[at] = closes[after - 1] = True
        begins[after] |= inside[after]
        at = at[at > 0]
        closes[at - 1] |= inside[at - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    limits = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(data, starts, ends, span_hashes(data, starts, ends, lower), np.searchsorted(starts, limits))


class Lookup:
    """A growing set of 64-bit keys, each with a number from 0 in the order of arrival."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(0, U64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is not there."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.numbers[at], -1)

    def add(self, keys: np.ndarray) -> None:
        """Add new keys, no two the same."""
        numbers = np.arange(len(self.keys), len(self.keys) + len(keys))
        both = np.concatenate([self.keys, keys])
        order = np.argsort(both, kind="stable")
        self.keys, self.numbers = both[order], np.concatenate([self.numbers, numbers])[order]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, joined."""
    total = int(lengths.sum())
    ahead = np.cumsum(lengths) - lengths
    return np.repeat(starts - ahead, lengths) + np.arange(total)
