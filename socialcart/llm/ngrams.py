"""Numpy parts of LM scoring: packed arrays, bigram keys, and the
log-frequency Bloom filter.

The filter stores a key once for each level up to the level of its count
(level q holds counts in [BASE**(q-1), BASE**q)); a reader probes level after
level until one is missing.  A level's entry is PROBES bits of one 64-bit word.
Keys are a segment number and 32 bits; a segment owns a range of words, so
segments are filled apart and put side by side.
"""

from __future__ import annotations

import math

import numpy as np

from .shingles import mix

BASE = 1.5
BITS_PER_ENTRY = 14
PROBES = 5
LEVELS = 112  # a count of 64 bits is at level 112 at most

_U = np.uint64


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences, byte plane by byte plane
    (high bytes repeat, so compressors see long runs)."""
    return pack(np.diff(x, prepend=x.dtype.type(0)))


def unpack_sorted(raw: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(raw, dtype), dtype=dtype)


def pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def unpack(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def bigram_keys(before: np.ndarray, after: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, 32-bit key) of word pairs given as word hashes."""
    h = mix(mix(before + _U(0x9E3779B97F4A7C15)) + after)
    return ((h >> _U(32)) % _U(segments)).astype(np.int64), (h & _U(0xFFFFFFFF)).astype(np.uint32)


def level(counts: np.ndarray) -> np.ndarray:
    """The level of a count of 1 or more."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def level_counts(top: int) -> np.ndarray:
    """The expected count for each level up to ``top``: the middle of the
    whole numbers that it holds; 0 for level 0."""
    out = [0.0]
    for q in range(1, top + 1):
        low, high = math.ceil(BASE ** (q - 1) - 1e-9), math.ceil(BASE ** q - 1e-9) - 1
        out.append((low + max(low, high)) / 2)
    return np.array(out)


def histogram(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how many counts, their sum) for each level; zeros are left out."""
    counts = counts[counts > 0]
    q = level(counts)
    return (np.bincount(q, minlength=LEVELS).astype(np.int64),
            np.rint(np.bincount(q, weights=counts, minlength=LEVELS)).astype(np.int64))


def followers_exponent(number: np.ndarray, total: np.ndarray, bigrams: int) -> float:
    """The b in [0, 1] for which counts c, given by their histogram, have
    ``bigrams`` as the sum of c ** b: a word seen c times is then expected to
    have c ** b distinct followers."""
    some = number > 0
    number, mean = number[some], total[some] / number[some]
    low, high = 0.0, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if (number * mean ** mid).sum() < bigrams else (low, mid)
    return low


def _places(segment, key: np.ndarray, q: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(word inside the segment, bits) of the entries (key, level q)."""
    h = mix((np.asarray(segment).astype(np.uint64) << _U(32) | key.astype(np.uint64)) + mix(np.array([q], np.uint64)))
    g = mix(h)
    bits = np.zeros(len(key), np.uint64)
    for i in range(PROBES):
        bits |= _U(1) << ((g >> _U(6 * i)) & _U(63))
    return (h % _U(words)).astype(np.int64), bits


def fill_segment(segment: int, keys: np.ndarray, counts: np.ndarray, words: int) -> np.ndarray:
    """The words of one segment, holding keys with counts of 1 or more."""
    out = np.zeros(words, np.uint64)
    q = level(counts)
    for j in range(1, int(q.max(initial=0)) + 1):
        at, bits = _places(segment, keys[q >= j], j, words)
        np.bitwise_or.at(out, at, bits)
    return out


class CountFilter:
    """Segments side by side: all of them, or those from ``start`` on."""

    def __init__(self, table: np.ndarray, segments: int, top: int, start: int = 0):
        self.table, self.segments, self.top, self.start = table, segments, top, start
        self.words = len(table) // segments
        self.expected = level_counts(top)

    def counts(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Expected counts of word pairs by repeated probes; 0 if not held."""
        return self.expected[self.levels(*bigram_keys(before, after, self.segments))]

    def levels(self, segment: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The levels of keys of the segments held here; 0 if not held."""
        found = np.zeros(len(key), np.int64)
        alive = np.arange(len(key))
        for q in range(1, self.top + 1):
            if not len(alive):
                break
            at, bits = _places(segment[alive], key[alive], q, self.words)
            alive = alive[self.table[(segment[alive] - self.start) * self.words + at] & bits == bits]
            found[alive] = q
        return found
