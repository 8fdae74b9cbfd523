"""Word shingles of texts, and their fast similarity sketch (numpy).

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a shingle
is ``width`` words in a row, known by a 64-bit hash.  A text with fewer words
is one shingle; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
CACHE_WORDS = 200_000

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of SplitMix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHasher:
    """Words of a text as 64-bit hashes; keeps those of the words seen, up to
    ``cache_words``, then starts afresh."""

    def __init__(self, cache_words: int = CACHE_WORDS):
        self.cache: dict[bytes, int] = {}
        self.cache_words = cache_words

    def hashes(self, words: list[bytes]) -> np.ndarray:
        cache = self.cache
        if len(cache) > self.cache_words:
            cache.clear()
        for w in [w for w in set(words) if w not in cache]:
            cache[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hasher: WordHasher, texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Per text, the sorted distinct shingle hashes."""
    words = [t.lower().split() for t in texts]  # of bytes: A-Z only, ASCII white space only
    h = hasher.hashes([w for ws in words for w in ws])
    rolled = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for j in range(width):  # an odd multiplier per place, then a mixer
        rolled += mix(h[j:j + len(rolled)] + _U(j + 1)) * _U(2 * j + 3)
    rolled = mix(rolled)
    out, at = [], 0
    for ws in words:
        n = len(ws)
        if n >= width:
            out.append(np.unique(rolled[at:at + n - width + 1]))
        elif n:
            short = xxhash.xxh3_64_intdigest(h[at:at + n].tobytes(), seed=n)
            out.append(np.array([short], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Fast similarity sketches: one row of ``size`` coordinates per set.

    In round i every element is thrown into a bin by the round's hash, with a
    value that begins with i; a bin keeps its least value.  Rounds go on while
    a set has an empty bin.  After ``size`` rounds come ``size`` more in which
    all elements go to one bin each, so every coordinate of a set that is not
    empty fills.  All sets of a batch go through a round together; only those
    with empty bins go on to the next.  ``size`` is a power of two."""
    out = np.full(len(sets) * size, np.iinfo(np.uint64).max, np.uint64)
    x = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bits = _U(64 - (size.bit_length() - 1))
    low = _U((1 << 56) - 1)
    for i in range(2 * size):
        if not len(x):
            break
        h = mix(x ^ mix(np.array([i + 1], np.uint64)))
        place = owner * size + ((h >> bits).astype(np.int64) if i < size else i - size)
        # bins use the high bits, so values come from a second mix
        np.minimum.at(out, place, (mix(h) & low) | _U(min(i, 255) << 56))
        empty = (out.reshape(-1, size) == np.iinfo(np.uint64).max).any(axis=1)
        on = empty[owner]
        x, owner = x[on], owner[on]
    return out.reshape(-1, size)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A signed 64-bit key per band of ``rows`` coordinates (the band's
    number is part of it)."""
    n, size = sketch.shape
    cut = sketch.reshape(n, size // rows, rows)
    key = np.broadcast_to(mix(np.arange(1, size // rows + 1, dtype=np.uint64)), (n, size // rows)).copy()
    for j in range(rows):
        key = mix(key ^ cut[:, :, j]) + _U(j)
    return key.view(np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
