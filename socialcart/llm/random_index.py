"""Random indexing (numpy): tokens, index vectors, context sums, pooling.

Tokens are runs of letters and digits, lower-cased, and runs of other
characters; a word in capitals is preceded by a marker, and a token that
repeats the one before it is replaced by another marker.  Tokens are hashed
into ``BUCKETS``.  Each bucket has a fixed sparse index vector of +1 and -1;
its context vector is the sum of the index vectors found around it.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

BUCKETS = 2 ** 14
DIM = 32
NONZERO = 4
WINDOW = 2
REPEAT, CAPITALS = 0, 1
CACHE_CHUNKS = 200_000

_RUNS = re.compile(r"[^\W_]+|[\W_]+")


class TokenCoder:
    """Whole texts as bucket numbers; keeps those of blank-separated chunks
    seen, up to ``cache_chunks``, then starts afresh."""

    def __init__(self, cache_chunks: int = CACHE_CHUNKS):
        self.cache: dict[bytes, bytes] = {}
        self.cache_chunks = cache_chunks

    @staticmethod
    def _buckets(chunk: bytes) -> bytes:
        out = []
        for run in _RUNS.findall(chunk.decode()):
            if len(run) > 1 and run.isupper():
                out.append(CAPITALS)
            token = run.lower() if run[0].isalnum() else run[:4]
            out.append(2 + xxhash.xxh3_64_intdigest(token) % (BUCKETS - 2))
        return np.array(out, np.uint16).tobytes()

    def __call__(self, text: bytes | None) -> np.ndarray:
        chunks = (text or b"").split()
        if len(self.cache) > self.cache_chunks:
            self.cache.clear()
        for c in set(chunks):
            if c not in self.cache:
                self.cache[c] = self._buckets(c)
        ids = np.frombuffer(b"".join(map(self.cache.__getitem__, chunks)), np.uint16).astype(np.int64)
        out = ids.copy()
        out[1:][ids[1:] == ids[:-1]] = REPEAT
        return out


def index_vectors(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vectors' NONZERO entries."""
    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


class ContextSums:
    """Context vectors summed over texts."""

    def __init__(self):
        self.places, self.signs = index_vectors()
        self.sums = np.zeros(BUCKETS * DIM)

    def add(self, texts: list[np.ndarray]) -> None:
        gap = np.full(WINDOW, -1, np.int64)  # no context across texts
        ids = np.concatenate([x for t in texts for x in (t, gap)] or [gap])
        for apart in range(1, WINDOW + 1):
            a, b = ids[:-apart], ids[apart:]
            both = (a >= 0) & (b >= 0)
            for word, near in ((a[both], b[both]), (b[both], a[both])):
                for j in range(NONZERO):
                    self.sums += np.bincount(word * DIM + self.places[near, j], weights=self.signs[near, j],
                                             minlength=BUCKETS * DIM)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Context vectors of unit length, around their mean."""
    c = sums.reshape(BUCKETS, DIM)
    seen = np.abs(c).sum(axis=1) > 0
    unit = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    if seen.any():
        unit = np.where(seen[:, None], unit - unit[seen].mean(axis=0), 0.0)
    return unit.astype(np.float32)


def pool(vectors: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Per text the mean and the standard deviation of its word vectors, and
    the share of repeats; zeros for an empty text.  ``vectors`` holds the word
    vectors and their squares side by side."""
    out = np.zeros((len(texts), vectors.shape[1] + 1), np.float32)
    for i, ids in enumerate(texts):
        if len(ids):
            total = np.zeros(vectors.shape[1])
            for at in range(0, len(ids), 20_000):
                total += vectors[ids[at:at + 20_000]].sum(axis=0, dtype=np.float64)
            mean, square = np.split(total / len(ids), 2)
            out[i] = [*mean, *np.sqrt(np.maximum(square - mean ** 2, 0)), (ids == REPEAT).mean()]
    return out
