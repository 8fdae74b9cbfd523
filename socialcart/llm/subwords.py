"""Averaged hashed subword embeddings with a linear softmax (numpy).

A word's subwords are its byte n-grams (2 to 4 bytes, with word ends marked),
hashed into buckets.  A document is the mean of its subwords' embeddings.
"""

from __future__ import annotations

import numpy as np

from .shingles import mix

BUCKETS = 2 ** 16
SIZES = (2, 3, 4)
CACHE_WORDS = 100_000

# ASCII characters that are not letters part words; letters are lower-cased
_PART = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_PART).split()


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every subword of every word."""
    raw = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    owners, buckets = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in SIZES:
        m = max(0, len(raw) - n + 1)
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(257) + raw[j:j + m]
        inside = word[:m] == word[n - 1:n - 1 + m]
        owners.append(word[:m][inside])
        buckets.append((mix(h[inside]) & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


def bucket_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    words = words_of(text)
    distinct = sorted(set(words))
    number = {w: i for i, w in enumerate(distinct)}
    times = np.bincount(np.fromiter(map(number.__getitem__, words), np.int64, len(words)), minlength=len(distinct))
    owner, bucket = subwords(distinct)
    found, at = np.unique(bucket, return_inverse=True)
    return found.astype(np.int32), np.bincount(at, weights=times[owner], minlength=len(found)).astype(np.int32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(buckets: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, classes: int, dim: int = 16,
          epochs: int = 6, least_steps: int = 400, batch: int = 32, rate: float = 20.0, seed: int = 7) -> np.ndarray:
    """Stochastic gradient descent on the cross-entropy, for ``epochs`` or
    more (few documents: until ``least_steps``); returns the logits that each
    bucket contributes (embeddings times output weights)."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (dim, classes)).astype(np.float32)
    usable = np.flatnonzero([len(b) > 0 for b in buckets])
    each = -(-len(usable) // batch)
    epochs = max(epochs, -(-least_steps // max(each, 1)))
    steps = epochs * each
    step = 0
    for _ in range(epochs):
        order = rng.permutation(usable)
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            idx = np.concatenate([buckets[i] for i in pick])
            first = np.concatenate([[0], np.cumsum([len(buckets[i]) for i in pick])[:-1]])
            share = np.concatenate([counts[i] / counts[i].sum() for i in pick]).astype(np.float32)
            doc = np.repeat(np.arange(len(pick)), [len(buckets[i]) for i in pick])
            hidden = np.add.reduceat(emb[idx] * share[:, None], first, axis=0)
            error = softmax(hidden @ out)
            error[np.arange(len(pick)), labels[pick]] -= 1
            error /= len(pick)
            lr = rate * (1 - step / steps)
            back = (error @ out.T).astype(np.float32)
            out -= (0.05 * lr) * (hidden.T @ error).astype(np.float32)
            flat = (idx[:, None].astype(np.int64) * dim + np.arange(dim)).ravel()
            np.subtract.at(emb.ravel(), flat, (lr * share[:, None] * back[doc]).ravel())
            step += 1
    return emb @ out


def scores(logits: np.ndarray, buckets: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
    """Logits of documents given as bucket counts."""
    return np.array([(logits[b] * (c / max(c.sum(), 1))[:, None]).sum(axis=0) for b, c in zip(buckets, counts, strict=True)]
                    ).reshape(len(buckets), logits.shape[1])


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The factor on logits that makes held-back labels most likely."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 61))
    loss = [-np.log(softmax(logits * g)[np.arange(len(labels)), labels] + 1e-12).mean() for g in grid]
    return float(grid[int(np.argmin(loss))]) if len(labels) else 1.0


class Scorer:
    """Logits of whole texts; keeps the sums of the words seen, up to
    ``cache_words``, then starts afresh."""

    def __init__(self, logits: np.ndarray, cache_words: int = CACHE_WORDS):
        self.logits, self.cache_words = logits, cache_words
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.sums = np.zeros((1024, self.logits.shape[1] + 1), np.float32)

    def _learn(self, words: list[bytes]) -> None:
        owner, bucket = subwords(words)
        own = [np.bincount(owner, weights=self.logits[bucket, k], minlength=len(words)) for k in range(self.logits.shape[1])]
        own.append(np.bincount(owner, minlength=len(words)))
        n = len(self.number)
        if n + len(words) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((max(len(self.sums), len(words)), self.sums.shape[1]), np.float32)])
        self.sums[n:n + len(words)] = np.array(own).T
        self.number.update(zip(words, range(n, n + len(words)), strict=True))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if len(self.number) > self.cache_words:
            self._clear()
        words = [words_of(t) for t in texts]
        new = sorted(w for w in set().union(*words) if w not in self.number)
        if new:
            self._learn(new)
        out = np.zeros((len(texts), self.sums.shape[1]))
        lengths = np.array([len(w) for w in words])
        if lengths.sum():
            at = np.fromiter((self.number[w] for ws in words for w in ws), np.int64, lengths.sum())
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])[lengths > 0]
            out[lengths > 0] = np.add.reduceat(self.sums[at].astype(np.float64), first, axis=0)
        return out[:, :-1] / np.maximum(out[:, -1:], 1)
