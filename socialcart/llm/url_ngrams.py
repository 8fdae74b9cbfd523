"""Hashed character n-grams of URL parts, in bulk, and the logistic regression
over them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

SIZES = (3, 4, 5)
BUCKETS = 2 ** 18
ONE_DIGIT = bytes.maketrans(b"0123456789", b"0" * 10)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd; spreads a sum over 64 bits


def ngram_buckets(parts: Sequence[bytes], kind: int, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(part number, bucket) of every n-gram of ``parts``.  A part stands
    between two edge marks, so its ends are n-grams of their own; ``kind``
    keeps hosts and paths apart, and all digits count as one, since numbers
    say which page it is rather than of what kind."""
    joined = b"".join(b"\x02" + p + b"\x03" for p in parts).translate(ONE_DIGIT)
    data = np.frombuffer(joined, np.uint8).astype(np.uint64) + np.uint64(1)
    sizes = np.fromiter((len(p) + 2 for p in parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts)), sizes)
    numbers, codes = [], []
    for size in SIZES:
        if len(data) < size:
            continue
        # at most five bytes: an n-gram is a number below 2**45
        gram = np.zeros(len(data) - size + 1, np.uint64)
        for k in range(size):
            gram = gram * np.uint64(257) + data[k:len(data) - size + 1 + k]
        inside = owner[:len(gram)] == owner[size - 1:]
        mixed = (gram[inside] + np.uint64((2 * size + kind) << 48)) * _MULTIPLIER
        mixed ^= mixed >> np.uint64(32)
        codes.append(((mixed * _MULTIPLIER) >> np.uint64(40)).astype(np.int64) % buckets)
        numbers.append(owner[:len(gram)][inside])
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(numbers), np.concatenate(codes)


def features(hosts: Sequence[bytes], paths: Sequence[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of all n-grams; the n-grams of a host, and those
    of a path, share one unit of length, so long parts weigh no more."""
    rows, codes, values = [], [], []
    for kind, parts in enumerate((hosts, paths)):
        row, code = ngram_buckets(parts, kind, buckets)
        count = np.bincount(row, minlength=len(parts))
        rows.append(row)
        codes.append(code)
        values.append(1 / np.sqrt(np.maximum(count, 1))[row])
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)


def margins(weights: np.ndarray, rows: np.ndarray, codes: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Weighted sums per row; the last weight is the bias."""
    return np.bincount(rows, weights[codes] * values, minlength=n) + weights[-1]


def fit_logistic(rows: np.ndarray, codes: np.ndarray, values: np.ndarray, labels: np.ndarray, buckets: int = BUCKETS,
                 steps: int = 400, rate: float = 0.5, penalty: float = 1e-5) -> np.ndarray:
    """Weights by gradient steps with per-weight scale (AdaGrad) and an L2
    penalty; the bias learns how common label 1 is."""
    weights, squares = np.zeros(buckets + 1), np.full(buckets + 1, 1e-8)
    if not len(labels):
        return weights
    used = np.unique(codes)
    at = np.searchsorted(used, codes)
    for _ in range(steps):
        error = (sigmoid(margins(weights, rows, codes, values, len(labels))) - labels) / len(labels)
        slope = np.bincount(at, error[rows] * values, minlength=len(used)) + penalty * weights[used]
        squares[used] += slope ** 2
        weights[used] -= rate * slope / np.sqrt(squares[used])
        squares[-1] += error.sum() ** 2
        weights[-1] -= rate * error.sum() / np.sqrt(squares[-1])
    return weights


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
