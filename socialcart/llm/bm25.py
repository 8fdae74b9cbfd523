"""A BM25 inverted index with block-max WAND (numpy and plain Python).

Indexed units are numbered, and blocks are ranges of numbers.  Impacts are
divided by the unit's own score, so a query that holds all words of a unit
scores 1 and one threshold serves all units.  For each term the index has its
postings, its largest impact, and its largest impact in each block.

``live_blocks`` takes many queries at once and finds, by the block maxima, the
blocks whose bound reaches the threshold; ``search`` runs WAND over the
postings of one query inside its live blocks.  Both use upper bounds only, so
every unit at or above the threshold is found with its exact score.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import repeat

import numpy as np

K1, B = 1.2, 0.75
BLOCK = 4
TABLE_FLOATS = 4_000_000
SLACK = 1e-4  # for the rounding of bounds kept as 32-bit floats
ROUND = 1e-9


class Index:
    def __init__(self, units: list[list[bytes]], block: int = BLOCK):
        n = len(units)
        df = Counter(t for u in units for t in set(u))
        mean = sum(map(len, units)) / max(n, 1)
        self.vocab = {t: i for i, t in enumerate(sorted(df))}
        self.block = max(block, math.ceil(len(df) * n / TABLE_FLOATS))
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for u, words in enumerate(units):
            own = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1)
                   / (f + K1 * (1 - B + B * len(words) / mean)) for t, f in Counter(words).items()}
            whole = sum(own.values())
            for t, w in own.items():
                postings[self.vocab[t]].append((u, w / whole))
        self.units = [[u for u, _ in postings[t]] for t in range(len(df))]
        self.impacts = [[w for _, w in postings[t]] for t in range(len(df))]
        self.largest = [max(w) for w in self.impacts]
        self.block_max = np.zeros((len(df), -(-n // self.block)), np.float32)
        for t in range(len(df)):
            for u, w in postings[t]:
                self.block_max[t, u // self.block] = max(w, self.block_max[t, u // self.block])

    def terms(self, words: list[bytes]) -> np.ndarray:
        """Term numbers of words, -1 for others."""
        return np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, len(words))

    def live_blocks(self, terms: np.ndarray, first: np.ndarray, threshold: float,
                    chunk: int = 20_000) -> list[tuple[int, np.ndarray]]:
        """(query, its live blocks), for queries whose distinct terms start
        at ``first`` (ascending, no empty query) in ``terms``."""
        out = []
        ends = np.append(first[1:], len(terms))
        q = 0
        while q < len(first):
            stop = max(q + 1, int(np.searchsorted(ends, first[q] + chunk, "right")))
            some = terms[first[q]:ends[stop - 1]]
            bound = np.add.reduceat(self.block_max[some], first[q:stop] - first[q], axis=0)
            hit = bound >= threshold - SLACK
            out += [(q + i, np.flatnonzero(hit[i])) for i in np.flatnonzero(hit.any(axis=1))]
            q = stop
        return out

    def search(self, terms: list[int], blocks: list[int], threshold: float) -> list[tuple[int, float]]:
        """All units of ``blocks`` that score at least ``threshold``."""
        found = []
        for block in blocks:
            found += self._wand(terms, block, threshold)
        return found

    def _wand(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        end, out, cursors = (block + 1) * self.block, [], []
        for t in terms:  # cursors: [unit, place in the postings, term, bound in this block]
            at = bisect_left(self.units[t], block * self.block)
            if at < len(self.units[t]) and self.units[t][at] < end:
                cursors.append([self.units[t][at], at, t, min(self.largest[t], float(self.block_max[t, block]) + 1e-7)])

        def move(c: list, to: int) -> None:
            ids = self.units[c[2]]
            c[1] = bisect_left(ids, to, c[1])
            c[0] = ids[c[1]] if c[1] < len(ids) and ids[c[1]] < end else end

        while True:
            cursors = sorted(c for c in cursors if c[0] < end)
            bound, pivot = 0.0, None
            for c in cursors:
                bound += c[3]
                if bound >= threshold - ROUND:
                    pivot = c[0]
                    break
            if pivot is None:
                return out
            if cursors[0][0] == pivot:
                score = sum(self.impacts[c[2]][c[1]] for c in cursors if c[0] == pivot)
                if score >= threshold - ROUND:
                    out.append((pivot, score))
                for c in cursors:
                    if c[0] == pivot:
                        move(c, pivot + 1)
            else:
                for c in cursors:
                    if c[0] < pivot:
                        move(c, pivot)
