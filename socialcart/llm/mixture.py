"""The deficit round-robin behind packing: which tokens of which queue go to
which window, as a function that any task can evaluate for its own documents.

A schedule is a tree.  A node covers some windows and has a quota of tokens
for each queue that fills them exactly.  It is dealt to its children in
rounds: each round credits every queue with its quota's share of the child's
windows, takes the whole tokens of the credit, lets the queues with the
largest credit fill up the child, and carries what is left, positive or
negative, to the next round.  All arithmetic is on integers, so the credits
are zero at the end of a node and every task finds the same cuts.  At the
leaves a round is one window.
"""

from __future__ import annotations

import functools
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

FANOUT = 64


def rounds(quota: list[int], sizes: list[int], capacity: int) -> Iterator[list[int]]:
    """Deal ``quota`` (summing to capacity * sum(sizes)) over children of
    ``sizes`` windows; yields what each child takes of each queue."""
    total = sum(sizes)
    credit = [0] * len(quota)  # in units of 1 / total tokens
    for size in sizes:
        credit = [c + q * size for c, q in zip(credit, quota, strict=True)]
        take = [max(0, c // total) for c in credit]
        short = size * capacity - sum(take)
        if short:
            order = sorted(range(len(quota)), key=lambda i: (take[i] * total - credit[i], i))
            for i in order[:short]:
                take[i] += 1
        credit = [c - t * total for c, t in zip(credit, take, strict=True)]
        yield take


def apportion(amount: int, weights: list[int]) -> list[int]:
    """Whole parts of ``amount`` by ``weights``, the largest remainders up."""
    whole = sum(weights)
    parts = [amount * w // whole for w in weights]
    order = sorted(range(len(weights)), key=lambda i: (-(amount * weights[i] % whole), i))
    for i in order[:amount - sum(parts)]:
        parts[i] += 1
    return parts


def phases(totals: list[int], weights: list[int] | None, capacity: int) -> list[tuple[int, list[int]]]:
    """(windows, quota per queue) in order; within a phase the set of queues
    with tokens is fixed.  Without weights each queue's share is its share of
    all tokens, so there is one phase and a last window with the rest.  With
    weights, a queue that runs dry leaves its share to the others."""
    left, out = list(totals), []
    while sum(left) >= capacity:
        weight = [(left[i] if weights is None else weights[i]) if left[i] else 0 for i in range(len(left))]
        if not sum(weight):  # only queues of weight 0 remain
            weight = list(left)
        n = min(left[i] * sum(weight) // (capacity * w) for i, w in enumerate(weight) if w)
        if n:
            quota = apportion(capacity * n, weight)
        else:  # a queue ends inside this window: it gives its rest, the others fill up
            n, quota, open_ = 1, [0] * len(left), {i for i, w in enumerate(weight) if w}
            while (room := capacity - sum(quota)) > 0:
                if not open_:
                    open_ = {i for i in range(len(left)) if left[i] > quota[i]}
                share = apportion(room, [(weight[i] or 1) if i in open_ else 0 for i in range(len(left))])
                quota = [min(q + s, t) for q, s, t in zip(quota, share, left, strict=True)]
                open_ = {i for i in open_ if quota[i] < left[i]}
        out.append((n, quota))
        left = [t - q for t, q in zip(left, quota, strict=True)]
    if sum(left):
        out.append((1, left))
    return out


class Leaf:
    """At most FANOUT windows: ``served[w][q]`` tokens of queue q lie before
    window w, and ``offset[w][q]`` is where its run starts in window w."""

    def __init__(self, first: int, start: list[int], takes: list[list[int]]):
        self.first = first
        self.served = [start]
        for take in takes:
            self.served.append([a + b for a, b in zip(self.served[-1], take, strict=True)])
        self.offset = [list(accumulate(take, initial=0)) for take in takes]
        self.bounds = list(zip(*self.served, strict=True))  # by queue


class Schedule:
    def __init__(self, plan: list[tuple[int, list[int]]], capacity: int):
        self.plan, self.capacity = plan, capacity
        self.first = list(accumulate((n for n, _ in plan), initial=0))
        self.start = [[0] * (len(plan[0][1]) if plan else 0)]
        for _, quota in plan:
            self.start.append([a + b for a, b in zip(self.start[-1], quota, strict=True)])
        self.children = functools.lru_cache(maxsize=64)(self._children)
        self.leaf = functools.lru_cache(maxsize=512)(self._leaf)

    def _children(self, first: int, n: int, start: tuple, quota: tuple) -> list[tuple]:
        width = FANOUT
        while width * FANOUT < n:
            width *= FANOUT
        sizes = [min(width, n - i) for i in range(0, n, width)]
        out, at = [], list(start)
        for size, take in zip(sizes, rounds(list(quota), sizes, self.capacity), strict=True):
            out.append((first, size, tuple(at), tuple(take)))
            first, at = first + size, [a + t for a, t in zip(at, take, strict=True)]
        return out

    def _leaf(self, first: int, n: int, start: tuple, quota: tuple) -> Leaf:
        takes = [list(quota)] if n == 1 else list(rounds(list(quota), [1] * n, self.capacity))
        return Leaf(first, list(start), takes)

    def find(self, queue: int, x: int) -> Leaf:
        """The leaf that holds token x of a queue."""
        i = bisect_right(self.start, x, key=lambda s: s[queue]) - 1
        n, quota = self.plan[i]
        node = (self.first[i], n, tuple(self.start[i]), tuple(quota))
        while node[1] > FANOUT:
            kids = self.children(*node)
            node = kids[bisect_right(kids, x, key=lambda k: k[2][queue]) - 1]
        return self.leaf(*node)

    def pieces(self, queue: int, a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
        """(from, to, window, offset) for the tokens [a, b) of a queue."""
        while a < b:
            leaf = self.find(queue, a)
            bounds = leaf.bounds[queue]
            w = bisect_right(bounds, a) - 1
            while a < b and w < len(bounds) - 1:
                if (end := min(b, bounds[w + 1])) > a:
                    yield a, end, leaf.first + w, leaf.offset[w][queue] + a - bounds[w]
                    a = end
                w += 1
