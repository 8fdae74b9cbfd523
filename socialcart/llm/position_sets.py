"""Ordered sets of positions and the union-find over them.

A set keeps its positions in sorted blocks, so a lookup or an insertion costs
a few bisections and one short memory move however large the set grows; a
union moves the smaller set into the larger one, so a position moves at most
log2(n) times."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

BLOCK = 512


class Positions:
    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, positions: list[int]):
        """``positions``: in order, at least one and at most ``2 * BLOCK``."""
        self.blocks, self.firsts, self.size = [positions], [positions[0]], len(positions)

    def __len__(self) -> int:
        return self.size

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The positions next before and next after ``x``."""
        b = bisect_right(self.firsts, x) - 1
        if b < 0:
            return None, self.firsts[0]
        block = self.blocks[b]
        i = bisect_right(block, x)
        if i < len(block):
            return block[i - 1], block[i]
        return block[-1], self.firsts[b + 1] if b + 1 < len(self.firsts) else None

    def add(self, x: int) -> None:
        b = max(bisect_right(self.firsts, x) - 1, 0)
        block = self.blocks[b]
        insort(block, x)
        self.firsts[b] = block[0]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[b:b + 1] = [block[:BLOCK], block[BLOCK:]]
            self.firsts[b:b + 1] = [block[0], block[BLOCK]]

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


class Classes:
    """Union-find over numbered members whose classes know their positions in
    order: a list as long as that is short, then ``Positions``."""

    def __init__(self, positions: list[int]):
        self.parent = list(range(len(positions)))
        self.sets: list[list[int] | Positions | None] = [[p] for p in positions]

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def unite(self, x: int, y: int) -> list[tuple[int, int]]:
        """Unite the classes of the members ``x`` and ``y``; the pairs of
        positions, one from each class, that are neighbours from now on."""
        a, b = self.find(x), self.find(y)
        if a == b:
            return []
        if len(self.sets[a]) < len(self.sets[b]):
            a, b = b, a
        large, small = self.sets[a], self.sets[b]
        self.parent[b], self.sets[b] = a, None
        if len(small) == 1 and type(large) is list and len(large) < BLOCK:
            p = small[0]
            i = bisect_right(large, p)
            large.insert(i, p)
            new = [(large[i - 1], p)] if i else []
            return new + [(p, large[i + 1])] if i + 1 < len(large) else new
        if type(large) is list:
            large = self.sets[a] = Positions(large)
        small, new, last = list(small), [], None  # last: the next smaller position of the small set
        for i, p in enumerate(small):
            before, after = large.around(p)
            if before is not None and (last is None or last < before):
                new.append((before, p))
            if after is not None and (i + 1 == len(small) or small[i + 1] > after):
                new.append((p, after))
            last = p
        for p in small:
            large.add(p)
        return new
