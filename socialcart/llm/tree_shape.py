"""Shape of a two-level manifest tree: per source a tree over its leaves, and
one tree over the subroots of the sources, all with runs of ``ARITY`` nodes.

A node is a spec (top, source, level, index, n): ``top`` tells the tree over
the subroots, ``n`` is the number of leaves (or of sources) under the tree.
Its label orders nodes so that each comes after all that lies below it: the
last source and last leaf that it covers, then its level."""

from __future__ import annotations

ARITY = 3
#: Leaf place of the labels of the top tree: after all leaves of a source.
TOP_PLACE = 2 ** 62

Spec = tuple[int, int, int, int, int]
Label = tuple[int, int, int]


def width(level: int, n: int) -> int:
    """Nodes at ``level`` of a tree over ``n`` leaves."""
    return -(-n // ARITY ** level)


def label(spec: Spec) -> Label:
    top, source, level, index, n = spec
    last = min((index + 1) * ARITY ** level, n) - 1
    return (last, TOP_PLACE, level) if top else (source, last, level)


def parent(spec: Spec, sources: int) -> Spec | None:
    """The node above, None for the root of all."""
    top, source, level, index, n = spec
    if width(level, n) > 1:
        return top, source, level + 1, index // ARITY, n
    if top or sources == 1:
        return None
    return 1, 0, 1, source // ARITY, sources


def slot(spec: Spec) -> int:
    """The node's place among the children of its parent."""
    top, source, level, index, n = spec
    return (index if top or width(level, n) > 1 else source) % ARITY


def children(spec: Spec) -> int:
    _, _, level, index, n = spec
    return min(ARITY, width(level - 1, n) - ARITY * index)
