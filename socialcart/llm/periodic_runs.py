"""Periodic runs of words, by descending-LCP Kruskal.

A run is a stretch of consecutive words with smallest period q that repeats
at least ``MIN_EXPONENT`` times, has at least ``MIN_LENGTH`` words, and that
neither neighbouring word extends with the same period.

1. Classes.  The words of a slice of documents are numbered; prefix doubling
   ranks the word sequences of 1, 2, 4, ... words inside each document and
   goes on only with positions whose sequence is not alone.  Where a class of
   suffixes falls apart, neighbouring parts give an edge weighted with their
   longest common prefix (LCP); the edges are a spanning tree of the classes.
2. Kruskal.  Edges are taken by decreasing LCP.  Each unites two classes of
   suffixes, held as ordered sets of positions (``position_sets``).  Positions
   i < j of the two classes that become neighbours have exactly this LCP: the
   stretch from i to j + LCP has period j - i.  It seeds a run if the distance
   is small enough against the LCP and the word before i breaks the period.

Every run is found, with its smallest period: for a run of period q that
starts at s, s and s + q have LCP length - q, and a position of their class
between them would give the run a smaller period.  Edges below ``MIN_LCP``
cannot seed a run and are left out.

The work is one pass over the documents without a shuffle.  A task holds a
slice of about ``SLICE_BYTES`` of text, or one document if that is longer:
numbers in proportion to its words, times the logarithm of its longest repeat.

Defined cases: null or blank text has no words, no runs and an empty collapsed
text; a null id stays null; rows repeated with one id are documents of their
own; overlapping runs drop a word once; an empty table gives an empty table;
other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_slices
from .position_sets import Classes

MIN_LENGTH = 6
MIN_EXPONENT = 4
# length - period of the shortest runs: 6 - 1, 8 - 2 and 4q - q from q = 3 on
MIN_LCP = min(max(MIN_LENGTH, MIN_EXPONENT * q) - q for q in range(1, MIN_LENGTH + 1))
SLICE_BYTES = 1_500_000

Run = tuple[int, int, int]  # start, length, period


def _common_prefix(ranks: list[np.ndarray], ends: np.ndarray, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """LCP of the suffixes at ``a`` and ``b``, which agree on 2**level words
    but not on twice as many; ``ranks[k]`` tells sequences of 2**k words apart."""
    a, b = a + (1 << level), b + (1 << level)
    lcp = np.full(len(a), 1 << level, np.int64)
    last = len(ends) - 1
    stop_a, stop_b = ends[a - 1], ends[b - 1]
    for k in range(level - 1, -1, -1):
        same = (a < stop_a) & (b < stop_b)
        same &= ranks[k][np.minimum(a, last)] == ranks[k][np.minimum(b, last)]
        step = same.astype(np.int64) << k
        a, b, lcp = a + step, b + step, lcp + step
    return lcp


def class_edges(words: np.ndarray, ends: np.ndarray, least: int = MIN_LCP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, position, LCP) of the edges with an LCP of ``least`` or
    more.  ``words`` numbers the words of documents that follow one another;
    ``ends[i]`` is where the document of position i ends."""
    n = len(words)
    none = np.zeros(0, np.int64)
    edges = [(none, none, none)]
    if not n:
        return edges[0]
    rank = np.zeros(n, np.int32)
    live = np.argsort(ends * (int(words.max()) + 1) + words, kind="stable")
    first = words[live]
    head = np.r_[True, (first[1:] != first[:-1]) | (ends[live[1:]] != ends[live[:-1]])]
    at = np.arange(n, dtype=np.int64)
    rank[live] = np.maximum.accumulate(np.where(head, at, 0))
    ranks, level = [], 0
    while True:
        alone = head & np.r_[head[1:], True]
        live = live[~alone]
        if not len(live):
            break
        ranks.append(rank.copy())
        width = 1 << level
        old = rank[live].astype(np.int64)
        ahead = live + width
        inside = ahead < ends[live]
        key = old * (n + 1) + np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        live, key, old = live[order], key[order], old[order]
        head = np.r_[True, key[1:] != key[:-1]]
        old_head = np.r_[True, old[1:] != old[:-1]]
        if 2 * width > least:
            parted = np.flatnonzero(head & ~old_head)
            a, b = live[parted - 1], live[parted]
            lcp = _common_prefix(ranks, ends, a, b, level)
            keep = lcp >= least
            edges.append((a[keep], b[keep], lcp[keep]))
        at = np.arange(len(live), dtype=np.int64)
        place = old + at - np.maximum.accumulate(np.where(old_head, at, 0))
        rank[live] = np.maximum.accumulate(np.where(head, place, 0))
        level += 1
    return tuple(np.concatenate(x) for x in zip(*edges))


def runs_by_document(words: np.ndarray, sizes: list[int]) -> list[list[Run]]:
    """The runs of each document, by start and period."""
    sizes = np.asarray(sizes, np.int64)
    stops = np.cumsum(sizes)
    starts = stops - sizes
    out: list[list[Run]] = [[] for _ in sizes]
    a, b, lcp = class_edges(words, np.repeat(stops, sizes))
    order = np.argsort(-lcp, kind="stable")
    positions, members = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    classes = Classes(positions.tolist())
    # the word before each position; none equals another at the start of a document
    before = np.r_[-1, words[:-1]] if len(words) else words
    before[starts[sizes > 0]] = -1 - np.arange((sizes > 0).sum())
    before = dict(zip(positions.tolist(), before[positions].tolist()))
    for x, y, common in zip(members[:len(a)].tolist(), members[len(a):].tolist(), lcp[order].tolist()):
        for i, j in classes.unite(x, y):
            period = j - i
            if period * (MIN_EXPONENT - 1) <= common and common + period >= MIN_LENGTH and before[i] != before[j]:
                doc = int(np.searchsorted(stops, i, side="right"))
                out[doc].append((i - int(starts[doc]), common + period, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run contains after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of documents given as lists of words."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__  # a new word gets the next number
    flat = [number[w] for words in texts for w in words]
    return runs_by_document(np.asarray(flat, np.int64), [len(words) for words in texts])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: id, ``n_words``, ``runs`` (start, length, period
    in words, by start and period) and ``collapsed`` (the text without the
    repeats).  ``rewrite(id, words)`` may replace the words of a document
    before its runs are sought."""
    id_type = docs.schema[id_col].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column(1), SLICE_BYTES):
                ids = batch.column(0).slice(at, len(texts))
                words = [(t or b"").split() for t in texts]  # splits at bytes 0x20 and 0x09 to 0x0D
                if rewrite:
                    words = [rewrite(i, w) for i, w in zip(ids.to_pylist(), words)]
                runs = runs_of(words)
                found = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], pa.list_(run))
                text = pa.array([collapse(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(w) for w in words], pa.int64()), found, text],
                    ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return map_arrow(rows, search, f"id {id_type}, n_words long, "
                                   "runs array<struct<start:long,length:long,period:long>>, collapsed string"
                     ).withColumnRenamed("id", id_col)


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, the number of runs, the run with the greatest exact
    exponent (ties: smallest start, then period) and digests of all runs and
    of the collapsed text."""
    # length / period compared by cross products, so no exponent is rounded
    better = F.aggregate(
        "runs", F.expr("CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>)"),
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", better).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
