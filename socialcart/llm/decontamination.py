"""Benchmark decontamination: documents that hold test items.

Test items are cut into parts of at most ``PART`` words and indexed (BM25,
block-max WAND, see ``bm25``).  Every document is cut into passages of
2 * PART words, one each PART words, so a part lies whole in some passage; every
passage is a query, and all parts at or above ``THRESHOLD`` of their own score
are retrieved.  Each retrieved item is then verified in the document around
the passage: the share of the shingles of its question and of its answer that
occur there.  An item is leaked if that share is at least ``OVERLAP`` over both.

Words are runs of letters, digits and characters beyond ASCII, lower-cased;
shingles are five words (all words of a question or answer that is shorter).
The answer of an item is what follows its last sentence end, line end or
question mark with at least three words after it; an item of one sentence has
its last quarter as answer.

Documents never meet: the index is sent to the tasks and rows pass through.
An index holds at most ``INDEX_BYTES`` of items; larger benchmarks are taken
in several such blocks, all of them against all documents.

Defined cases: null or empty text leaks nothing; items with fewer than five
words are not searched (any text would hold them); items repeated with the
same id and text count once; null ids stay null; an empty benchmark flags
nothing; other columns pass through untouched.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bm25 import Index
from .common import map_arrow, text_slices

PART = 32
THRESHOLD = 0.55
OVERLAP = 0.4
WIDTH = 5
INDEX_BYTES = 1_000_000
BATCH_BYTES = 1_000_000

_BLANK = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BLANK).split()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of an item's question and of its answer."""
    for end in reversed([m.end() for m in re.finditer(r"[.?!]\s|\n", text)]):
        question, answer = words_of(text[:end]), words_of(text[end:])
        if len(answer) >= 3 and question:
            return question, answer
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def _shingles(words: list[bytes], width: int) -> set[tuple]:
    return set(zip(*(words[i:] for i in range(width)), strict=False))


class Matcher:
    """Finds the items of one index block in texts."""

    def __init__(self, items: list[tuple[int | None, str]], part: int = PART, threshold: float = THRESHOLD,
                 overlap: float = OVERLAP):
        self.part, self.threshold, self.overlap = part, threshold, overlap
        self.items, self.owner, units = [], [], []
        for item_id, text in items:
            words = words_of(text)
            if len(words) < WIDTH:
                continue
            parts = []
            for side in question_answer(text):
                width = max(1, min(WIDTH, len(side)))
                parts.append((width, _shingles(side, width)))
            n = -(-len(words) // part)
            for i in range(n):
                units.append(words[len(words) * i // n:len(words) * (i + 1) // n])
                self.owner.append(len(self.items))
            self.items.append((item_id, len(words), parts))
        self.index = Index(units) if units else None

    def _passages(self, terms: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct terms of all passages of some texts (``starts``: where
        each text begins, and the end): terms, where each passage's begin, and
        the passage number in units of PART words over all texts."""
        lengths = np.diff(starts)
        chunks = -(-lengths // self.part)
        base = np.concatenate([[0], np.cumsum(chunks)])
        text = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(terms)) - starts[text]
        chunk = place // self.part
        known = terms >= 0
        own = (base[text] + chunk)[known]
        before = known & (chunk > 0)  # the second half of the passage before
        passage = np.concatenate([own, (base[text] + chunk)[before] - 1])
        key = np.unique(passage * len(self.index.vocab) + np.concatenate([terms[known], terms[before]]))
        passage, term = np.divmod(key, len(self.index.vocab))
        first = np.flatnonzero(np.diff(passage, prepend=-1))
        return term, first, passage[first]

    def find(self, texts: list[str | None]) -> list[list[dict]]:
        """Per text, a row for each leaked item."""
        out: list[list[dict]] = [[] for _ in texts]
        if self.index is None:
            return out
        words = [words_of(t) for t in texts]
        starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        terms = self.index.terms([x for w in words for x in w])
        if not (terms >= 0).any():
            return out
        term, first, passage = self._passages(terms, starts)
        base = np.concatenate([[0], np.cumsum(-(-np.diff(starts) // self.part))])
        ends = np.append(first[1:], len(term))
        hits: dict[tuple[int, int], list] = {}
        for q, blocks in self.index.live_blocks(term, first, self.threshold):
            found = self.index.search(term[first[q]:ends[q]].tolist(), blocks.tolist(), self.threshold)
            if found:
                doc = int(np.searchsorted(base, passage[q], "right")) - 1
                at = (int(passage[q]) - int(base[doc])) * self.part
                for unit, score in found:
                    hits.setdefault((doc, self.owner[unit]), []).append((at, score))
        for (doc, item), places in hits.items():
            item_id, length, parts = self.items[item]
            sides = [set(), set()]
            for at, _ in places:
                around = words[doc][max(0, at - length):at + 2 * self.part + length]
                for seen, (width, wanted) in zip(sides, parts, strict=True):
                    seen |= wanted & _shingles(around, width)
            total = sum(len(wanted) for _, wanted in parts)
            share = sum(map(len, sides)) / total
            if share >= self.overlap:
                each = [len(s) / len(wanted) if wanted else 0.0 for s, (_, wanted) in zip(sides, parts, strict=True)]
                out[doc].append({"item_id": item_id, "bm25": max(s for _, s in places), "question_overlap": each[0],
                                 "answer_overlap": each[1], "overlap": share, "passages": len(places)})
        return out


def _matchers(benchmark: DataFrame, id_col: str, text_col: str, index_bytes: int) -> list[Matcher]:
    """One matcher per block of items; what the driver holds is a block."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(
        "text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // index_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for i in range(blocks):
        rows = sorted(((r.id, r.text) for r in items.where(part == i).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield Matcher(rows)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, bm25 (share of
    the item part's own score), question_overlap, answer_overlap, overlap,
    passages (how many retrieved it).  Clean documents give no row."""
    names = ["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap", "overlap", "passages"]
    schema = pa.schema([(n, pa.int64() if n in ("doc_id", "item_id", "passages") else pa.float64()) for n in names])
    own = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    out = None
    for matcher in _matchers(benchmark, item_id_col, item_text_col, index_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(matcher)

        def run(batches, sent=sent):
            for batch in batches:
                ids = batch.column(0)
                for at, some in text_slices(batch.column(1), BATCH_BYTES):
                    rows = [r | {"doc_id": ids[at + i].as_py()} for i, found in enumerate(sent.value.find(some)) for r in found]
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

        found = map_arrow(own, run, ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'double'}" for f in schema))
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` without the documents that hold a leaked item; rows pass
    through the tasks that read them, all columns kept, nothing shuffles."""
    at = docs.columns.index(text_col)
    for matcher in _matchers(benchmark, item_id_col, item_text_col, index_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(matcher)

        def run(batches, sent=sent):
            for batch in batches:
                clean = [not found for _, some in text_slices(batch.column(at), BATCH_BYTES) for found in sent.value.find(some)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = map_arrow(docs, run, docs.schema)
    return docs
