"""LM scoring: a bigram model whose counts sit in a broadcast log-frequency
Bloom filter, beside an exact unigram base score.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased,
then one end token.  The base score needs exact counts of every token, and
the vocabulary grows with the corpus, so it is never broadcast:

1. Tokens are coded by chunks (at most ``CHUNK_TOKENS``, or one document):
   each chunk numbers its own words and keeps their 64-bit hashes in order.
2. Chunks send (hash, training count) to hash segments; a segment adds up the
   counts and answers each chunk for its words.  The traffic is one entry per
   chunk and distinct word, not per document and word.
3. Bigrams of the training documents, added up in each chunk first, go to
   segments, too; a segment fills its part of the filter with all of them,
   those seen once included, BITS_PER_ENTRY bits for each entry.  The filter is
   cut into blocks of segments of at most ``MAX_FILTER_BYTES``, the bound of
   what is broadcast; their number grows with the corpus.  All counts cover
   the whole training part.
4. Chunk by chunk, coded tokens meet their exact counts, bigrams are probed,
   and P(w|v) = (c(vw) + T(v) P(w)) / (c(v) + T(v)) with the base's P(w), or
   P(w) where c(v) = 0: Witten-Bell smoothing.  T(v), the number of distinct
   followers, is taken as c(v) ** b; b is the exponent for which the sum over
   all words is the number of distinct bigrams.  The filter's c(vw) is held
   to c(v) and c(w) at most.  With several blocks, chunks first write their
   distinct bigrams by block; block after block is broadcast and probed with
   its own bigrams only, and chunks get the levels found back.

Segments grow with the input (``SEGMENT_BYTES`` of text each), so none outgrows
a task.  Defined cases: null text is empty and has the end token alone; a null
id counts as '' in the fold; repeated rows are scored each; an empty table
gives an empty table; with no training document all counts are 0; other
columns are not looked at.
"""

from __future__ import annotations

import math
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialcart.session import checkpoint_root

from .common import find_package, map_arrow, scratch_table
from .language_id import fold
from .ngrams import (BITS_PER_ENTRY, LEVELS, CountFilter, bigram_keys, fill_segment, followers_exponent, histogram, level, level_counts,
                     pack, pack_sorted, unpack, unpack_sorted)
from .shingles import WordHasher

CHUNK_TOKENS = 2_000_000
BLOCK_TOKENS = 100_000  # scored at once
SEGMENT_BYTES = 16_000_000
MAX_SEGMENTS = 4096
MAX_FILTER_BYTES = 2 ** 27
ALPHA = 0.1
END = b""


def words_of(text: bytes | None) -> list[bytes]:
    """ASCII rules of bytes: lower() is A-Z only, split() is 0x20, 0x09-0x0D."""
    return [*(text or b"").lower().split(), END]


def _by_segment(segment: np.ndarray, segments: int) -> np.ndarray:
    """Where each segment begins in a sorted array, and the end."""
    return np.searchsorted(segment, np.arange(segments + 1))


def _word_segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Segments are ranges of the hash, so sorted hashes are in their order."""
    return ((hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def code(docs: DataFrame, segments: int) -> DataFrame:
    """(doc_id, held_out, text) → rows of documents (chunk, doc_id, held_out,
    n, ids: places of the tokens in the chunk's sorted hashes) and of words
    (chunk, seg, hashes, counts: how often in training documents)."""
    fields = [("chunk", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n", pa.int64()),
              ("ids", pa.binary()), ("seg", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]
    schema = pa.schema(fields)

    def rows(**cols):
        n = len(next(iter(cols.values())))
        return pa.RecordBatch.from_arrays([pa.array(cols[k], t) if k in cols else pa.nulls(n, t) for k, t in fields], schema=schema)

    def flush(chunk, number, docs_):
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        train = [ids for _, held, ids in docs_ if not held]
        counts = np.bincount(np.concatenate([np.zeros(0, np.uint32), *train]), minlength=len(order))[order].astype(np.uint32)
        hashes = hashes[order]
        cuts = _by_segment(_word_segment(hashes, segments), segments)
        some = [s for s in range(segments) if cuts[s] < cuts[s + 1]]
        yield rows(chunk=[chunk] * len(some), seg=some, hashes=[pack_sorted(hashes[cuts[s]:cuts[s + 1]]) for s in some],
                   counts=[pack(counts[cuts[s]:cuts[s + 1]]) for s in some])
        for i in range(0, len(docs_), 2000):
            part = docs_[i:i + 2000]
            yield rows(chunk=[chunk] * len(part), doc_id=[d for d, _, _ in part], held_out=[h for _, h, _ in part],
                       n=[len(x) for _, _, x in part], ids=[pack(place[x]) for _, _, x in part])

    def run(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        number: dict[bytes, int] = {}
        held, size = [], 0
        for batch in batches:
            for doc_id, out, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                for w in [w for w in set(words) if w not in number]:
                    number[w] = len(number)
                held.append((doc_id, out, np.fromiter(map(number.__getitem__, words), np.uint32, len(words))))
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield from flush(chunk, number, held)
                    chunk, number, held, size = chunk + 1, {}, [], 0
        if held:
            yield from flush(chunk, number, held)

    return map_arrow(docs, run, "chunk long, doc_id long, held_out boolean, n long, ids binary, seg int, hashes binary, "
                                "counts binary")


def exact_counts(words: DataFrame) -> DataFrame:
    """(chunk, seg, hashes, counts) → the same with the counts of the whole
    training part, and on one row per segment how many distinct words with a
    count (``v``) and tokens (``t``) it has, by levels of the count."""
    def add_up(table: pa.Table) -> pa.Table:
        hashes = [unpack_sorted(x.as_py(), np.uint64) for x in table["hashes"]]
        counts = np.concatenate([unpack(x.as_py(), np.uint32) for x in table["counts"]])
        every, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(every)).astype(np.uint64)
        cuts = np.cumsum([0, *map(len, hashes)])
        answer = [pack(total[at[a:b]]) for a, b in zip(cuts, cuts[1:], strict=False)]
        none = [None] * (table.num_rows - 1)
        number, tokens = histogram(total)
        return pa.table({"chunk": table["chunk"], "seg": table["seg"], "hashes": table["hashes"],
                         "counts": pa.array(answer, pa.binary()),
                         "v": pa.array([number, *none], pa.list_(pa.int64())),
                         "t": pa.array([tokens, *none], pa.list_(pa.int64()))})

    find_package(words.sparkSession)
    return words.groupBy("seg").applyInArrow(add_up, "chunk long, seg int, hashes binary, counts binary, v array<long>, t array<long>")


def bigram_counts(train: DataFrame, segments: int) -> DataFrame:
    """(text) → (seg, keys, counts) of all bigrams, one row per segment, with
    how many they are, how many entries they make and the largest count."""
    def collect(batches):
        hasher = WordHasher()
        held, size = [], 0

        def flush():
            seg, key = (np.concatenate(x) for x in zip(*held, strict=True))
            both, n = np.unique(seg.astype(np.uint64) << np.uint64(32) | key, return_counts=True)
            cuts = _by_segment((both >> np.uint64(32)).astype(np.int64), segments)
            some = [s for s in range(segments) if cuts[s] < cuts[s + 1]]
            key, n = (both & np.uint64(0xFFFFFFFF)).astype(np.uint32), n.astype(np.uint32)
            return pa.RecordBatch.from_arrays([
                pa.array(some, pa.int32()), pa.array([pack_sorted(key[cuts[s]:cuts[s + 1]]) for s in some], pa.binary()),
                pa.array([pack(n[cuts[s]:cuts[s + 1]]) for s in some], pa.binary())], names=["seg", "keys", "counts"])

        for batch in batches:
            for text in batch.column(0):
                h = hasher.hashes([END, *words_of(text.as_py())])
                held.append(bigram_keys(h[:-1], h[1:], segments))
                size += len(h)
                if size >= CHUNK_TOKENS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def add_up(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_sorted(x.as_py(), np.uint32) for x in table["keys"]])
        counts = np.concatenate([unpack(x.as_py(), np.uint32) for x in table["counts"]])
        every, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(every)).astype(np.uint32)
        return pa.table({"seg": pa.array([table["seg"][0].as_py()], pa.int32()),
                         "keys": pa.array([pack_sorted(every)], pa.binary()), "counts": pa.array([pack(total)], pa.binary()),
                         "distinct": pa.array([len(every)], pa.int64()), "entries": pa.array([int(level(total).sum())], pa.int64()),
                         "top": pa.array([int(total.max(initial=1))], pa.int64())})

    coded = map_arrow(train.select(F.col("text").cast("binary")), collect, "seg int, keys binary, counts binary")
    return coded.groupBy("seg").applyInArrow(
        add_up, "seg int, keys binary, counts binary, distinct long, entries long, top long")


class Layout(NamedTuple):
    """Where a filter's segments lie.  A segment that outgrows a block is cut
    into ``parts`` by its keys; parts count as segments from then on."""
    segments: int
    parts: int
    words: int  # of a part
    per_block: int
    top: int

    @property
    def blocks(self) -> int:
        return -(-self.segments * self.parts // self.per_block)

    def places(self, segment, key: np.ndarray) -> np.ndarray:
        """Part and key in one number, in order of blocks."""
        key = key.astype(np.uint64)
        part = np.asarray(segment).astype(np.uint64) * np.uint64(self.parts) + (key * np.uint64(self.parts) >> np.uint64(32))
        return part << np.uint64(32) | key


def filter_layout(bigrams: DataFrame, segments: int, max_bytes: int = MAX_FILTER_BYTES) -> Layout:
    entries, top = bigrams.agg(F.sum("entries"), F.max("top")).first()

    def words(parts: int) -> int:
        return math.ceil(max(entries or 0, 1) * BITS_PER_ENTRY / 64 / (segments * parts) * 1.02) + 8

    parts = 1 if 8 * words(1) <= max_bytes else -(-words(1) // max(1, max_bytes // 8 - 9))
    return Layout(segments, parts, words(parts), max(1, max_bytes // 8 // words(parts)), int(level(np.array([top or 1]))[0]))


def build_filter(bigrams: DataFrame, layout: Layout, block: int) -> CountFilter:
    """One block of the filter, on the driver."""
    size, parts = layout.words, layout.parts
    lo = block * layout.per_block
    hi = min(lo + layout.per_block, layout.segments * parts)

    def fill(batches):
        for batch in batches:
            part, bits = [], []
            for s, k, c in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                keys, counts = unpack_sorted(k.as_py(), np.uint32), unpack(c.as_py(), np.uint32)
                own = layout.places(s, keys) >> np.uint64(32)
                for p in range(max(lo, s * parts), min(hi, (s + 1) * parts)):
                    part.append(p)
                    bits.append(fill_segment(p, keys[own == p], counts[own == p], size).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(bits, pa.binary())], names=["part", "bits"])

    own = bigrams.where(F.col("seg").between(lo // parts, (hi - 1) // parts)).select("seg", "keys", "counts")
    table = np.zeros(size * (hi - lo), np.uint64)
    for r in map_arrow(own, fill, "part int, bits binary").toLocalIterator():
        table[(r.part - lo) * size:(r.part - lo + 1) * size] = np.frombuffer(r.bits, np.uint64)
    return CountFilter(table, hi - lo, layout.top, lo)


def _word_counts(words: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of a chunk's words."""
    order = np.argsort(words["seg"].to_numpy())
    hashes = [unpack_sorted(words["hashes"][int(i)].as_py(), np.uint64) for i in order]
    counts = [unpack(words["counts"][int(i)].as_py(), np.uint64) for i in order]
    return tuple(np.concatenate([np.zeros(0, np.uint64), *x]) for x in (hashes, counts))


def _blocks_of(texts: pa.Table, at_end: int):
    """(ids, ids before them, where documents begin, their lengths) of many
    documents at once, side by side."""
    some, size = [], 0
    for i, raw in enumerate(texts["ids"], 1):
        some.append(unpack(raw.as_py(), np.uint32).astype(np.int64))
        size += len(some[-1])
        if size >= BLOCK_TOKENS or i == texts.num_rows:
            ids = np.concatenate(some)
            first = np.cumsum([0, *map(len, some)])[:-1]
            before = np.concatenate([[at_end], ids[:-1]])
            before[first] = at_end
            yield ids, before, first, list(map(len, some))
            some, size = [], 0


def _place_of_end(hashes: np.ndarray) -> int:
    return int(np.searchsorted(hashes, np.uint64(xxhash.xxh3_64_intdigest(END)))) if len(hashes) else 0


def _distinct_places(texts: pa.Table, hashes: np.ndarray, layout: Layout) -> np.ndarray:
    """The distinct bigrams of a chunk, in order of blocks."""
    every = [np.unique(layout.places(*bigram_keys(hashes[before], hashes[ids], layout.segments)))
             for ids, before, _, _ in _blocks_of(texts, _place_of_end(hashes))]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *every]))


def found_levels(texts: DataFrame, words: DataFrame, bigrams: DataFrame, layout: Layout) -> DataFrame:
    """(chunk, block, levels): the filter's levels of each chunk's distinct
    bigrams, by a pass for each block over the bigrams of that block."""
    spark = texts.sparkSession

    def ask(texts: pa.Table, words: pa.Table) -> pa.Table:
        every = _distinct_places(texts, _word_counts(words)[0], layout)
        block = (every >> np.uint64(32)).astype(np.int64) // layout.per_block
        cuts = np.searchsorted(block, np.arange(layout.blocks + 1))
        some = [b for b in range(layout.blocks) if cuts[b] < cuts[b + 1]]
        chunk = texts["chunk"][0].as_py() if texts.num_rows else None
        return pa.table({"chunk": pa.array([chunk] * len(some), pa.int64()), "block": pa.array(some, pa.int32()),
                         "places": pa.array([pack_sorted(every[cuts[b]:cuts[b + 1]]) for b in some], pa.binary())})

    find_package(spark)
    asked, found = (f"{checkpoint_root(spark)}/llm-{n}-{uuid.uuid4().hex}" for n in ("asked", "levels"))
    texts.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(
        ask, "chunk long, block int, places binary").write.partitionBy("block").parquet(asked)
    asks = spark.read.schema("chunk long, places binary, block int").parquet(asked)
    for block in range(layout.blocks):
        sent = spark.sparkContext.broadcast(build_filter(bigrams, layout, block))

        def answer(batches, sent=sent):
            for batch in batches:
                places = [unpack_sorted(x.as_py(), np.uint64) for x in batch.column(2)]
                levels = [sent.value.levels((x >> np.uint64(32)).astype(np.int64), (x & np.uint64(0xFFFFFFFF)).astype(np.uint32))
                          for x in places]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                    [x.astype(np.uint8).tobytes() for x in levels], pa.binary())], names=["chunk", "block", "levels"])

        own = asks.where(F.col("block") == block).select("chunk", "block", "places")
        map_arrow(own, answer, "chunk long, block int, levels binary").write.mode("append").parquet(found)
        sent.destroy()
    return spark.read.schema("chunk long, block int, levels binary").parquet(found)


def score(docs: DataFrame, folds: int = 10, held_out: int = 0, id_col: str = "doc_id",
          text_col: str = "text", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(F.col(id_col), folds) == held_out).alias("held_out"),
                      F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = min(MAX_SEGMENTS, max(16, -(-size // SEGMENT_BYTES)))
    coded = scratch_table(code(own, segments), "coded")
    counts = scratch_table(exact_counts(coded.where("seg is not null").select("chunk", "seg", "hashes", "counts")), "counts")
    levels = counts.where("v is not null").select(F.posexplode(F.arrays_zip("v", "t")).alias("q", "x")).where("x.v > 0")
    number, tokens = np.zeros((2, LEVELS), np.int64)
    for r in levels.groupBy("q").agg(F.sum("x.v").alias("v"), F.sum("x.t").alias("t")).collect():  # a row a level
        number[r.q], tokens[r.q] = r.v, r.t
    v, t = int(number.sum()), int(tokens.sum())
    bigrams = scratch_table(bigram_counts(own.where(~F.col("held_out")), segments), "bigrams")
    exponent = followers_exponent(number, tokens, bigrams.agg(F.sum("distinct")).first()[0] or 0)
    layout = filter_layout(bigrams, segments, max_filter_bytes)
    texts = coded.where("ids is not null").select("chunk", "doc_id", "held_out", "ids")
    words = counts.select("chunk", "seg", "hashes", "counts")
    if layout.blocks == 1:
        sent = docs.sparkSession.sparkContext.broadcast(build_filter(bigrams, layout, 0))
    else:
        sent, expected = None, level_counts(layout.top)
        levels = found_levels(texts, words, bigrams, layout)
        words = words.unionByName(levels, allowMissingColumns=True)
    norm = t + ALPHA * (v + 1)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def judge(texts: pa.Table, words: pa.Table) -> pa.Table:
        if sent is None:
            levels = words.filter(pc.is_valid(words["levels"])).sort_by("block")
            words = words.filter(pc.is_valid(words["seg"]))
        hashes, count = _word_counts(words)
        if sent is None:
            every = _distinct_places(texts, hashes, layout)
            found = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x.as_py(), np.uint8) for x in levels["levels"])])
        count = count.astype(np.float64)
        p = (count + ALPHA) / norm
        followers = np.where(count > 0, np.maximum(count, 1) ** exponent, 1.0)
        # a unigram's logarithm is taken from the count alone, as in the base's formula
        log_p, known = np.log10(p), count > 0
        out = []
        for ids, before, first, sizes in _blocks_of(texts, _place_of_end(hashes)):
            context = count[before]
            if sent is None:
                places = layout.places(*bigram_keys(hashes[before], hashes[ids], layout.segments))
                pair = expected[found[np.searchsorted(every, places)]]
            else:
                pair = sent.value.counts(hashes[before], hashes[ids])
            pair = np.minimum(pair, np.minimum(context, count[ids]))
            distinct = followers[before]
            smooth = (pair + distinct * p[ids]) / (context + distinct)
            add = [np.add.reduceat(x, first) for x in (known[ids].astype(np.int64), log_p[ids], np.log10(smooth))]
            out.extend(zip(sizes, *add, strict=True))

        n = texts.num_rows
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.table({"doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": pa.array(cols[0], pa.int64()),
                         "n_known": pa.array(cols[1], pa.int64()), "train_tokens": pa.array([t] * n, pa.int64()),
                         "base_score": pa.array(cols[2], pa.float64()), "score": pa.array(cols[3], pa.float64())})

    return texts.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(
        judge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    ).select(*names)
