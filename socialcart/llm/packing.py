"""Mixture-controlled packing of documents into token windows.

Each source is a queue of documents.  Every window of ``capacity`` tokens
takes from all queues in the target proportions (by default each source's
share of all tokens, so all queues end together), by deficit round-robin
whose credits carry over windows and partitions (see ``mixture``).  Documents
are cut where a window's share ends; only the last window is not full.

1. Tokenise once: ids, lengths and each document's place in its partition's
   part of its queue, as a stored table.
2. Per (partition, source) totals give each part's place in the queue; they
   are the only thing summed up, a row for each partition and source.
3. Each document's pieces follow from its place and the schedule, row by row;
   no document meets another in a group.

Sources: the ``max_queues`` - 1 with most tokens have a queue of their own,
the others share one, so what the driver holds is bounded; a null source is
the empty name.  Defined cases: null text is empty and gives the end id
alone; a null id stays null; repeated rows are packed each; an empty table
gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from socialcart.operators.joins import bounded_broadcast

from .common import map_arrow, scratch_table
from .mixture import Schedule, phases
from .tokens import encoder, public_path

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 2
MAX_QUEUES = 256
BATCH_BYTES = 1_000_000


def _slice_of(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
    """Rows from ``at`` on whose texts hold about BATCH_BYTES, at least one."""
    held = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1).slice(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    return batch.slice(at, int(np.searchsorted(held, BATCH_BYTES)) + 1)


def tokenise(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(pid, source, start, n, doc_id, ids): ``start`` counts the tokens of
    the same source before the document in its partition."""
    schema = pa.schema([("pid", pa.int32()), ("source", pa.string()), ("start", pa.int64()), ("n", pa.int64()),
                        ("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        enc = encoder(tokenizer or public_path(TOKENIZER))
        pid, so_far = TaskContext.get().partitionId(), {}
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                some = _slice_of(batch, at)
                ids, ends = enc.encode_array(some.column(1))
                ids = np.insert(ids, ends, enc.dtype.type(end_id))
                ends = ends + np.arange(1, len(ends) + 1)
                sources = [s or "" for s in some.column(2).to_pylist()]
                lengths, starts = np.diff(ends, prepend=0).tolist(), []
                for source, n in zip(sources, lengths, strict=True):
                    starts.append(so_far.get(source, 0))
                    so_far[source] = starts[-1] + n
                offsets = np.concatenate([[0], ends * enc.dtype.itemsize]).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([pid] * len(ends), pa.int32()), pa.array(sources, pa.string()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), some.column(0), raw], schema=schema)
                at += some.num_rows

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.col(source_col).cast("string").alias("source"))
    return map_arrow(own, run, "pid int, source string, start long, n long, doc_id long, ids binary", encodes=True)


def _queues(parts: DataFrame, max_queues: int) -> tuple[list[str], list[int], int]:
    """Names and tokens of the queues, by name; the tokens of all other
    sources come last, as the queue with the empty rank."""
    by_source = parts.groupBy("source").agg(F.sum("n").alias("n"))
    largest = by_source.orderBy(F.desc("n"), "source").limit(max_queues - 1).collect()
    every = by_source.agg(F.sum("n")).first()[0] or 0
    own = sorted((r.source, r.n) for r in largest)
    return [s for s, _ in own], [n for _, n in own], every - sum(n for _, n in own)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         mixture: dict[str, float] | None = None, max_queues: int = MAX_QUEUES, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32 (of unsigned
    little-endian 32-bit ids), doc_tokens, sequence_id, offset, source, and
    the ids themselves on request.  ``mixture`` maps sources to weights;
    sources that it lacks have weight 0 and come once the others are dry."""
    tokens = scratch_table(tokenise(docs, tokenizer, end_id, id_col, text_col, source_col), "tokens")
    parts = scratch_table(tokens.groupBy("pid", "source").agg(F.sum("n").alias("n")), "parts")
    names, totals, others = _queues(parts, max_queues)
    rank = {s: i for i, s in enumerate(names)}
    weights = None
    if mixture is not None:
        weights = [round(mixture.get(s, 0) * 1_000_000) for s in names] + [0]
    plan = phases([*totals, others], weights, capacity)

    # a part's queue and its place there: parts in order of partition, then source
    # an Arrow table: rows of a list would start further Python workers, which stay for a minute
    known = parts.sparkSession.createDataFrame(pa.table({"name": pa.array(list(rank) or [""], pa.string()),
                                                         "queue": pa.array(list(rank.values()) or [0], pa.int32())}))
    place = Window.partitionBy("queue").orderBy("pid", "source").rowsBetween(Window.unboundedPreceding, -1)
    parts = (parts.join(F.broadcast(known), F.col("source") == F.col("name"), "left")
             .withColumn("queue", F.coalesce("queue", F.lit(len(names))))
             .withColumn("base", F.coalesce(F.sum("n").over(place), F.lit(0)))
             .select(F.col("pid").alias("_pid"), F.col("source").alias("_source"), "queue", "base"))
    placed = tokens.join(bounded_broadcast(parts), (F.col("pid") == F.col("_pid")) & (F.col("source") == F.col("_source")))

    wide = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("source", pa.string())]
    wide += [("ids", pa.list_(pa.int32()))] if with_ids else []
    schema = pa.schema(wide)

    def cut(batches):
        schedule = Schedule(plan, capacity)
        for batch in batches:
            out = []
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for doc_id, source, queue, first, n, coded in rows:
                ids = np.frombuffer(coded, f"<u{len(coded) // n}").astype("<u4")
                raw = memoryview(ids.tobytes())
                for a, b, window, offset in schedule.pieces(queue, first, first + n):
                    a, b = a - first, b - first
                    row = (doc_id, a, b - a, zlib.crc32(raw[4 * a:4 * b]), n, window, offset, source)
                    out.append((*row, ids[a:b].astype(np.int32)) if with_ids else row)
            if out:
                cols = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    ddl = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
           "source string" + (", ids array<int>" if with_ids else ""))
    own = placed.select("doc_id", "source", "queue", (F.col("base") + F.col("start")).alias("first"), "n", "ids")
    return map_arrow(own, cut, ddl)


def sequences(pieces: DataFrame) -> DataFrame:
    """Whole sequences from ``pack(..., with_ids=True)``: sequence_id, its
    ids in order, and the pieces they come from.  A group is one window, so
    its size is bounded by the capacity."""
    own = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "start", "source", "ids")))
    return pieces.groupBy("sequence_id").agg(own.alias("p")).select(
        "sequence_id", F.flatten(F.col("p.ids")).alias("input_ids"),
        F.transform("p", lambda x: x.dropFields("ids")).alias("pieces"))
