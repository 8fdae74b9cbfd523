"""Merkle manifest of a data set, by time-forward processing.

Leaves are digests of rows.  Per source they are ordered by id and folded in
runs of three until one digest, the subroot, is left; the subroots, ordered by
source, are folded likewise into the root (``tree_shape``).

Upward: nodes are settled in the order of their labels, in which a node comes
after all below it.  A settled node sends its digest to its parent's label
through a priority queue.  The queue is external: a task sweeps a range of
labels with a heap that holds what is still due inside the range (a few
messages a level), and what is due later, or misses a digest that another
task holds, is written to the queue table.  The next round sorts that table by
label, deals it by range and sweeps again.  A round leaves a few messages a
level and task, so two or three rounds settle any number of leaves.

Downward: the rounds are swept in reverse, labels descending.  A node hands
each child the child's siblings in front of its own proof, through a heap
inside the task and through a table to nodes of earlier rounds.  Leaves thus
get their whole proof.

No group is collected: a source with a third of all rows is a range of labels
like any other.  A task holds the heap and one proof a level.  Rows move three
times (order, upward, downward) as ids and digests, never as texts.  Each
round is written below ``spark.checkpoint.dir``.

Defined cases: null fields count as "-"; a null source is a source of its own
and comes first; null ids come first in their source; rows repeated with one
id are leaves of their own, ordered by digest (equal leaves in any order: they
are the same); a single leaf is its source's subroot, a single subroot the
root; an empty table has no root and gives an empty table; other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import tree_shape as shape
from .common import join_by_key, map_arrow, scratch_table

#: Rows that a task sweeps.
LEAVES_PER_TASK = 200_000
#: Messages that one task settles in the last round.
LAST_ROUND = 20_000
BATCH = 5_000

LEAF, NODE, MESSAGE = 0, 1, 2
_CHILD = "struct<digest:string,a:long,b:long,c:int,round:int,task:int>"
_CHILD_ARROW = pa.struct([("digest", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int32()),
                          ("round", pa.int32()), ("task", pa.int32())])
# a, b, c: the label of a settled node, or where a message is due; top ... n: the spec
# of that node; digest: of the node, or what the message carries; sender: of a message
SWEPT = ("kind int, task int, a long, b long, c int, top int, source long, level int, index long, n long, "
         f"digest string, slot int, sender {_CHILD}, children array<{_CHILD}>")
_SWEPT_ARROW = pa.schema([("kind", pa.int32()), ("task", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int32()),
                          ("top", pa.int32()), ("source", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("n", pa.int64()),
                          ("digest", pa.string()), ("slot", pa.int32()), ("sender", _CHILD_ARROW),
                          ("children", pa.list_(_CHILD_ARROW))])
# what a node of round ``round`` and task ``task`` gets from above: its subroot, and per
# level up to the root the siblings before and after it
PROOF = "id string, leaf string, present string, subroot string, before array<string>, after array<string>"
HANDED = "round int, task int, a long, b long, c int, subroot string, before array<string>, after array<string>"


def field(value: Column) -> Column:
    """"-" for null, else the byte length of the value's text, ":" and the text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the fields one after the other, as lower-case hex."""
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def fold(digest: str) -> str:
    return hashlib.sha256(digest.encode()).hexdigest()


def _batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield from batch.slice(at, BATCH).to_pylist()


def in_order(df: DataFrame, order: list[str], name: str, partitions: int) -> DataFrame:
    """``df``, stored, with its dense position ``place`` from 0 in ``order``
    (nulls first).  Range partitions are counted, so only one row a partition
    meets in one place."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    rows = scratch_table(df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
                         .withColumn("_mid", F.monotonically_increasing_id()), name)
    part, inside = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit(2 ** 33 - 1))
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_earlier"))
    return (rows.join(F.broadcast(earlier), part == F.col("_part"))
            .withColumn("place", F.col("_earlier") + inside).drop("_mid", "_part", "_earlier"))


def _up(rows: Iterator[dict], round_: int, sources: int) -> Iterator[dict]:
    """Settle what can be settled from rows in label order: leaves (round 0)
    or the messages of the rounds before."""
    queue: list[tuple] = []  # (due, slot, digest, sender, spec of the node it is due at)
    task = 0

    def send(spec: shape.Spec, digest: str) -> None:
        above = shape.parent(spec, sources)
        if above is not None:
            sender = (digest, *shape.label(spec), round_, task)
            heapq.heappush(queue, (shape.label(above), shape.slot(spec), sender, above))

    def settle(limit: shape.Label | None) -> Iterator[dict]:
        while queue and (limit is None or queue[0][0] < limit):
            due = queue[0][0]
            got = [heapq.heappop(queue)]
            while queue and queue[0][0] == due:
                got.append(heapq.heappop(queue))
            spec = got[0][3]
            own = dict(zip("abc", due)) | dict(zip(("top", "source", "level", "index", "n"), spec)) | {"task": task}
            if len(got) == shape.children(spec):
                digest = fold("".join(g[2][0] for g in got))
                yield own | {"kind": NODE, "digest": digest, "children": [_child(g[2]) for g in got]}
                send(spec, digest)
            else:
                for _, at, sender, _ in got:
                    yield own | {"kind": MESSAGE, "slot": at, "sender": _child(sender)}

    for r in rows:
        here = (r["a"], r["b"], r["c"])
        # a task ends its sweep; what it has not settled is left to the next round
        yield from settle(here if r["task"] == task else None)
        task = r["task"]
        if round_ == 0:
            send((0, r["a"], 0, r["b"], r["n"]), r["digest"])
        else:
            s = r["sender"]
            sender = (s["digest"], s["a"], s["b"], s["c"], s["round"], s["task"])
            heapq.heappush(queue, (here, r["slot"], sender, (r["top"], r["source"], r["level"], r["index"], r["n"])))
    yield from settle(None)


def _child(sender: tuple) -> dict:
    return dict(zip(("digest", "a", "b", "c", "round", "task"), sender))


def _down(rows: Iterator[dict], round_: int, sources: int) -> Iterator[tuple[bool, dict]]:
    """From rows of a task in reversed label order, what its nodes hand to
    nodes elsewhere (False, row) and the proofs of its leaves (True, row)."""
    queue: list[tuple] = []  # (label reversed, subroot, before, after) due in this task
    task = None
    handed = None
    for r in rows:
        if r["task"] != task:
            task, queue, handed = r["task"], [], None
        here = (r["a"], r["b"], r["c"])
        if r["kind"] == MESSAGE:
            handed = (r["subroot"], r["before"], r["after"])  # comes right before its node
            continue
        spec = (r["top"], r["source"], r["level"], r["index"], r["n"])
        if shape.parent(spec, sources) is None:
            got = (None if r["top"] else r["digest"], [], [])
        elif queue and queue[0][0] == tuple(-x for x in here):
            got = heapq.heappop(queue)[1:]
        else:
            got, handed = handed, None
        subroot, before, after = got
        if r["kind"] == LEAF:
            yield True, {"id": r["id"], "leaf": r["digest"], "present": r["present"], "subroot": subroot,
                         "before": before, "after": after}
            continue
        digests = [c["digest"] for c in r["children"]]
        for i, c in enumerate(r["children"]):
            gets = (c["digest"] if r["top"] and r["level"] == 1 else subroot,
                    ["".join(digests[:i]), *before], ["".join(digests[i + 1:]), *after])
            if (c["round"], c["task"]) == (round_, task):
                heapq.heappush(queue, ((-c["a"], -c["b"], -c["c"]), *gets))
            else:
                yield False, {k: c[k] for k in ("round", "task", "a", "b", "c")} | dict(zip(("subroot", "before", "after"), gets))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, kinds[t]) for n, t in (c.split(" ") for c in schema.split(", "))])


class Manifest:
    """A settled tree: ``root`` (None if there are no rows) and, per round,
    the stored ``nodes`` with the digests and homes of their children."""

    def __init__(self, leaves: DataFrame, rounds: list[DataFrame], tasks: list[int], sources: int, root: str | None):
        self.leaves, self.rounds, self.tasks, self.sources, self.root = leaves, rounds, tasks, sources, root

    @property
    def nodes(self) -> DataFrame:
        """All inner nodes: tree, level and index, digest and child digests."""
        out = None
        for table in self.rounds:
            own = table.where(F.col("kind") == NODE).select(
                (F.col("top") == 1).alias("top"), "source", "level", "index", "digest",
                F.col("children.digest").alias("children"))
            out = own if out is None else out.unionByName(own)
        return out

    def proofs(self) -> DataFrame:
        """Per leaf: ``id`` (as text), ``leaf``, ``present``, ``subroot`` and,
        level by level up to the root, the digests of the siblings ``before``
        and ``after`` it."""
        sources, handed, out = self.sources, None, None
        for round_ in range(len(self.rounds) - 1, -1, -1):
            rows = self.rounds[round_].where(F.col("kind") == NODE).select(
                "kind", "task", "a", "b", "c", "top", "source", "level", "index", "n", "digest", "children")
            if round_ == 0:
                rows = rows.unionByName(self.leaves.withColumn("kind", F.lit(LEAF)), allowMissingColumns=True)
            if handed is not None:
                due = handed.where(F.col("round") == round_).drop("round").withColumn("kind", F.lit(MESSAGE))
                rows = rows.unionByName(due, allowMissingColumns=True)
            labels = [F.col(c).desc() for c in "abc"]
            rows = _deal(rows, [F.col("task")], [F.col("task"), *labels, F.col("kind").desc()], self.tasks[round_])
            schema = PROOF if round_ == 0 else HANDED

            def sweep(batches, round_=round_, schema=_arrow(schema)):
                # round 0 hands nothing on, later rounds have no leaves
                return _batches((r for leaf, r in _down(_rows(batches), round_, sources) if leaf == (round_ == 0)), schema)

            out = map_arrow(rows, sweep, schema)
            if round_:
                out = scratch_table(out, f"handed-{round_}")
                handed = out if handed is None else handed.unionByName(out)
        return out


def _deal(rows: DataFrame, by: list[Column], order: list[Column], partitions: int) -> DataFrame:
    """``rows`` in ranges of ``by``, sorted inside."""
    dealt = rows.coalesce(1) if partitions <= 1 else rows.repartitionByRange(partitions, *by)
    return dealt.sortWithinPartitions(*order)


def build(leaves: DataFrame, leaves_per_task: int = LEAVES_PER_TASK, last_round: int = LAST_ROUND) -> Manifest:
    """The manifest of a stored table of leaves: ``source`` (text), ``id``,
    ``leaf`` (digest) and ``present`` (text that the proofs carry along)."""
    total = leaves.count()
    tasks = max(int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // leaves_per_task))
    size = max(1, -(-total // tasks))
    key = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("source")))
    rows = leaves.select("source", F.col("id").alias("_id"), F.col("leaf").alias("digest"), "present", key.alias("key"),
                         F.monotonically_increasing_id().alias("rid"))
    # the row number comes last, so that equal rows, however many, are ranges like others
    rows = in_order(rows, ["source", "_id", "digest", "rid"], "leaves", tasks)
    groups = scratch_table(rows.groupBy("key").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n")), "sources")
    sources = groups.count()
    groups = in_order(groups, ["start"], "source-order", max(1, -(-sources // leaves_per_task)))
    rows = join_by_key(rows.drop("source", "rid"), groups.select("key", "start", "n", F.col("place").alias("rank")),
                       "key", "n", total)
    rank, place = F.col("found.rank"), F.col("place") - F.col("found.start")
    ranked = scratch_table(rows.select(
        F.col("_id").cast("string").alias("id"), "present", "digest", "place", rank.alias("a"), place.alias("b"), F.lit(0).alias("c"),
        F.floor(F.col("place") / F.lit(size)).cast("int").alias("task"), F.lit(0).alias("top"), rank.alias("source"),
        F.lit(0).alias("level"), place.alias("index"), F.col("found.n").alias("n")), "ranked")

    due, parts = _deal(ranked, [F.col("place")], [F.col("place")], tasks), tasks
    rounds: list[DataFrame] = []
    dealt: list[int] = []
    while not rounds or parts:
        def sweep(batches, round_=len(rounds)):
            return _batches(_up(_rows(batches), round_, sources), _SWEPT_ARROW)

        rounds.append(scratch_table(map_arrow(due, sweep, SWEPT), f"round-{len(rounds)}"))
        dealt.append(parts)
        left = rounds[-1].where(F.col("kind") == MESSAGE).drop("task", "kind", "children", "digest")
        count = left.count()
        parts = 0 if not count else 1 if count <= last_round else -(-count // last_round)
        labels = [F.col(c) for c in "abc"]
        due = _deal(left, labels, labels, parts).withColumn("task", F.spark_partition_id())
    return Manifest(ranked.drop("place"), rounds, dealt, sources, _root(ranked, rounds, sources, total))


def _root(leaves: DataFrame, rounds: list[DataFrame], sources: int, total: int) -> str | None:
    if total < 2:
        return next((r["digest"] for r in leaves.select("digest").collect()), None)
    whole = (F.col("kind") == NODE) & (F.pow(F.lit(float(shape.ARITY)), F.col("level")) >= F.col("n"))
    if sources > 1:
        whole &= F.col("top") == 1
    return rounds[-1].where(whole).select("digest").first()["digest"]


def folded(leaf: Column) -> Column:
    """The root that ``leaf`` leads to along its proof (``before``, ``after``)."""
    levels = F.arrays_zip("before", "after")
    return F.aggregate(levels, leaf, lambda own, s: F.sha2(F.concat(s["before"], own, s["after"]).cast("binary"), 256))


def proof_digest() -> Column:
    """SHA-256 of all siblings of a proof, level by level, left to right."""
    levels = F.transform(F.arrays_zip("before", "after"), lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.array_join(levels, "").cast("binary"), 256)


def verify(docs: DataFrame, original: Column, present: Column, id_col: str = "doc_id", source_col: str = "source",
           **sizes: int) -> DataFrame:
    """Build the manifest of the ``original`` leaf digests of ``docs`` and
    check each row's ``present`` digest against it: id, ``leaf``, ``subroot``,
    ``root``, ``proof_sha256``, ``folded_root`` (from the present digest) and
    ``verified``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       original.alias("leaf"), present.alias("present"))
    manifest = build(scratch_table(rows, "digests"), **sizes)
    root = F.lit(manifest.root).cast("string")
    out = manifest.proofs().withColumn("folded_root", folded(F.col("present")))
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "leaf", "subroot", root.alias("root"),
                      proof_digest().alias("proof_sha256"), "folded_root", (F.col("folded_root") == root).alias("verified"))
