"""Near-duplicate documents: fast similarity sketches, banding, exact check.

1. Per document (one pass over whole texts): the set of shingles, its sketch
   of 128 coordinates, 32 band keys of 4 coordinates, and a digest of the set.
   Documents with equal sets are one class, so groups of exact copies shrink
   to one node before anything is compared.
2. Classes that share a band meet in a star: each with the least class of the
   band, never all pairs.  Pairs whose sketches agree on fewer than
   ``MIN_AGREE`` coordinates are left out (128 coordinates of a pair at
   similarity 0.75 agree on 96 on average, standard deviation 4.9, so 72 is
   4.9 deviations below).
3. The others are confirmed on full sets, and components are formed.
4. A star can miss a link between two members that are both too far from its
   centre.  So in every band that still holds more than one component, the
   sketches of the members outside the centre's component are compared with
   those of all other components, in blocks of bounded size; likely partners
   are kept as a list for each such member, confirmed on full sets until one
   member of a component is linked, and components are formed once more.

A pair at similarity 0.75 shares no band with probability 5e-6.  Shingle sets
are not stored: those of classes that occur in a pair are computed again from
the texts, picked by a bounded Bloom filter on the ids.

Defined cases: null text counts as empty; a document without words has no
shingles, is linked with nothing and stands for itself; a null id comes after
all others, so a component's id is null only if none of its rows has one;
rows repeated with one id are one document each and get the same result; an
empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import fill, filter_words, probe
from .common import find_package, map_arrow, scratch_table, text_slices
from .components import components
from .shingles import WIDTH, WordHasher, band_keys, overlap, shingle_hashes, sketches

SIZE = 128
ROWS = 4
MIN_AGREE = 72
PERCENT = 75
BATCH_BYTES = 1_000_000
BLOCK = 1024  # members of a band that are compared with as many others at once
ROWS_A_CELL = 20_000
CELL = 1000  # nodes whose shingle sets one task holds for confirmation

def _set_digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def document_sketches(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tkey, n, cls, bands, sketch) per document; ``tkey`` is a hash
    of the text that tells rows with one id apart, ``cls`` the digest of the
    shingle set (null without words), ``sketch`` a byte per coordinate."""
    schema = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for a, texts in text_slices(batch.column(2), BATCH_BYTES):
                sets = shingle_hashes(hasher, [t or b"" for t in texts], width)
                full = sketches(sets, SIZE)
                keys, low = band_keys(full, ROWS), (full & np.uint64(255)).astype(np.uint8)
                some = [len(s) > 0 for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, len(texts)), batch.column(1).slice(a, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([k if ok else None for k, ok in zip(keys, some, strict=True)], pa.list_(pa.int64())),
                    pa.array([r.tobytes() if ok else None for r, ok in zip(low, some, strict=True)], pa.binary())],
                    schema=schema)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tkey"),
                      F.col(text_col).cast("binary").alias("text"))
    return map_arrow(own, run, "doc_id long, tkey long, n long, cls binary, bands array<long>, sketch binary")


def _shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(cls, shingles) of (doc_id, text) rows."""
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for _, texts in text_slices(batch.column(0), BATCH_BYTES):
                sets = shingle_hashes(hasher, [t or b"" for t in texts], width)
                yield pa.RecordBatch.from_arrays([pa.array([_set_digest(s) for s in sets], pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["cls", "shingles"])

    return map_arrow(docs.select(F.col("text").cast("binary")), run, "cls binary, shingles binary")


def _attach(pairs: DataFrame, table: DataFrame, side: str, value: str) -> DataFrame:
    """``pairs`` with ``value`` of the node in column ``side``: one join of two
    shuffled tables, so Spark splits the rows of a node that is in many pairs."""
    own = table.select(F.col("node").alias("_n"), F.col(value).alias(f"{value}_{side}"))
    return pairs.join(own, F.col(side) == F.col("_n")).drop("_n")


def _agreeing(pairs: DataFrame, classes: DataFrame, min_agree: int) -> DataFrame:
    """Pairs (a, b) whose sketches agree on at least ``min_agree`` places."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SIZE) for i in (2, 3))
            yield batch.filter(pa.array((a == b).sum(axis=1) >= min_agree)).select(["a", "b"])

    both = _attach(_attach(pairs, classes, "a", "sketch"), classes, "b", "sketch")
    return map_arrow(both, run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union on full sets."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                both = overlap(a, b)
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    both = _attach(_attach(pairs, sets, "a", "shingles"), sets, "b", "shingles")
    return map_arrow(both, run, "a long, b long")


def _sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the given nodes, computed from the texts of the
    documents that stand for them."""
    wanted = scratch_table(classes.join(nodes, "node", "left_semi").select("node", "cls", "id"), "wanted")
    words = filter_words(wanted.count())
    key = wanted.select(F.coalesce("id", F.lit(0).cast("long")).alias("key"))
    own = probe(docs.withColumn("key", F.coalesce("doc_id", F.lit(0).cast("long"))), fill(key, "key", words), "key", words)
    sets = _shingle_sets(own.where("_possible"), width)
    found = sets.join(wanted.select("node", "cls"), "cls").groupBy("node").agg(F.any_value("shingles").alias("shingles"))
    return scratch_table(found, "sets")


def _blocks(n: str, size: int):
    return F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(size))).cast("int")


def _candidates(members: DataFrame, min_agree: int) -> DataFrame:
    """Compares sketches inside the bands that are still open.

    ``members``: (band, no, n, main, node, centre, component, sketch, bands,
    cell).  Members outside the main component (x) meet all members but the centre
    (y) in blocks of at most BLOCK by BLOCK; a pair that shares several bands
    counts in the first one, told by the band keys themselves (a sketch has
    only a byte per coordinate, so it may agree where the keys differ).  Returns a row (cell, x, ys) for each x and cell
    with its likely partners there, best first, and a row (cell, null, ys) with
    all likely partners of a cell; no row for a pair."""
    spread = members.where("node <> centre").withColumn("_k", _blocks("n", BLOCK)).withColumn(
        "_own", F.pmod(F.xxhash64("node"), F.col("_k")).cast("int"))
    every = F.sequence(F.lit(0), F.col("_k") - 1)
    cols = ["band", "no", "node", "component", "main", "sketch", "bands", "cell"]
    xs = spread.where("component <> main").select(*cols, F.lit(True).alias("x"), F.col("_own").alias("xb"), F.explode(every).alias("yb"))
    ys = spread.select(*cols, F.lit(False).alias("x"), F.explode(every).alias("xb"), F.col("_own").alias("yb"))
    rows = scratch_table(xs.unionByName(ys), "cells")
    cells = max(1, rows.count() // ROWS_A_CELL)

    def compare(table: pa.Table) -> pa.Table:
        out: dict[tuple[int, int], dict[int, int]] = {}
        seen: dict[int, set[int]] = {}
        table = table.sort_by([("band", "ascending"), ("xb", "ascending"), ("yb", "ascending"), ("x", "descending")])
        band, no, xb, yb, node, comp, main, cell = (
            table[c].to_numpy() for c in ("band", "no", "xb", "yb", "node", "component", "main", "cell"))
        is_x = table["x"].to_numpy(zero_copy_only=False)
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SIZE)
        keys = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(band), -1)
        new = (np.diff(band, prepend=band[0] - 1) != 0) | (np.diff(xb, prepend=0) != 0) | (np.diff(yb, prepend=0) != 0)
        starts = [*np.flatnonzero(new).tolist(), len(band)]
        for a, b in zip(starts, starts[1:], strict=False):
            mid = a + int(is_x[a:b].sum())
            for i in range(a, mid):
                may = (comp[mid:b] != comp[i]) & ((comp[mid:b] == main[i]) | (node[mid:b] > node[i]))
                near = mid + np.flatnonzero(may)
                if len(near):
                    agree = (sketch[near] == sketch[i]).sum(axis=1)
                    near, agree = near[agree >= min_agree], agree[agree >= min_agree]
                    first = ~(keys[near, :no[i]] == keys[i, :no[i]]).any(axis=1)  # not met in an earlier band
                    for j, n in zip(near[first].tolist(), agree[first].tolist(), strict=True):
                        out.setdefault((int(cell[j]), int(node[i])), {})[int(node[j])] = n
                        seen.setdefault(int(cell[j]), set()).add(int(node[j]))
        lists = [sorted(v, key=lambda y: (-v[y], y)) for v in out.values()]
        return pa.table({"cell": pa.array([*(c for c, _ in out), *seen], pa.int64()),
                         "node": pa.array([*(x for _, x in out), *([None] * len(seen))], pa.int64()),
                         "ys": pa.array([*lists, *map(sorted, seen.values())], pa.list_(pa.int64()))})

    find_package(rows.sparkSession)
    return rows.groupBy(F.pmod(F.xxhash64("band", "xb", "yb"), F.lit(cells)).alias("_g")).applyInArrow(
        compare, "cell long, node long, ys array<long>")


def _partners(found: DataFrame) -> DataFrame:
    """(cell, node) of the likely partners of all cells."""
    lists = found.where("node is null").groupBy("cell").agg(F.array_distinct(F.flatten(F.collect_list("ys"))).alias("ys"))
    return lists.select("cell", F.explode("ys").alias("node"))


def _first_links(found: DataFrame, components_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): for each x and cell, the first confirmed partner of each
    component among its likely partners.  Cells hold at most about CELL
    partners; the x of a cell come in blocks, too."""
    asks = found.where("node is not null").groupBy("cell", "node").agg(F.array_distinct(F.flatten(F.collect_list("ys"))).alias("ys"))
    given = _partners(found)
    blocks = asks.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).select("cell", _blocks("n", BLOCK).alias("_k"))
    own = sets.select(F.col("node").alias("_n"), "shingles")
    asks = asks.join(blocks, "cell").join(own, F.col("node") == F.col("_n")).select(
        "cell", F.pmod(F.xxhash64("node"), F.col("_k")).cast("int").alias("b"), "node", "ys", "shingles")
    named = components_.select(F.col("node").alias("_m"), "component")
    given = (given.join(blocks, "cell").join(own, F.col("node") == F.col("_n")).join(named, F.col("node") == F.col("_m"), "left")
             .select("cell", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("b"), "node",
                     F.coalesce("component", "node").alias("component"), "shingles"))

    def confirm(x: pa.Table, y: pa.Table) -> pa.Table:
        at = {n: i for i, n in enumerate(y["node"].to_pylist())}
        comp = y["component"].to_pylist()
        held = [np.frombuffer(s.as_py(), np.uint64) for s in y["shingles"]]
        u, v = [], []
        for node, ys, raw in zip(x["node"].to_pylist(), x["ys"].to_pylist(), x["shingles"], strict=True):
            own, linked = np.frombuffer(raw.as_py(), np.uint64), set()
            for other in ys:
                i = at[other]
                if comp[i] in linked:
                    continue
                both = overlap(own, held[i])
                if 100 * both >= percent * (len(own) + len(held[i]) - both):
                    linked.add(comp[i])
                    u.append(node)
                    v.append(other)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    find_package(sets.sparkSession)
    asks, given = scratch_table(asks, "asks"), scratch_table(given, "given")
    return asks.groupBy("cell", "b").cogroup(given.groupBy("cell", "b")).applyInArrow(confirm, "u long, v long")


def link_classes(classes: DataFrame, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(node, component) of the classes that are linked with another one."""
    min_agree = MIN_AGREE if percent == PERCENT else max(1, int(SIZE * percent / 100 - 24))
    bands = scratch_table(classes.select("node", F.posexplode("bands").alias("no", "band")), "bands")
    buckets = scratch_table(bands.groupBy("band").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
                            .where("n > 1"), "buckets")
    met = bands.join(buckets.select(F.col("band").alias("_band"), "centre", "n"), F.col("band") == F.col("_band"))
    members = scratch_table(met.select("band", "no", "node", "centre", "n"), "members")
    stars = members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    likely = scratch_table(_agreeing(scratch_table(stars, "stars"), classes, min_agree), "likely")
    nodes = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _sets_of(nodes, classes, docs, width)
    links = scratch_table(_confirmed(likely, sets, percent).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    first = scratch_table(components(links), "components")

    # bands that still hold several components
    named = first.select(F.col("node").alias("_node"), "component")
    placed = scratch_table(members.join(named, F.col("node") == F.col("_node"), "left").select(
        "band", "no", "node", "centre", "n", F.coalesce("component", "node").alias("component")), "placed")
    open_ = placed.groupBy("band").agg(F.min_by("component", "node").alias("main"), F.min("component").alias("lo"),
                                       F.max("component").alias("hi")).where("lo < hi").select(F.col("band").alias("_band"), "main")
    open_ = scratch_table(open_, "open")
    if open_.isEmpty():
        return first
    placed = scratch_table(placed.join(open_, F.col("band") == F.col("_band")).drop("_band"), "placed-open")
    # nodes that are compared with the same component share cells
    family = scratch_table(placed.groupBy("node").agg(F.min("main").alias("family")), "families")
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select(F.col("family").alias("_f"), _blocks("size", CELL).alias("_k"))
    cells = max(1, family.count() // CELL)
    cell = F.pmod(F.xxhash64("family", F.pmod(F.xxhash64("node"), F.col("_k"))), F.lit(cells))
    own = (family.join(sizes, F.col("family") == F.col("_f")).join(classes.select(F.col("node").alias("_n"), "sketch", "bands"), F.col("node") == F.col("_n"))
           .select(F.col("node").alias("_node"), "sketch", "bands", cell.alias("cell")))
    placed = placed.join(own, F.col("node") == F.col("_node"))
    found = scratch_table(_candidates(placed.select("band", "no", "n", "main", "node", "centre", "component", "sketch", "bands",
                                                    "cell"), min_agree), "found")
    nodes = found.where("node is not null").select("node").union(_partners(found).select("node")).distinct()
    more = _first_links(found, first, _sets_of(nodes, classes, docs, width), percent)
    return components(links.unionByName(scratch_table(more, "more-links")))


def near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, tkey, n_shingles, component_id, kept,
    and ``rank`` of the row that stands for its component."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = scratch_table(document_sketches(own, width), "documents")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("tkey").alias("tkey"))
    grouped = rows.where("cls is not null").groupBy("cls").agg(
        F.min(rank).alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands"),
        F.any_value("sketch").alias("sketch"))
    classes = scratch_table(grouped.select(F.monotonically_increasing_id().alias("node"), "cls", "first",
                                           F.col("first.id").alias("id"), "copies", "bands", "sketch"), "classes")
    linked = scratch_table(link_classes(classes, own, width, percent), "linked")

    # the row that stands for each component, then down to classes and rows
    small = classes.select("node", "cls", "first", "copies").join(
        linked.select(F.col("node").alias("_node"), "component"), F.col("node") == F.col("_node"), "left").select(
        "cls", "first", "copies", F.coalesce("component", "node").alias("component"))
    small = scratch_table(small, "classes-in")
    heads = scratch_table(small.groupBy(F.col("component").alias("_c")).agg(F.min("first").alias("head"), F.sum("copies").alias("rows")), "heads")
    named = small.join(heads, F.col("component") == F.col("_c")).select(
        F.col("cls").alias("_cls"), F.struct("head", "rows").alias("found"))
    out = rows.join(scratch_table(named, "named"), F.col("cls") == F.col("_cls"), "left")
    alone = F.col("found").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("found.head.id"))
    return out.select("doc_id", "tkey", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"),
                      F.coalesce(F.col("found.rows"), F.lit(1).cast("long")).alias("component_rows"),
                      (alone | (F.col("tkey").eqNullSafe(F.col("found.head.tkey")) & F.col("doc_id").eqNullSafe(component)))
                      .alias("stands"))


def drop_near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all columns kept.  Rows of
    components of one row, told by a Bloom filter, never shuffle."""
    labels = near_copies(docs, width, percent, id_col, text_col).where("component_rows > 1")
    key = F.struct(F.col("doc_id").alias("id"), F.col("tkey").alias("tkey"))
    decided = scratch_table(labels.groupBy(key.alias("_key")).agg(F.bool_or("stands").alias("_stays")), "decided")
    words = filter_words(decided.count())
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.struct(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tkey")).alias("key"))
    packed = probe(packed, scratch_table(fill(decided, "_key", words), "decided-ids"), "key", words)
    asked = scratch_table(packed.where("_possible").join(decided, F.col("key").eqNullSafe(F.col("_key")), "left").select(
        "row", "key", "_key", "_stays"), "asked")
    once = asked.where("_stays").groupBy("key").agg(F.any_value("row").alias("row"))
    free = packed.where(~F.col("_possible")).select("row.*")
    return free.unionByName(asked.where("_key is null").select("row.*")).unionByName(once.select("row.*"))
