import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from socialcart.llm import oracle, queries, tree_shape
from socialcart.llm.common import scratch_table
from socialcart.llm.merkle import build, leaf_digest, verify
from tests.conftest import SF_SMALL

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fields(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree(digests):
    """The root over ``digests`` and the (before, after) siblings of each."""
    paths, members = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        up, above = [], []
        for k in range(0, len(digests), 3):
            run = digests[k:k + 3]
            for i in range(len(run)):
                for m in members[k + i]:
                    paths[m].append(("".join(run[:i]), "".join(run[i + 1:])))
            up.append(sha("".join(run)))
            above.append([m for x in members[k:k + 3] for m in x])
        digests, members = up, above
    return digests[0], paths


def want(rows, tampered):
    by = defaultdict(list)
    for r in rows:
        text = r[4].replace("\n", "") if tampered(r) and r[4] is not None else r[4]
        by[r[1]].append((r[0] is not None, r[0] or 0, sha(fields(r)), sha(fields((*r[:4], text))), r[0]))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s])]) for s in sources}
    root, tops = tree([trees[s][0] for s in sources])
    for s, top in zip(sources, tops):
        for x, path in zip(sorted(by[s]), trees[s][1]):
            own = x[3]
            for before, after in path + top:
                own = sha(before + own + after)
            yield (x[4], x[2], trees[s][0], root, sha("".join(a + b for a, b in path + top)), own, own == root)


def even(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0


def check(docs, **sizes):
    leaf = leaf_digest(*[F.col(c) for c in FIELDS])
    changed = leaf_digest(*[F.col(c) for c in FIELDS[:-1]], F.replace("text", F.lit("\n"), F.lit("")))
    even_id = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = verify(docs, leaf, F.when(even_id, changed).otherwise(leaf), **sizes).collect()
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want(rows, even), key=str)
    return got


@pytest.mark.parametrize("sizes", [{}, {"leaves_per_task": 9, "last_round": 6}])
def test_equals_brute_force(spark, sizes):
    pick = random.Random(3)
    rows = [(i, pick.choice(["é", "z", "a b", None, "big", "big"]) if i < 130 else f"only {i}", pick.choice(["en", None]), i,
             f"line {i}\nnext" if i % 3 else f"line {i}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    got = check(docs, **sizes)
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 10])
def test_small_trees(spark, n):
    docs = spark.createDataFrame([(i, "s", "en", 1, "x\ny") for i in range(n)],
                                 "doc_id long, source string, lang string, n_chars long, text string")
    check(docs)
    check(docs.withColumn("source", F.concat("source", F.col("doc_id").cast("string"))), leaves_per_task=2, last_round=1)


def test_manifest_nodes_are_kept(spark):
    rows = scratch_table(spark.range(20).select(F.lit("s").alias("source"), F.col("id"), F.sha2(F.col("id").cast("string").cast("binary"), 256)
                                                .alias("leaf"), F.lit(None).cast("string").alias("present")), "test")
    manifest = build(rows, leaves_per_task=5, last_round=3)
    nodes = manifest.nodes.collect()
    assert sorted((r.level, r["index"]) for r in nodes) == [(1, i) for i in range(7)] + [(2, i) for i in range(3)] + [(3, 0)]
    assert all(r.digest == sha("".join(r.children)) for r in nodes)
    assert manifest.root == next(r.digest for r in nodes if r.level == 3) and len(manifest.rounds) > 1


def test_labels_follow_children():
    sources = 5
    for n in range(1, 40):
        spec = (0, 2, 0, n - 1, n)
        while (above := tree_shape.parent(spec, sources)) is not None:
            assert tree_shape.label(above) > tree_shape.label(spec)
            assert tree_shape.slot(spec) < tree_shape.children(above) if spec[0] == above[0] else True
            spec = above
        assert spec[0] == 1 and spec[2] == 2


def test_odd_documents(odd_documents):
    check(odd_documents)
    check(odd_documents, leaves_per_task=2, last_round=2)


def test_empty_table(no_documents):
    leaf = leaf_digest(*[F.col(c) for c in FIELDS])
    assert verify(no_documents, leaf, leaf).count() == 0


def test_query_matches_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    result = con.execute(oracle.oracle()["op11_merkle_manifest"])
    names = [c[0] for c in result.description]
    got = queries.queries()["op11_merkle_manifest"](spark, SF_SMALL)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == sorted(result.fetchall())
