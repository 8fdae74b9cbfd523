"""Three-phase top k: equal to the full sort, ties included, and what moves."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from socialcart.operators import threshold_topk as T


@pytest.mark.parametrize("k,seed", [(1, 1), (5, 2), (20, 3), (500, 4)])
def test_equals_full_sort(spark, k, seed):
    pick = random.Random(seed)
    keys = [None if pick.random() < 0.05 else f"u{int(pick.paretovariate(0.7))}" for _ in range(3000)]
    rows = spark.createDataFrame([(x,) for x in keys], "u string").repartition(6)
    want = sorted(Counter(keys).items(), key=lambda x: (-x[1], x[0] is None, x[0] or ""))[:k]
    assert [tuple(r) for r in T.top_counts(rows, "u", k).collect()] == want


def test_all_tied(spark):
    rows = spark.range(200).select((F.col("id") % 50).alias("u")).repartition(4)
    assert [tuple(r) for r in T.top_counts(rows, "u", 7).collect()] == [(i, 4) for i in range(7)]


def test_empty(spark):
    got = T.top_counts(spark.createDataFrame([], "u long"), "u", 3)
    assert got.columns == ["u", "activity"] and got.count() == 0


def test_only_candidates_move(spark, monkeypatch):
    """20 heavy keys over 20,000 light ones: the light ones stay."""
    light = spark.range(20_000).select(F.col("id").alias("u"))
    heavy = spark.range(20 * 400).select((F.col("id") % 20 + 100_000).alias("u"))
    rows = light.unionByName(heavy).repartition(4, F.xxhash64(F.rand(3)))
    moved = []
    kth = T._kth

    def watch(sums, k):
        moved.append(sums.count())
        return kth(sums, k)
    monkeypatch.setattr(T, "_kth", watch)
    got = T.top_counts(rows, "u", 20)
    assert sorted(tuple(r) for r in got.collect()) == [(100_000 + i, 400) for i in range(20)]
    assert max(moved) <= 20 * 4
