"""Pairs ordered by degree: exact results, and no task that holds a hub."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from socialcart.operators.hub_join import supported_buyers


def brute(buyers, friends):
    of = {}
    for c, u in buyers:
        of.setdefault(c, set()).add(u)
    return {(c, u) for c, who in of.items() for a, b in friends if a != b and a in who and b in who for u in (a, b)}


@pytest.mark.parametrize("hubs", [1, 4, 1024])
def test_equals_brute_force(spark, hubs):
    pick = random.Random(hubs)
    friends = [(pick.randrange(40), pick.randrange(40)) for _ in range(120)] + [(0, u) for u in range(40)] + [(u, 1) for u in range(30)]
    buyers = list({(pick.randrange(4), pick.randrange(40)) for _ in range(60)} | {(0, 0), (1, 1), (2, 0)})
    got = supported_buyers(spark.createDataFrame(buyers, "c int, user_id int"),
                           spark.createDataFrame(friends, "user_id int, friend_id int"), ["c"], hubs)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(buyers, friends)


def test_no_task_gathers_a_hub(spark):
    """A hub holds a third of the edges; AQE is off.  The rows that meet by
    (campaign, user) in one task stay near the median."""
    n, adaptive = 3000, spark.conf.get("spark.sql.adaptive.enabled")
    edges = spark.range(1, n).selectExpr("0L AS user_id", "id AS friend_id").unionByName(
        spark.range(1, 2 * n).selectExpr("id % 2999 + 1 AS user_id", "(id * 7) % 2999 + 1 AS friend_id"))
    buyers = spark.range(0, n).selectExpr("id AS user_id").withColumn("c", F.lit(1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = supported_buyers(buyers, edges, ["c"])
        assert got.count() == n
        per_task = Counter(r[0] for r in got.select(F.spark_partition_id()).collect())
        assert max(per_task.values()) <= 2 * sorted(per_task.values())[len(per_task) // 2]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan  # hubs meet as a set
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
