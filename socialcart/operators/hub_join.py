"""Friends who share a campaign, with hub users (Q1-d, Q1-e).

For every undirected friend pair and every campaign that both bought in, both
count.  Degrees decide how a pair meets:

* a pair is looked up from its end of lower degree, so a hub's edges are
  spread over its friends: an end that is looked up has at most
  ``light_degree`` edges, or is one of two hubs;
* the other end is checked by (campaign, user) where it is light, and against
  the broadcast (campaign, hub) set where it is a hub, so no task gathers a
  hub's edges.

Hubs are the users with more than ``light_degree`` edges; ``light_degree`` is
1/HUBS of all edge ends, so there are at most ``HUBS`` hubs whatever the graph,
and their set of campaigns is broadcast after a row check.  Neither AQE nor
salting is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialcart.operators.joins import bounded_broadcast

HUBS = 1024


def degrees(pairs: DataFrame) -> DataFrame:
    """``(user_id, degree)``, combined inside each task first."""
    return pairs.select(F.explode(F.array("a", "b")).alias("user_id")).groupBy("user_id").agg(F.count(F.lit(1)).alias("degree"))


def supported_buyers(buyers: DataFrame, friends: DataFrame, key: list[str], hubs: int = HUBS) -> DataFrame:
    """Distinct ``(*key, user_id)`` of the buyers (same columns) that have a
    friend (``friends``: user_id, friend_id) among the buyers of the same key."""
    pairs = friends.where("user_id <> friend_id").select(
        F.least("user_id", "friend_id").alias("a"), F.greatest("user_id", "friend_id").alias("b")).distinct()
    ends = degrees(pairs)
    light = F.greatest(F.lit(1), F.floor(2 * F.lit(pairs.count()) / F.lit(hubs)))
    # at most ``hubs`` users by arithmetic
    hub = ends.where(F.col("degree") > light).select("user_id", "degree")
    da, db = (bounded_broadcast(hub.select(F.col("user_id").alias(c), F.col("degree").alias(f"d{c}"))) for c in "ab")
    sized = pairs.join(da, "a", "left").join(db, "b", "left").fillna(0, ["da", "db"])
    turned = F.col("da") > F.col("db")
    asked = sized.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("user_id"),
                         F.when(turned, F.col("a")).otherwise(F.col("b")).alias("other"),
                         (F.greatest("da", "db") > 0).alias("to_hub"))
    own = buyers.select(*key, "user_id")
    reach = asked.join(own, "user_id")
    them = own.withColumnRenamed("user_id", "other")
    of_hubs = bounded_broadcast(them.join(bounded_broadcast(hub.select(F.col("user_id").alias("other"))), "other", "left_semi"))
    met = reach.where("to_hub").join(of_hubs, [*key, "other"], "left_semi").unionByName(
        reach.where("not to_hub").join(them, [*key, "other"], "left_semi"))
    return met.select(*key, F.explode(F.array("user_id", "other")).alias("user_id")).distinct()
