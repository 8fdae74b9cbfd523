"""Connected components of an edge table by alternating large-star and
small-star steps; every step is an aggregate and a join that are safe against
hub nodes, and each is stored in the shared folder, so plans stay small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over stored ``edges``.  Each node's least neighbour is stored
    before it is joined, so the join has two shuffled tables and Spark splits
    the edges of a hub."""
    pair = F.struct(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    back = F.struct(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    own = edges.select(F.explode(F.array(pair, back) if large else F.array(pair)).alias("e")).select("e.u", "e.v")
    least = scratch_table(own.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m")), "least")
    own = own.join(least, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "_m").alias("m"))
    if large:  # larger neighbours to the least neighbour
        out = own.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node and its smaller neighbours to the least one
        out = own.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) edges of long nodes → (node, component): for every node with an
    edge the least node that it can reach.  The number of rounds grows with
    the logarithm of the longest chain."""
    now = scratch_table(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        total, mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not total or (total, mark) == seen:
            break
        seen = (total, mark)
        now = scratch_table(_star(now, True), "edges")
        now = scratch_table(_star(now, False), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
