"""Q2 — products to recommend to the most active users from friends' events.

Semantics (relational form): targets are the 100 users with most events (any
type; ties by user id).  A friend's view/cart/purchase event on a product
scores 1/2/3 for the target; a friend pair stored in both directions counts
twice.  Products the target touched with any event are dropped.  Each target
keeps its 5 best products by (score desc, interactions desc, product asc),
with category code and brand when the product is known.

Plan shape:

* targets: partial aggregate + ``TakeOrderedAndProject`` → at most
  ``n_targets`` rows (bound proven by the limit), computed once and used by
  every branch as a local table.
* the edge table is scanned once, broadcast-joined to the targets (no
  shuffle of the edges).
* roles = (target, friend, self=false) ∪ (target, target, self=true),
  broadcast after a row check (nothing is cached, so nothing is left behind).  The event scan joins them map-side — filter to users
  of interest and fan-out to their targets in one step — and partial
  aggregation per (target, product) combines the rows before the one
  shuffle of event data.  Above the bound, events are semi-joined and
  folded per (user, product) first, then shuffle-joined.
* the same aggregate gives the friend score, the interaction count and the
  own-product flag (NOT EXISTS without a second pass over the events).
* per-target top-k is ``row_number() <= k`` → ``WindowGroupLimit`` runs
  before the shuffle, so at most k rows per target and map task move.
* product attributes: products are semi-joined to the (≤ targets × k)
  recommended ids before the left join, so the product table is filtered
  in its scan stage instead of being shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from socialcart.operators.joins import BROADCAST_MAX_ROWS, checked_broadcast, undirected

# Event weights of the recommendation score.
WEIGHTS = {"purchase": 3, "cart": 2, "view": 1}
REC_TYPES = ("view", "cart", "purchase")
RESULT_COLUMNS = ["target_user_id", "product_id", "weighted_score", "interactions",
                  "category_code", "brand", "rank_in_user"]


def _weight(etype: Column) -> Column:
    expr = None
    for k, v in WEIGHTS.items():
        expr = F.when(etype == k, F.lit(v)) if expr is None else expr.when(etype == k, F.lit(v))
    return expr.otherwise(F.lit(0))


def top_active_users(events: DataFrame, n: int = 100,
                     activity_types: tuple[str, ...] | None = None) -> DataFrame:
    """Q2-a: ``(user_id, activity)`` of the ``n`` users with most events;
    ``activity_types=None`` counts every event (relational), else only the
    listed types (graph, M8).  Ties broken by user id."""
    e = events if activity_types is None else events.where(F.col("event_type").isin(*activity_types))
    return (e.groupBy("user_id").agg(F.count(F.lit(1)).alias("activity"))
            .orderBy(F.col("activity").desc(), F.col("user_id").asc_nulls_last())
            .limit(n))


def target_friends(friends: DataFrame, targets: DataFrame, dedupe_edges: bool = False) -> DataFrame:
    """Q2-b: ``(target_user_id, friend_id)`` over undirected edges; a pair
    stored both ways appears twice unless ``dedupe_edges``."""
    edges = undirected(friends, "user_id", "friend_id")
    t = F.broadcast(targets.select("user_id"))  # ≤ n_targets rows
    tf = edges.join(t, "user_id").select(F.col("user_id").alias("target_user_id"), "friend_id")
    # de-duplicate after the restriction, so only the targets' edges move
    return tf.distinct() if dedupe_edges else tf


def _event_contributions(events: DataFrame, own_types: tuple[str, ...] | None) -> DataFrame:
    """Per event: ``score`` and ``n`` for the recommendation types and
    ``touched`` for the own-product exclusion (all types when None)."""
    rec = F.col("event_type").isin(*REC_TYPES)
    own = F.lit(True) if own_types is None else F.col("event_type").isin(*own_types)
    return events.select("user_id", "product_id",
                         F.when(rec, _weight(F.col("event_type"))).otherwise(0).alias("score"),
                         F.when(rec, 1).otherwise(0).alias("n"), own.alias("touched"))


def user_product_activity(events: DataFrame, users: DataFrame,
                          own_types: tuple[str, ...] | None = None) -> DataFrame:
    """Events of ``users`` folded to one row per (user, product):
    ``score`` and ``n`` over the recommendation types, ``touched`` = any event
    of ``own_types`` (all types when None)."""
    return (_event_contributions(events, own_types).join(users, "user_id", "left_semi")
            .groupBy("user_id", "product_id")
            .agg(F.sum("score").alias("score"), F.sum("n").alias("n"),
                 F.bool_or("touched").alias("touched")))


def attach_products(recs: DataFrame, products: DataFrame) -> DataFrame:
    """Q2-g: category_code and brand, NULL when the product is unknown."""
    ids = F.broadcast(recs.select("product_id").distinct())
    attrs = (products.select("product_id", "category_code", "brand")
             .join(ids, "product_id", "left_semi"))
    return recs.join(attrs, "product_id", "left")


def recommendations(events: DataFrame, friends: DataFrame, products: DataFrame,
                    n_targets: int = 100, k: int = 5,
                    activity_types: tuple[str, ...] | None = None,
                    own_types: tuple[str, ...] | None = None,
                    dedupe_edges: bool = False, method: str = "window",
                    broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Q2 end to end.  ``method='window'`` ranks with ``row_number``;
    ``method='array'`` builds the ranked list per target as an array
    (collect / sort / slice / posexplode, as the document form does) — over
    the already limited rows, so no group collects more than ``k`` rows.

    One "roles" table maps each user of interest to the targets it matters
    for: (target, friend, self=false) and (target, target, self=true).  The
    event fact is scanned once and joined to the roles (broadcast after a
    row check: filter and fan-out happen map-side); one aggregate per
    (target, product) then gives the friend scores and the own-product flag
    together, so the NOT EXISTS needs no second pass over the events.
    """
    top = top_active_users(events, n_targets, activity_types).select("user_id")
    # ≤ n_targets rows, computed once and shared by every branch below
    targets = events.sparkSession.createDataFrame(top.collect(), top.schema)
    tf = target_friends(friends, targets, dedupe_edges)
    roles = tf.select("target_user_id", F.col("friend_id").alias("user_id"),
                      F.lit(False).alias("is_self")).unionByName(
        targets.select(F.col("user_id").alias("target_user_id"), "user_id",
                       F.lit(True).alias("is_self")))
    roles, small = checked_broadcast(roles, broadcast_max_rows)
    if small:
        # map-side: the broadcast join filters the events to users of interest
        # and fans them out to their targets; partial aggregation per
        # (target, product) combines the fan-out before the one shuffle
        act = _event_contributions(events, own_types)
    else:
        # large role table: fold events per (user, product) first, so the
        # shuffle join moves pre-aggregated rows (AQE splits hot users)
        act = user_product_activity(events, roles.select("user_id").distinct(), own_types)
    friend = ~F.col("is_self")
    scored = (act.join(roles, "user_id")
              .groupBy("target_user_id", "product_id")
              .agg(F.sum(F.when(friend, F.col("score"))).cast("bigint").alias("weighted_score"),
                   F.sum(F.when(friend, F.col("n"))).cast("bigint").alias("interactions"),
                   F.bool_or(F.col("is_self") & F.col("touched")).alias("own")))
    fresh = scored.where(~F.col("own") & (F.col("interactions") > 0)).drop("own")
    w = Window.partitionBy("target_user_id").orderBy(
        F.col("weighted_score").desc(), F.col("interactions").desc(), F.col("product_id").asc())
    ranked = fresh.withColumn("rank_in_user", F.row_number().over(w)).where(F.col("rank_in_user") <= k)
    if method == "array":
        ranked = _array_rank(ranked, k)
    out = attach_products(ranked, products)
    # ≤ n_targets × k rows: one sorted partition, no range-partitioning pass
    return (out.select(*RESULT_COLUMNS).coalesce(1)
            .sortWithinPartitions("target_user_id", "rank_in_user"))


def _array_rank(rows: DataFrame, k: int) -> DataFrame:
    """Q2-f array form: sorted list per target, ``slice`` to k, position = rank."""
    item = F.struct(
        (-F.col("weighted_score")).alias("neg_score"), (-F.col("interactions")).alias("neg_n"),
        F.col("product_id"), F.col("weighted_score"), F.col("interactions"))
    lists = (rows.groupBy("target_user_id")
             .agg(F.slice(F.array_sort(F.collect_list(item)), 1, k).alias("recs")))
    return lists.select("target_user_id", F.posexplode("recs").alias("pos", "rec")).select(
        "target_user_id", F.col("rec.product_id").alias("product_id"),
        F.col("rec.weighted_score").alias("weighted_score"),
        F.col("rec.interactions").alias("interactions"),
        (F.col("pos") + 1).cast("int").alias("rank_in_user"))
