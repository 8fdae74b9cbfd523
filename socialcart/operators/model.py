"""Relational modelling: dimensions and facts from cleaned rows.

"Best row per key" (DISTINCT ON / ROW_NUMBER() = 1 in the source) is written
as ``min_by(struct(values), struct(ordering))``: one hash aggregate with a
map-side partial step, so a key holding a large share of the rows is
combined before the shuffle instead of being sorted in one task.  NULLS LAST
is encoded by putting ``isnull(c)`` before ``c`` in the ordering struct; a
descending column is ordered through ``max_by`` or a negated rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def friend_edges(raw: DataFrame, a: str = "friend1", b: str = "friend2") -> DataFrame:
    """Distinct *directed* friend pairs without self-loops or blanks.

    ``(a, b)`` and ``(b, a)`` both stay.  One hash aggregate (map-side
    combine first), no sort.
    """
    return (raw.select(F.col(a).alias("user_id"), F.col(b).alias("friend_id"))
            .where(F.col("user_id").isNotNull() & F.col("friend_id").isNotNull()
                   & (F.col("user_id") != F.col("friend_id")))
            .distinct())


def _nulls_last(cols: list[str]) -> Column:
    parts = []
    for c in cols:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.struct(*parts)


def best_row(df: DataFrame, key: list[str], order: list[str],
             tie_break: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the first by ``order`` then ``tie_break``
    (ascending, NULLS LAST), as one partial + final hash aggregate."""
    values = [c for c in df.columns if c not in key]
    rank = _nulls_last(list(order) + list(tie_break or []))
    best = (df.groupBy(*key)
            .agg(F.min_by(F.struct(*[F.col(c) for c in values]), rank).alias("_b")))
    return best.select(*key, "_b.*")


def users_dim(clients: DataFrame, events: DataFrame, messages: DataFrame,
              friends_raw: DataFrame) -> DataFrame:
    """Every non-blank user id seen anywhere, once."""
    ids = (clients.select(F.col("user_id"))
           .unionByName(events.select("user_id"))
           .unionByName(messages.select("user_id"))
           .unionByName(friends_raw.select(F.col("friend1").alias("user_id")))
           .unionByName(friends_raw.select(F.col("friend2").alias("user_id"))))
    return ids.where(F.col("user_id").isNotNull()).distinct()


def clients_dim(clients: DataFrame) -> DataFrame:
    """Best row per client: earliest first purchase, then user, then
    device (NULLs last)."""
    rows = clients.select("client_id", "user_id", "first_purchase_date", "user_device_id") \
        .where(F.col("client_id").isNotNull())
    return best_row(rows, ["client_id"], ["first_purchase_date", "user_id", "user_device_id"]) \
        .select("client_id", "user_id", "first_purchase_date", "user_device_id")


def message_only_clients(messages: DataFrame, clients: DataFrame) -> DataFrame:
    """Clients seen only in messages (best row by user then device),
    with no first purchase date."""
    rows = messages.select("client_id", "user_id", "user_device_id") \
        .where(F.col("client_id").isNotNull())
    best = best_row(rows, ["client_id"], ["user_id", "user_device_id"])
    return (best.join(clients.select("client_id"), "client_id", "left_anti")
            .select("client_id", "user_id", F.lit(None).cast("date").alias("first_purchase_date"),
                    "user_device_id"))


def products_dim(events: DataFrame) -> DataFrame:
    """One row per product: lowest (category_id, category_code, brand),
    NULLs last."""
    rows = events.select("product_id", "category_id", "category_code", "brand") \
        .where(F.col("product_id").isNotNull())
    return best_row(rows, ["product_id"], ["category_id", "category_code", "brand"]) \
        .select("product_id", "category_id", "category_code", "brand")


def campaigns_dim(campaigns: DataFrame, key: tuple[str, str] = ("campaign_id", "campaign_type"),
                  tie_break: list[str] | None = None) -> DataFrame:
    """Latest row per (campaign_id, campaign_type): finished_at desc,
    then started_at desc, NULLs last; full ties (left open by the source) go
    to the largest remaining columns (``tie_break``, default: all other
    columns in order, NULLs last).

    One ``max_by`` aggregate over the ordering struct
    ``(finished is not null, finished, started is not null, started, …)``:
    descending NULLS LAST without casting or negating timestamps, so the
    order does not depend on the session time zone."""
    k = list(key)
    rest = [c for c in campaigns.columns if c not in k]
    tb = tie_break if tie_break is not None else [c for c in rest
                                                  if c not in ("finished_at", "started_at")]
    rows = campaigns.where(F.col(k[0]).isNotNull() & F.col(k[1]).isNotNull())
    rank = []
    for c in ["finished_at", "started_at", *tb]:
        rank += [F.col(c).isNotNull(), F.col(c)]
    best = rows.groupBy(*k).agg(F.max_by(F.struct(*[F.col(c) for c in rest]),
                                         F.struct(*rank)).alias("_b"))
    return best.select(*k, "_b.*").select(*campaigns.columns)


def dense_ids(df: DataFrame, order: list[str] | None, name: str = "event_id",
              prefix: str = "ev_", checkpoint: bool = True) -> DataFrame:
    """C17: ``<prefix><n>`` numbered densely from 1 in ``order``, or in input
    order (file, then row position, like a sequence on insert) when
    ``order`` is None — that case needs no sort at all.

    With an order: a global sort (range partitioning, all executors).  Then
    per-partition row counts (one small aggregate: one row per partition)
    turned into offsets.  The frame is checkpointed to the shared checkpoint
    folder so the two reads see the same partitions, also after an executor
    loss; no rows pass through the driver.
    """
    s = (df.orderBy(*order) if order else df)
    s = (s.withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        from socialcart.session import checkpoint_root

        checkpoint_root(df.sparkSession)
        s = s.checkpoint(eager=True)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    rin = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (s.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.concat(F.lit(prefix), (F.col("_off") + rin + 1).cast("string")))
            .drop("_pid", "_mid", "_off"))
