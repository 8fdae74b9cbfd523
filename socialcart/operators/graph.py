"""Property-graph model as node and edge DataFrames.

Nodes are keyed DataFrames, edges are ``(src, dst, props…)`` DataFrames;
pattern matching is joins on edge tables.  "Merge" semantics (create once,
update in place) become keyed aggregates: first / last non-blank value per
key via ``min_by`` / ``max_by`` over an explicit order column, which the
caller supplies (file position, event time, row id) because a distributed
scan has no inherent row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialcart.functions.typing import composite_key

# Event types loaded as edges and their edge labels.
EVENT_EDGE_TYPES = {"view": "VIEWED", "cart": "CARTED", "purchase": "PURCHASED"}


def _first_non_blank(value: str, order: str) -> Column:
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def _last_non_blank(value: str, order: str) -> Column:
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def user_first_purchase(clients: DataFrame) -> DataFrame:
    """Per user, earliest first-purchase date and whether any exists."""
    return (clients.where(F.col("user_id").isNotNull()).groupBy("user_id")
            .agg(F.min("first_purchase_date").alias("first_purchase_date"),
                 F.coalesce(F.bool_or(F.col("first_purchase_date").isNotNull()), F.lit(False))
                 .alias("has_first_purchase")))


def client_nodes(clients: DataFrame, order: str, last: bool = True) -> DataFrame:
    """Client nodes with the earliest first-purchase date and the
    last (``last=True``, later rows overwrite) or first non-blank device."""
    pick = _last_non_blank if last else _first_non_blank
    return (clients.where(F.col("client_id").isNotNull()).groupBy("client_id")
            .agg(pick("user_device_id", order).alias("user_device_id"),
                 F.min("first_purchase_date").alias("first_purchase_date")))


def has_client_edges(clients: DataFrame, messages: DataFrame) -> DataFrame:
    """Distinct (user_id, client_id) from purchases and messages."""
    e = (clients.select("user_id", "client_id")
         .unionByName(messages.select("user_id", "client_id")))
    return e.where(F.col("user_id").isNotNull() & F.col("client_id").isNotNull()).distinct()


def product_nodes(events: DataFrame, order: str) -> DataFrame:
    """Product → first non-blank brand (products without one are kept)."""
    return (events.where(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(_first_non_blank("brand", order).alias("brand")))


def category_nodes(events: DataFrame, order: str) -> DataFrame:
    """Category → first non-blank code."""
    return (events.where(F.col("category_id").isNotNull()).groupBy("category_id")
            .agg(_first_non_blank("category_code", order).alias("category_code")))


def in_category_edges(events: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Distinct (product_id, category_id) whose two ends exist."""
    e = events.select("product_id", "category_id").where(
        F.col("product_id").isNotNull() & F.col("category_id").isNotNull()).distinct()
    return (e.join(products.select("product_id"), "product_id", "left_semi")
            .join(categories.select("category_id"), "category_id", "left_semi")
            .select("product_id", "category_id"))


def product_attributes(product_nodes: DataFrame, in_category: DataFrame,
                       categories: DataFrame) -> DataFrame:
    """Q2-g graph form: ``(product_id, category_code, brand)`` with the
    product's brand and the smallest code among its categories (the source
    takes the head of an unordered list; the minimum makes it deterministic)."""
    codes = (in_category.join(categories, "category_id")
             .groupBy("product_id").agg(F.min("category_code").alias("category_code")))
    return product_nodes.select("product_id", "brand").join(codes, "product_id", "left")


def event_edges(events: DataFrame) -> DataFrame:
    """User → product edges for view/cart/purchase (type lower-cased),
    one per event (not de-duplicated), with session, time and price."""
    t = F.lower(F.col("event_type"))
    label = None
    for k, v in EVENT_EDGE_TYPES.items():
        label = F.when(t == k, F.lit(v)) if label is None else label.when(t == k, F.lit(v))
    return (events.where(t.isin(*EVENT_EDGE_TYPES) & F.col("user_id").isNotNull()
                         & F.col("product_id").isNotNull())
            .select(F.col("user_id").alias("src"), F.col("product_id").alias("dst"),
                    label.alias("etype"), F.col("user_session").alias("session_id"),
                    "event_time", F.col("price").cast("double").alias("price")))


def message_upsert(messages: DataFrame, order: str) -> DataFrame:
    """One node per message_id; the last row (by ``order``) wins for
    every column except ``row_id``, which keeps the last non-blank value."""
    rest = [c for c in messages.columns if c not in ("message_id", "row_id", order)]
    agg = (messages.where(F.col("message_id").isNotNull()).groupBy("message_id")
           .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order)).alias("_m"),
                _last_non_blank("row_id", order).alias("row_id")))
    return agg.select("message_id", "row_id", "_m.*")


def campaign_key(df: DataFrame, id_col: str = "campaign_id",
                 type_col: str = "message_type") -> Column:
    return composite_key(F.col(id_col), F.col(type_col), None)


def received_edges(messages: DataFrame) -> DataFrame:
    """Client → message."""
    return (messages.where(F.col("client_id").isNotNull())
            .select("client_id", "message_id").distinct())


def belongs_to_edges(messages: DataFrame) -> DataFrame:
    """Message → campaign_key."""
    return (messages.where(F.col("campaign_id").isNotNull() & F.col("message_type").isNotNull())
            .select("message_id", campaign_key(messages).alias("campaign_key")).distinct())


def campaign_nodes(campaigns: DataFrame, belongs_to: DataFrame) -> DataFrame:
    """Campaign nodes plus stubs for keys only messages mention."""
    known = campaigns.select(
        composite_key(F.col("campaign_id"), F.col("campaign_type"), None).alias("campaign_key"),
        *campaigns.columns)
    stubs = (belongs_to.select("campaign_key").distinct()
             .join(known.select("campaign_key"), "campaign_key", "left_anti"))
    stubs = stubs.select("campaign_key",
                         F.split_part(F.col("campaign_key"), F.lit("|"), F.lit(1)).alias("campaign_id"),
                         F.split_part(F.col("campaign_key"), F.lit("|"), F.lit(2)).alias("campaign_type"))
    return known.unionByName(stubs, allowMissingColumns=True)


def friend_of_edges(friends_raw: DataFrame, users: DataFrame,
                    a: str = "friend1", b: str = "friend2") -> DataFrame:
    """Distinct directed pairs whose two users exist."""
    from socialcart.operators.model import friend_edges

    e = friend_edges(friends_raw, a, b)
    u = users.select("user_id")
    return (e.join(u, "user_id", "left_semi")
            .join(u.select(F.col("user_id").alias("friend_id")), "friend_id", "left_semi")
            .select("user_id", "friend_id"))


def campaign_helper_edges(has_client: DataFrame, messages: DataFrame) -> DataFrame:
    """(user_id, campaign_key, purchased) for every user reached over
    user → client → message → campaign; ``purchased`` = any of those
    messages was purchased.  ``received`` = all rows, ``purchased`` = rows
    with the flag — one aggregate gives both helper edge sets.

    Messages are first folded per (client, campaign) (partial aggregation),
    so the join with the client's users never pairs individual messages
    with users: its size is bounded by the distinct campaigns per client."""
    per_client = (messages.where(F.col("client_id").isNotNull())
                  .groupBy("client_id", campaign_key(messages).alias("campaign_key"))
                  .agg(F.bool_or(F.coalesce(F.col("is_purchased"), F.lit(False))).alias("p")))
    return (has_client.join(per_client, "client_id")
            .groupBy("user_id", "campaign_key").agg(F.bool_or("p").alias("purchased")))


def helper_counts(helpers: DataFrame, messages: DataFrame) -> DataFrame:
    """Helper edge counts and message bounds in one row (the message
    bounds are scalar subqueries, no join)."""
    m = messages.agg(F.min("row_id").alias("lo"), F.max("row_id").alias("hi"),
                     F.count(F.lit(1)).alias("n"))
    return helpers.agg(F.count(F.lit(1)).alias("received_campaign_edges"),
                       F.count_if(F.col("purchased")).alias("purchased_campaign_edges")).select(
        "received_campaign_edges", "purchased_campaign_edges",
        m.select("lo").scalar().alias("min_row_id"), m.select("hi").scalar().alias("max_row_id"),
        m.select("n").scalar().alias("message_count"))


def q1_graph(campaigns: DataFrame, messages: DataFrame, clients: DataFrame,
             friends_raw: DataFrame, users: DataFrame | None = None, top_n: int = 20) -> DataFrame:
    """Q1 graph form end to end: recipients over clients (M1), every campaign
    listed (M5), empty ratios 0 (M6).

    FRIEND_OF edges need both users to exist.  When ``users`` is the D01
    user set built from the same friendship rows it holds every endpoint by
    construction, so the check cannot remove an edge and is skipped (pass
    ``users`` to check against another user set)."""
    from socialcart.operators.model import friend_edges
    from socialcart.plans.campaigns import campaign_conversion_graph

    hc = has_client_edges(clients, messages)
    helpers = campaign_helper_edges(hc, messages)
    nodes = campaign_nodes(campaigns, belongs_to_edges(messages))
    received = helpers.select("user_id", "campaign_key")
    purchased = helpers.where("purchased").select("user_id", "campaign_key")
    fo = friend_edges(friends_raw) if users is None else friend_of_edges(friends_raw, users)
    return campaign_conversion_graph(nodes, received, purchased, fo, top_n)
