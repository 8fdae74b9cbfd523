"""Loading: cleaned extracts → typed relational tables.

Input: the five cleaned extracts as all-text DataFrames (``campaigns``,
``client_first_purchase_date``, ``events``, ``messages``, ``friends``;
columns as in FIXTURES §1).  Output: ``users, clients, products, events,
campaigns, messages, friends`` with the typed schemas of FIXTURES §2.  The
nested document form of messages (C19) and the graph node / edge tables
(D09–D19) are built from these by :mod:`socialcart.functions.typing` and
:mod:`socialcart.operators.graph`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialcart.functions import typing as TY
from socialcart.operators import model as M

EXTRACTS = ("campaigns", "client_first_purchase_date", "events", "messages", "friends")

# Typed columns of the campaign and message tables.
CAMPAIGN_BOOLEANS = ("ab_test", "warmup_mode", "subject_with_personalization",
                     "subject_with_deadline", "subject_with_emoji", "subject_with_bonuses",
                     "subject_with_discount", "subject_with_saleout", "is_test")
MESSAGE_TEXT = ("channel", "category", "platform", "email_provider", "stream")
MESSAGE_FLAGS = ("opened", "clicked", "unsubscribed", "hard_bounced", "soft_bounced",
                 "complained", "blocked", "purchased")
MESSAGE_TIMES = ("opened_first_time_at", "opened_last_time_at", "clicked_first_time_at",
                 "clicked_last_time_at", "unsubscribed_at", "hard_bounced_at", "soft_bounced_at",
                 "complained_at", "blocked_at", "purchased_at", "created_at", "updated_at")


def read_cleaned(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The cleaned extracts written by ``csv_io.clean_csv_tree``."""
    out = {}
    for name in EXTRACTS:
        if fmt == "csv":
            out[name] = spark.read.option("header", True).csv(f"{root}/{name}.csv")
        else:
            out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def _t(c: str):
    return TY.blank_null(F.col(c))


def typed_campaigns(raw: DataFrame, strict: bool = True) -> DataFrame:
    cols = set(raw.columns)
    sel = [TY.composite_key(_t("id"), _t("campaign_type")).alias("campaign_pk"),
           _t("id").alias("campaign_id"), _t("campaign_type").alias("campaign_type"),
           _t("channel").alias("channel"), _t("topic").alias("topic"),
           TY.to_timestamp_ntz(F.col("started_at"), strict).alias("started_at"),
           TY.to_timestamp_ntz(F.col("finished_at"), strict).alias("finished_at"),
           TY.to_int(F.col("total_count"), strict).alias("total_count")]
    sel += [TY.to_bool(F.col(c)).alias(c) for c in CAMPAIGN_BOOLEANS if c in cols]
    sel += [TY.to_decimal(F.col(c), strict).alias(c) for c in ("hour_limit", "subject_length")
            if c in cols]
    if "position" in cols:
        sel.append(TY.to_int(F.col("position"), strict).alias("position"))
    return M.campaigns_dim(raw.select(*sel))


def typed_messages(raw: DataFrame, strict: bool = True) -> DataFrame:
    cols = set(raw.columns)
    sel = [_t("id").alias("row_id"), _t("message_id").alias("message_id"),
           _t("campaign_id").alias("campaign_id"), _t("message_type").alias("message_type"),
           _t("client_id").alias("client_id"), _t("user_id").alias("user_id")]
    sel += [_t(c).alias(c) for c in MESSAGE_TEXT if c in cols]
    if "date" in cols:
        sel.append(TY.to_date(F.col("date"), strict).alias("date"))
    if "sent_at" in cols:
        sel.append(TY.to_timestamp_ntz(F.col("sent_at"), strict).alias("sent_at"))
    sel += [TY.to_bool(F.col(f"is_{c}")).alias(f"is_{c}") for c in MESSAGE_FLAGS
            if f"is_{c}" in cols]
    sel += [TY.to_timestamp_ntz(F.col(c), strict).alias(c) for c in MESSAGE_TIMES if c in cols]
    if "user_device_id" in cols:
        sel.append(_t("user_device_id").alias("user_device_id"))
    return raw.select(*sel).dropna("any", subset=["row_id", "client_id", "user_id",
                                                   "campaign_id", "message_type"])


def typed_events(raw: DataFrame, strict: bool = True) -> DataFrame:
    e = raw.select(TY.to_instant(F.col("event_time"), strict).alias("event_time"),
                   _t("event_type").alias("event_type"), _t("user_id").alias("user_id"),
                   _t("product_id").alias("product_id"),
                   TY.to_decimal(F.col("price"), strict).alias("price"),
                   _t("user_session").alias("user_session"))
    e = e.dropna("any", subset=["user_id", "product_id"])
    # numbered in input order, like a sequence filled on insert: no sort
    return M.dense_ids(e, None).select(
        "event_id", "event_time", "event_type", "user_id", "product_id", "price", "user_session")


def build_relational(extracts: dict[str, DataFrame], strict: bool = True) -> dict[str, DataFrame]:
    """All seven typed tables; nothing is computed until they are written."""
    clients_raw = extracts["client_first_purchase_date"].select(
        _t("client_id").alias("client_id"), _t("user_id").alias("user_id"),
        TY.to_date(F.col("first_purchase_date"), strict).alias("first_purchase_date"),
        _t("user_device_id").alias("user_device_id"))
    msg_raw = extracts["messages"].select(_t("client_id").alias("client_id"),
                                          _t("user_id").alias("user_id"),
                                          _t("user_device_id").alias("user_device_id"))
    ev_raw = extracts["events"]
    friends_raw = extracts["friends"].select(_t("friend1").alias("friend1"),
                                             _t("friend2").alias("friend2"))
    clients = M.clients_dim(clients_raw)
    clients = clients.unionByName(M.message_only_clients(msg_raw, clients))
    products = M.products_dim(ev_raw.select(_t("product_id").alias("product_id"),
                                            _t("category_id").alias("category_id"),
                                            _t("category_code").alias("category_code"),
                                            _t("brand").alias("brand")))
    users = M.users_dim(clients_raw, ev_raw.select(_t("user_id").alias("user_id")), msg_raw,
                        friends_raw)
    return {
        "users": users,
        "clients": clients,
        "products": products,
        "events": typed_events(ev_raw, strict),
        "campaigns": typed_campaigns(extracts["campaigns"], strict),
        "messages": typed_messages(extracts["messages"], strict),
        "friends": M.friend_edges(friends_raw),
    }


def write_tables(tables: dict[str, DataFrame], out_dir: str) -> None:
    """Full refresh of every target table (Parquet, overwrite)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    names = ("users", "clients", "products", "events", "campaigns", "messages", "friends")
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


def build_document(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Document form (C18–C19): messages with nested ``campaign_ref`` and
    ``engagement``, products with a lower-cased search text, events carrying
    the product attributes (products are a dimension: the join is planned by
    Spark, broadcast when small)."""
    from socialcart.plans.documents import message_documents

    products = t["products"].withColumn(
        "category_search_text", TY.search_text(F.col("category_code"), F.col("brand")))
    events = t["events"].join(t["products"], "product_id", "left")
    return {"messages": message_documents(t["messages"]), "products": products, "events": events,
            "users": t["users"], "clients": t["clients"], "campaigns": t["campaigns"],
            "friendships": t["friends"]}


def build_graph(t: dict[str, DataFrame], events_raw: DataFrame | None = None) -> dict[str, DataFrame]:
    """Graph form (D09–D18) as node and edge tables from the typed tables;
    ``events_raw`` (cleaned text with category columns) feeds the category
    nodes when given."""
    from socialcart.operators import graph as G

    ev = t["events"]
    if events_raw is None:
        cat_src = t["products"].withColumn("_ord", F.col("product_id"))
    else:
        # "first" in time order; all columns break ties, so every run agrees
        names = ["product_id", "category_id", "category_code", "brand"]
        order = F.struct(*[_t(c) for c in ("event_time", "user_id", "user_session", "event_type", *names) if c in events_raw.columns])
        cat_src = events_raw.select(*[_t(c).alias(c) for c in names], order.alias("_ord"))
    products = G.product_nodes(cat_src, "_ord")
    categories = G.category_nodes(cat_src, "_ord")
    has_client = G.has_client_edges(t["clients"], t["messages"])
    helpers = G.campaign_helper_edges(has_client, t["messages"])
    return {
        "g_user": G.user_first_purchase(t["clients"]).join(t["users"], "user_id", "right")
        .select("user_id", F.coalesce("has_first_purchase", F.lit(False)).alias("has_first_purchase"),
                "first_purchase_date"),
        "g_product": products, "g_category": categories,
        "e_has_client": has_client,
        "e_in_category": G.in_category_edges(cat_src, products, categories),
        "e_event": G.event_edges(ev),
        "e_received": G.received_edges(t["messages"]),
        "e_belongs_to": G.belongs_to_edges(t["messages"]),
        "g_campaign": G.campaign_nodes(t["campaigns"], G.belongs_to_edges(t["messages"])),
        "e_friend_of": G.friend_of_edges(
            t["friends"].select(F.col("user_id").alias("friend1"), F.col("friend_id").alias("friend2")),
            t["users"]),
        "e_received_campaign": helpers.select("user_id", "campaign_key"),
        "e_purchased_campaign": helpers.where("purchased").select("user_id", "campaign_key"),
    }
