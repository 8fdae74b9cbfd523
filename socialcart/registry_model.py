"""Registered queries for cleaning, typing, modelling, graph and checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from socialcart.functions import clean as C
from socialcart.functions import typing as TY
from socialcart.operators import graph as G
from socialcart.operators import model as M
from socialcart.operators import quality as V
from socialcart.plans import stats as B
from socialcart.sources import testviews as tv


# --- cleaning (C01–C08, S06) ----------------------------------------------

def _clean_one(col: str, compat: bool = False):
    def run(spark, d):
        raw = tv.raw_messages(spark, d).select(F.col(col).alias("raw"), F.col(col))
        return C.clean_columns(raw, [col], compat).withColumnRenamed(col, "cleaned")
    return run


def clean_row(spark, d):
    return C.clean_frame(tv.raw_messages(spark, d))


# --- typing (C09–C17, C19–C21) and modelling (D01–D07) --------------------

def typed_messages(spark, d):
    # required fields (C21) are checked inside the cleaning, before the
    # expensive rules: a cleaned value is blank iff it is blank there
    c = C.clean_frame(tv.raw_messages(spark, d), required=("id", "message_type"))
    return c.select(
        TY.blank_null(F.col("id")).alias("row_id"),
        TY.blank_null(F.col("message_type")).alias("message_type"),
        TY.to_bool(F.col("is_purchased")).alias("is_purchased"),
        TY.to_timestamp_ntz(F.col("sent_at"), strict=False).alias("sent_at"),
        TY.to_decimal(F.col("price"), strict=False).alias("price"),
        TY.blank_null(F.col("status")).alias("status"))


def typed_campaigns(spark, d):
    raw = tv.raw_campaigns(spark, d)
    typed = raw.select(
        TY.composite_key(TY.blank_null(F.col("id")), TY.blank_null(F.col("campaign_type")))
        .alias("campaign_pk"),
        TY.blank_null(F.col("id")).alias("campaign_id"),
        TY.blank_null(F.col("campaign_type")).alias("campaign_type"),
        TY.blank_null(F.col("channel")).alias("channel"),
        TY.to_timestamp_ntz(F.col("started_at")).alias("started_at"),
        TY.to_timestamp_ntz(F.col("finished_at")).alias("finished_at"),
        TY.to_int(F.col("total_count")).alias("total_count"),
        TY.to_bool(F.col("ab_test")).alias("ab_test"),
        TY.to_decimal(F.col("hour_limit")).alias("hour_limit"),
        TY.to_int(F.col("position")).alias("position"))
    return M.campaigns_dim(typed)


def typed_events(spark, d):
    e = tv.raw_events(spark, d).where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
    e = e.select(F.col("event_id").alias("src_event_id"), "event_time", "event_type", "user_id",
                 "product_id", F.col("price").cast("decimal(38,10)").alias("price"), "user_session")
    return M.dense_ids(e, ["event_time", "src_event_id"]).drop("src_event_id")


def messages_nested_roundtrip(spark, d):
    m = tv.messages(spark, d).withColumn(
        "campaign_key", TY.composite_key(F.col("campaign_id"), F.col("message_type")))
    nested = TY.nest(m, {"campaign_ref": ["campaign_id", "message_type", "campaign_key"],
                         "engagement": ["is_purchased", "sent_at"]})
    return nested.select("row_id", "user_id",
                         F.col("campaign_ref.campaign_key").alias("campaign_key"),
                         F.col("campaign_ref.campaign_id").alias("campaign_id"),
                         F.col("engagement.is_purchased").alias("is_purchased"),
                         F.col("engagement.sent_at").alias("sent_at"))


def product_search_text(spark, d):
    p = tv.products(spark, d)
    return p.select("product_id", TY.search_text(F.col("category_code"), F.col("brand"))
                    .alias("search_text"))


def users_dim(spark, d):
    return M.users_dim(tv.clients(spark, d), tv.events(spark, d), tv.messages(spark, d),
                       tv.friends_raw(spark, d))


def clients_dim(spark, d):
    return M.clients_dim(tv.clients(spark, d))


def message_only_clients(spark, d):
    return M.message_only_clients(tv.messages(spark, d), M.clients_dim(tv.clients(spark, d)))


def products_dim(spark, d):
    return M.products_dim(tv.raw_events(spark, d))


# --- graph (D09–D19) ---------------------------------------------------------

def first_purchase(spark, d):
    return G.user_first_purchase(tv.clients(spark, d))


def client_device(spark, d):
    return G.client_nodes(tv.clients(spark, d), "row_ord", last=True)


def client_device_first(spark, d):
    return G.client_nodes(tv.clients(spark, d), "row_ord", last=False)


def has_client_edges(spark, d):
    return G.has_client_edges(tv.clients(spark, d), tv.messages(spark, d))


def graph_products(spark, d):
    return G.product_nodes(tv.raw_events(spark, d), "event_id")


def graph_categories(spark, d):
    return G.category_nodes(tv.raw_events(spark, d), "event_id")


def in_category_edges(spark, d):
    e = tv.raw_events(spark, d)
    return G.in_category_edges(e, G.product_nodes(e, "event_id"), G.category_nodes(e, "event_id"))


def event_edges(spark, d):
    return G.event_edges(tv.raw_events(spark, d))


def message_upsert(spark, d):
    m = tv.messages(spark, d).select(
        (F.col("row_id") / 2).cast("bigint").alias("message_id"),
        F.when(F.col("row_id") % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.col("row_id"))
        .alias("row_id"),
        F.col("row_id").alias("ord"), "campaign_id", "message_type", "user_id", "is_purchased")
    return G.message_upsert(m, "ord")


def campaign_nodes(spark, d):
    m = tv.messages(spark, d)
    return G.campaign_nodes(tv.campaigns(spark, d), G.belongs_to_edges(m))


def friend_of_edges(spark, d):
    return G.friend_of_edges(tv.friends_raw(spark, d), users_dim(spark, d))


def campaign_helper_edges(spark, d):
    m = tv.messages(spark, d)
    return G.campaign_helper_edges(G.has_client_edges(tv.clients(spark, d), m), m)


def helper_counts(spark, d):
    return G.helper_counts(campaign_helper_edges(spark, d), tv.messages(spark, d))


def q1_graph(spark, d):
    # users (D01) include every friendship endpoint, so FRIEND_OF needs no
    # existence check here (see G.q1_graph); tests assert the invariant
    return G.q1_graph(tv.campaigns(spark, d), tv.messages(spark, d), tv.clients(spark, d),
                      tv.friends_raw(spark, d))


# --- data-quality checks (V01–V04), load report, timing statistics ----------

def q3_graph_search(spark, d):
    from socialcart.plans import recommend as q2
    from socialcart.plans import search as q3

    e = tv.raw_events(spark, d)
    cats = G.category_nodes(e, "event_id")
    pn = G.product_nodes(e, "event_id")
    ic = G.in_category_edges(e, pn, cats)
    recs = q2.recommendations(tv.events(spark, d), tv.friends(spark, d), tv.products(spark, d),
                              activity_types=q2.REC_TYPES, own_types=q2.REC_TYPES)
    kw = q3.keywords(recs, tv.products(spark, d), distinct_products=False)
    return q3.graph_token_search(kw, cats, ic, pn)


def dq_unique(spark, d):
    return V.duplicate_keys(tv.clients(spark, d), ["client_id"])


def dq_not_null(spark, d):
    return V.null_counts(tv.raw_events(spark, d), ["category_code", "brand", "category_id"],
                         "events")


def dq_foreign_key(spark, d):
    msgs, ev = tv.messages(spark, d), tv.events(spark, d)
    camps = tv.campaigns(spark, d).withColumnRenamed("campaign_type", "message_type")
    return V.foreign_key_report({
        "messages_user": (msgs, users_dim(spark, d), ["user_id"], ["user_id"]),
        "events_product": (ev, tv.products(spark, d), ["product_id"], ["product_id"]),
        "messages_campaign": (msgs, camps, ["campaign_id", "message_type"],
                              ["campaign_id", "message_type"]),
        "friends_user": (tv.friends(spark, d), tv.events(spark, d), ["user_id"], ["user_id"]),
    })


EXPECTED_PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("category_id", T.StringType(), True),
    T.StructField("category_code", T.StringType(), False),
    T.StructField("brand", T.StringType(), False),
    T.StructField("search_text", T.StringType(), True),
])


def dq_schema(spark, d):
    return V.schema_report(tv.products(spark, d), EXPECTED_PRODUCTS, "products")


def load_counts(spark, d):
    return B.load_counts({
        "users": users_dim(spark, d), "clients": clients_dim(spark, d),
        "products": tv.products(spark, d), "events": tv.events(spark, d),
        "campaigns": tv.campaigns(spark, d), "messages": tv.messages(spark, d),
        "friends": tv.friends(spark, d)})


def timing_stats(spark, d):
    e = tv.events(spark, d)
    rows = e.select(F.col("event_type").alias("query_name"),
                    F.col("event_id").cast("int").alias("run_number"),
                    F.col("price").alias("execution_time_ms"),
                    F.lit("events").alias("database"))
    return B.timing_stats(rows)


def incremental_upsert(spark, d):
    from socialcart.streaming.incremental import incremental_upsert as upsert

    rows = tv.messages(spark, d).select(
        (F.col("row_id") / 2).cast("bigint").alias("message_id"),
        F.col("row_id").alias("ord"), "campaign_id", "message_type", "user_id", "is_purchased")
    return upsert(spark, rows, ["message_id"], "ord")


QUERIES = {
    "clean_missing": _clean_one("status"),
    "clean_boolean": _clean_one("is_purchased"),
    "clean_datetime": _clean_one("sent_at"),
    "clean_integer": _clean_one("id"),
    "clean_integer_compat": _clean_one("id", compat=True),
    "clean_price": _clean_one("price"),
    "clean_row": clean_row,
    "typed_messages": typed_messages,
    "typed_campaigns": typed_campaigns,
    "typed_events": typed_events,
    "messages_nested_roundtrip": messages_nested_roundtrip,
    "product_search_text": product_search_text,
    "users_dim": users_dim,
    "clients_dim": clients_dim,
    "message_only_clients": message_only_clients,
    "products_dim": products_dim,
    "first_purchase": first_purchase,
    "client_device": client_device,
    "client_device_first": client_device_first,
    "has_client_edges": has_client_edges,
    "graph_products": graph_products,
    "graph_categories": graph_categories,
    "in_category_edges": in_category_edges,
    "event_edges": event_edges,
    "message_upsert": message_upsert,
    "campaign_nodes": campaign_nodes,
    "friend_of_edges": friend_of_edges,
    "campaign_helper_edges": campaign_helper_edges,
    "helper_counts": helper_counts,
    "q1_graph": q1_graph,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_foreign_key": dq_foreign_key,
    "dq_schema": dq_schema,
    "load_counts": load_counts,
    "timing_stats": timing_stats,
    "incremental_upsert": incremental_upsert,
    "q3_graph_search": q3_graph_search,
}
