"""Registered queries of the constraints over the whole model."""

from __future__ import annotations

from pyspark.sql import functions as F

from socialcart import registry_model as R
from socialcart.operators import constraints as K
from socialcart.plans import load as L
from socialcart.registry_documents import message_documents, typed_campaigns_full
from socialcart.functions import typing as TY
from socialcart.sources import testviews as tv


def dq_foreign_keys(spark, d):
    """All eight keys; users are those with events or purchases, so messages
    and friendships of others are orphans."""
    clients, events = R.clients_dim(spark, d), tv.events(spark, d)
    users = clients.select("user_id").unionByName(events.select("user_id")).dropna().distinct()
    campaigns = tv.campaigns(spark, d).where(F.col("topic").isNotNull())
    return K.foreign_key_counts({"users": users, "clients": clients, "events": events, "products": tv.products(spark, d),
                                 "campaigns": campaigns, "messages": tv.messages(spark, d), "friends": tv.friends(spark, d)})


def dq_validators(spark, d):
    """The seven validators over the document form of the model."""
    text = lambda df, *cols: df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    products = R.products_dim(spark, d)
    products = text(products, "product_id", "category_id", "category_code", "brand")
    events = L.typed_events(text(tv.raw_events(spark, d), "event_time", "event_type", "product_id", "price", "user_id", "user_session"))
    clients = text(R.clients_dim(spark, d), "client_id", "user_id", "user_device_id").join(
        R.clients_dim(spark, d).select(F.col("client_id").cast("string"), "first_purchase_date"), "client_id")
    return K.validate({
        "users": text(R.users_dim(spark, d), "user_id"), "clients": clients,
        "products": products.withColumn("category_search_text", TY.search_text(F.col("category_code"), F.col("brand"))),
        "events": events.join(products, "product_id", "left"), "campaigns": typed_campaigns_full(spark, d),
        "messages": message_documents(spark, d), "friendships": text(tv.friends(spark, d), "user_id", "friend_id")})


QUERIES = {"dq_foreign_keys": dq_foreign_keys, "dq_validators": dq_validators}
