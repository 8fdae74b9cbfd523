"""Registered queries over the typed extracts and their document form."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from socialcart.functions.clean import clean_frame
from socialcart.plans import documents as D
from socialcart.plans import load as L
from socialcart.session import checkpoint_root
from socialcart.sources import extracts as X
from socialcart.sources import testviews as tv


def stored(df, name: str):
    """``df`` as Parquet in the shared folder, read back."""
    path = f"{checkpoint_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def typed_messages_full(spark, d):
    """Extract, cleaned and stored, then typed: the two steps of a load."""
    return L.typed_messages(stored(clean_frame(X.message_extract(spark, d)), "cleaned-messages"))


def typed_campaigns_full(spark, d):
    return L.typed_campaigns(stored(clean_frame(X.campaign_extract(spark, d)), "cleaned-campaigns"))


def message_documents(spark, d):
    return stored(D.message_documents(typed_messages_full(spark, d)), "message-documents")


def messages_document_form(spark, d):
    """Every field of the message documents, read by its path."""
    docs = message_documents(spark, d)
    return docs.select(*[c for c in docs.columns if c not in ("campaign_ref", "engagement")], "campaign_ref.*", "engagement.*")


def q1_nested(spark, d):
    friends = tv.friends(spark, d).select(F.col("user_id").cast("string"), F.col("friend_id").cast("string"))
    return D.campaign_conversion(message_documents(spark, d), tv.campaigns(spark, d), friends)


def engagement_funnel(spark, d):
    return D.engagement_funnel(message_documents(spark, d))


def q2_nested(spark, d):
    events = stored(D.event_documents(tv.raw_events(spark, d)), "event-documents")
    return D.recommendations(events, tv.friends(spark, d), tv.products(spark, d))


QUERIES = {
    "typed_messages_full": typed_messages_full,
    "typed_campaigns_full": typed_campaigns_full,
    "messages_document_form": messages_document_form,
    "q1_nested": q1_nested,
    "q2_nested": q2_nested,
    "engagement_funnel": engagement_funnel,
}
