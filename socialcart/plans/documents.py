"""Document form (C18-C20, D06, D07) and the analyses that read it nested.

* message documents: ``campaign_ref`` (id, type, key) and ``engagement`` (8
  flags, 10 times) as structs.  Q1 reads ``campaign_ref.*`` ids, ``user_id``
  and ``engagement.is_purchased``; the scan holds only these leaves.
* engagement steps: the flags and first times of a document as an array of
  eight structs, for questions that treat the steps alike.
* event documents: a user's events in one array of at most
  ``EVENTS_PER_DOCUMENT`` structs, each with its product embedded (bucket
  pattern).  The bound holds whatever a user's number of events, because a
  document covers a range of that many event ids.  Q2 reads two leaves of the
  array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialcart.functions import typing as TY
from socialcart.plans import campaigns as q1
from socialcart.plans import recommend as q2

EVENTS_PER_DOCUMENT = 64

# The steps of a message, the flag of each and its (first) time.
STEPS = {
    "opened": "opened_first_time_at", "clicked": "clicked_first_time_at", "unsubscribed": "unsubscribed_at",
    "hard_bounced": "hard_bounced_at", "soft_bounced": "soft_bounced_at", "complained": "complained_at",
    "blocked": "blocked_at", "purchased": "purchased_at",
}
# The ten times and eight flags of ``engagement``.
ENGAGEMENT = tuple(f"is_{s}" for s in STEPS) + (
    "opened_first_time_at", "opened_last_time_at", "clicked_first_time_at", "clicked_last_time_at", "unsubscribed_at",
    "hard_bounced_at", "soft_bounced_at", "complained_at", "blocked_at", "purchased_at")


def message_documents(messages: DataFrame) -> DataFrame:
    """Typed messages with ``campaign_ref`` and ``engagement`` nested."""
    ref = F.struct("campaign_id", F.col("message_type").alias("campaign_type"),
                   TY.composite_key(F.col("campaign_id"), F.col("message_type")).alias("campaign_key"))
    held = [c for c in ENGAGEMENT if c in messages.columns]
    moved = {"campaign_id", "message_type", *held}
    return messages.select(*[c for c in messages.columns if c not in moved], ref.alias("campaign_ref"),
                           F.struct(*held).alias("engagement"))


def campaign_conversion(documents: DataFrame, campaigns: DataFrame, friends: DataFrame, top_n: int | None = 20) -> DataFrame:
    """Q1 in its document form: shares of nothing are 0, halves round to
    even, remaining ties by the campaign id as a number, descending."""
    messages = documents.select(
        F.col("campaign_ref.campaign_id").alias("campaign_id"), F.col("campaign_ref.campaign_type").alias("message_type"),
        "user_id", F.col("engagement.is_purchased").alias("is_purchased"))
    return q1.campaign_conversion(messages, campaigns, friends, top_n, zero_as_null=False, rounding="half_even",
                                  tie_break="numeric_desc")


def engagement_steps(documents: DataFrame) -> DataFrame:
    """Documents with ``steps``: array of (step, happened, at), eight long."""
    steps = [F.struct(F.lit(s).alias("step"), F.col(f"engagement.is_{s}").alias("happened"), F.col(f"engagement.{t}").alias("at"))
             for s, t in STEPS.items()]
    return documents.withColumn("steps", F.array(*steps))


def engagement_funnel(documents: DataFrame) -> DataFrame:
    """Per campaign key and step: messages in which it happened, in how many
    of those a purchase happened too, and its first time."""
    rows = engagement_steps(documents).select(
        F.col("campaign_ref.campaign_key").alias("campaign_key"),
        F.exists("steps", lambda s: (s["step"] == "purchased") & s["happened"]).alias("bought"),
        F.explode(F.filter("steps", lambda s: s["happened"])).alias("s"))
    return rows.groupBy("campaign_key", F.col("s.step").alias("step")).agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("bought")).alias("with_purchase"), F.min("s.at").alias("first_at"))


def event_documents(events: DataFrame, per_document: int = EVENTS_PER_DOCUMENT) -> DataFrame:
    """``(user_id, part, events)``: a user's events whose ids share a range
    of ``per_document``, in id order, each with its product embedded."""
    product = F.struct("product_id", "category_id", "category_code", "brand").alias("product")
    event = F.struct("event_id", "event_time", "event_type", "price", product)
    part = F.floor(F.col("event_id") / F.lit(per_document)).alias("part")
    return (events.groupBy("user_id", part).agg(F.collect_list(event).alias("events"))
            .withColumn("events", F.array_sort("events", lambda a, b: (a["event_id"] - b["event_id"]).cast("int"))))


def recommendations(documents: DataFrame, friends: DataFrame, products: DataFrame, **options) -> DataFrame:
    """Q2 over event documents; only the type and the product id of each
    event are read."""
    pairs = F.arrays_zip(F.col("events.event_type").alias("event_type"), F.col("events.product.product_id").alias("product_id"))
    rows = documents.select("user_id", F.explode(pairs).alias("e"))
    events = rows.select("user_id", F.col("e.event_type").alias("event_type"), F.col("e.product_id").alias("product_id"))
    return q2.recommendations(events, friends, products, **options)
