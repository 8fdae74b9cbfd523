"""Registered queries of loading: keyed upserts and whole snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from socialcart import registry_model as R
from socialcart.plans import snapshot as S
from socialcart.plans import stats as B
from socialcart.session import checkpoint_root
from socialcart.sources import testviews as tv
from socialcart.streaming.bucket_table import BucketTable, stream_upserts
from socialcart.streaming.helper_deltas import helper_edges_by_deltas
from socialcart.streaming.incremental import write_chunks


def bucket_upsert(spark, d):
    """Message versions as a stream of chunks, then a batch that arrives late
    (old versions) and one that arrives again."""
    rows = tv.messages(spark, d).select(F.expr("row_id div 2").alias("message_id"), F.col("row_id").alias("ord"),
                                        "campaign_id", "message_type", "user_id", "is_purchased")
    base = f"{checkpoint_root(spark)}/bucket-upsert-{uuid.uuid4().hex}"
    # newest first, so later chunks are late as well
    write_chunks(rows.orderBy(F.col("ord").desc()), f"{base}/source", max(1, rows.count() // 4))
    table = BucketTable(spark, f"{base}/table", rows.schema, ["message_id"], "ord", buckets=8)
    stream_upserts(table, f"{base}/source", files_per_batch=2)
    applied = table.upsert(rows.where("ord % 2 = 0"), 1_000)
    assert table.upsert(rows.limit(0), 1_000) == applied
    return table.read()


def snapshot_counts(spark, d):
    """The seven tables published as one set, counted from the set."""
    root = f"{checkpoint_root(spark)}/snapshot-{uuid.uuid4().hex}"
    tables = {"users": R.users_dim(spark, d), "clients": R.clients_dim(spark, d), "products": tv.products(spark, d),
              "events": tv.events(spark, d), "campaigns": tv.campaigns(spark, d), "messages": tv.messages(spark, d),
              "friends": tv.friends(spark, d)}
    S.publish(spark, root, tables, {
        "clients_pk": S.unique("clients", ["client_id"]), "users_pk": S.unique("users", ["user_id"]),
        "products_pk": S.unique("products", ["product_id"]), "friends_pk": S.unique("friends", ["user_id", "friend_id"]),
        "messages_not_null": S.not_null("messages", ["row_id", "user_id", "campaign_id", "message_type"]),
        "messages_user": S.references("messages", ["user_id"], "users"),
        "friends_user": S.references("friends", ["user_id"], "users")})
    return B.load_counts(S.open_snapshot(spark, root))


def helper_deltas(spark, d):
    """Two versions of most messages, the later ones with other purchase
    flags, users and campaigns, applied in batches in no order."""
    versions = tv.messages(spark, d).withColumn("message_id", F.expr("row_id div 2")).withColumn("ord", F.col("row_id"))
    return helper_edges_by_deltas(versions, tv.clients(spark, d), batches=2)


QUERIES = {"helper_deltas": helper_deltas, "bucket_upsert": bucket_upsert, "snapshot_counts": snapshot_counts}
