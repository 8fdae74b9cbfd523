"""Registered queries of the ingest: raw CSV files derived from the test
tables (messages, campaigns and friendships in several files, with over-long,
short and blank rows), ingested by the library."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialcart.session import checkpoint_root
from socialcart.sources import testviews as tv
from socialcart.sources.ingest import ingest

LONG_EVERY = 19    # key % 19 == 0 → the row has a field too many
SHORT_EVERY = 23   # key % 23 == 0 → the row lacks its last field
MESSAGE_FILES = 4
MESSAGE_COLUMNS = ["id", "message_type", "is_purchased", "sent_at", "price", "status"]
FRIEND_COLUMNS = ["friend1", "friend2"]


def _lines(rows: DataFrame, key: str, extract, columns: list[str]) -> DataFrame:
    """(extract, n, value): the CSV lines of ``rows`` and a header per file."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    line = (F.when(F.col(key) % LONG_EVERY == 0, F.concat_ws(",", *text, F.lit("extra")))
            .when(F.col(key) % SHORT_EVERY == 0, F.concat_ws(",", *text[:-1])).otherwise(F.concat_ws(",", *text)))
    body = rows.select(extract.alias("extract"), F.col(key).alias("n"), line.alias("value"))
    head = body.select("extract").distinct().select("extract", F.lit(-1).cast("long").alias("n"), F.lit(",".join(columns)).alias("value"))
    return head.unionByName(body)


def _raw_files(spark, d) -> str:
    orders = spark.read.parquet(f"{d}/orders.parquet")
    keyed = orders.select("o_orderkey", *tv.raw_message_columns(orders).values())
    names = F.concat(F.lit("messages_"), (F.col("o_orderkey") % MESSAGE_FILES).cast("string"))
    friends = tv.friends_raw(spark, d).withColumn("key", F.col("friend1") * 1000 + F.col("friend2"))
    parts = [_lines(keyed, "o_orderkey", names, MESSAGE_COLUMNS),
             _lines(friends, "key", F.concat(F.lit("friends_"), (F.col("friend1") % 2).cast("string")), FRIEND_COLUMNS)]
    path = f"{checkpoint_root(spark)}/raw-csv-{uuid.uuid4().hex}"
    # one column without quoting: lines are written as they are
    (reduce(DataFrame.unionByName, parts).repartition("extract").sortWithinPartitions("extract", "n").select("extract", "value")
     .write.partitionBy("extract").option("quote", "").option("sep", "\u0001")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _ingested(spark, d):
    return ingest(spark, _raw_files(spark, d), f"{checkpoint_root(spark)}/ingest-{uuid.uuid4().hex}")


def _extract(file: str = "file"):
    return F.regexp_extract(file, "extract=([^/]+)/", 1).alias("extract")


def ingest_kept(spark, d):
    return _ingested(spark, d).kept(MESSAGE_COLUMNS).select(_extract(), *MESSAGE_COLUMNS)


def ingest_metrics(spark, d):
    return _ingested(spark, d).metrics().select(_extract(), "kept", "skipped_empty", "skipped_malformed")


def ingest_rejects(spark, d):
    return _ingested(spark, d).rejects().select(_extract(), "raw", "reason")


QUERIES = {"ingest_kept": ingest_kept, "ingest_metrics": ingest_metrics, "ingest_rejects": ingest_rejects}
