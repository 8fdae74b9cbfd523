"""Document form: what the nested analyses read, and the bound on arrays."""

import re

from pyspark.sql import functions as F

from socialcart import registry_documents as R
from socialcart.plans import documents as D
from socialcart.sources import testviews as tv
from tests.conftest import SF_SMALL


def read_schema(df):
    """Schemas of the scans, whole."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    return re.findall(r"ReadSchema: (\S+)", plan)


def test_q1_reads_only_the_leaves_it_uses(spark):
    docs = R.message_documents(spark, SF_SMALL)
    friends = tv.friends(spark, SF_SMALL).select(F.col("user_id").cast("string"), F.col("friend_id").cast("string"))
    schemas = read_schema(D.campaign_conversion(docs, tv.campaigns(spark, SF_SMALL), friends))
    nested = [s for s in schemas if "campaign_ref" in s]
    assert nested and all("engagement:struct<is_purchased:boolean>" in s and "campaign_key" not in s and "opened" not in s
                          for s in nested)


def test_message_documents_hold_every_field(spark):
    docs = R.message_documents(spark, SF_SMALL)
    assert docs.schema["engagement"].dataType.names == list(D.ENGAGEMENT) and len(D.ENGAGEMENT) == 18
    assert docs.schema["campaign_ref"].dataType.names == ["campaign_id", "campaign_type", "campaign_key"]
    assert len(R.messages_document_form(spark, SF_SMALL).columns) == 35
    steps = D.engagement_steps(docs).select(F.size("steps").alias("n")).distinct().collect()
    assert [r.n for r in steps] == [8]


def test_event_documents_are_bounded_and_pruned(spark):
    # one user holds every event
    events = tv.raw_events(spark, SF_SMALL).withColumn("user_id", F.lit(1))
    docs = R.stored(D.event_documents(events, 16), "event-documents")
    sizes = docs.agg(F.max(F.size("events")).alias("most"), F.sum(F.size("events")).alias("n")).first()
    assert sizes.most <= 16 and sizes.n == events.count()
    ids = docs.select(F.transform("events", lambda e: e["event_id"]).alias("i")).collect()
    assert all(r.i == sorted(r.i) for r in ids)
    recs = D.recommendations(docs, tv.friends(spark, SF_SMALL), tv.products(spark, SF_SMALL))
    nested = [s for s in read_schema(recs) if "array<struct" in s]
    assert all("price" not in s and "event_time" not in s and "brand" not in s for s in nested)


def test_cleaning_is_dealt_over_all_cores(spark):
    from socialcart.sources import extracts as X

    for extract in (X.message_extract, X.campaign_extract):
        assert extract(spark, SF_SMALL).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
