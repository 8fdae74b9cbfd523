"""Registered queries: name → callable(spark, sf_dir) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialcart.plans import campaigns as q1
from socialcart.plans import recommend as q2
from socialcart.plans import search as q3
from socialcart.sources import testviews as tv

Query = Callable[[SparkSession, str], DataFrame]


def _q1_campaign_conversion(spark, d):
    return q1.campaign_conversion(tv.messages(spark, d), tv.campaigns(spark, d), tv.friends(spark, d))


def _q1_zero_share(spark, d):
    return q1.campaign_conversion(tv.messages(spark, d), tv.campaigns(spark, d),
                                  tv.friends(spark, d), zero_as_null=False)


def _q1_document(spark, d):
    return q1.campaign_conversion(tv.messages(spark, d), tv.campaigns(spark, d),
                                  tv.friends(spark, d), zero_as_null=False,
                                  rounding="half_even", tie_break="numeric_desc")


def hub_friends(spark, d):
    """The friendships and a hub: the first customer is a friend of all."""
    c = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey")
    first = c.agg(F.min("c_custkey")).first()[0]
    # an expression over the row, so the hub's edges are joined like any others
    hub = F.lit(first) + F.col("c_custkey") % 1
    return tv.friends(spark, d).unionByName(c.select(hub.alias("user_id"), F.col("c_custkey").alias("friend_id")))


def _q1_hub(spark, d):
    return q1.campaign_conversion(tv.messages(spark, d), tv.campaigns(spark, d), hub_friends(spark, d), by_degree=True)


def _campaign_user_stats(spark, d):
    return q1.campaign_user_stats(tv.messages(spark, d), tv.campaigns(spark, d))


def _social_purchasers(spark, d):
    messages = tv.messages(spark, d)
    cu = q1.campaign_users(messages)
    known = tv.campaigns(spark, d).selectExpr("campaign_id", "campaign_type AS message_type")
    cu = cu.join(known, q1.CAMPAIGN_KEY, "left_semi")
    return q1.social_purchasers(cu, tv.friends(spark, d))


def _friends_edges(spark, d):
    return tv.friends(spark, d)


def _q2(**kw):
    def run(spark, d):
        return q2.recommendations(tv.events(spark, d), tv.friends(spark, d),
                                  tv.products(spark, d), **kw)
    return run


def _q2_graph(spark, d):
    from socialcart.operators import graph as G

    e = tv.raw_events(spark, d)
    cats, pn = G.category_nodes(e, "event_id"), G.product_nodes(e, "event_id")
    attrs = G.product_attributes(pn, G.in_category_edges(e, pn, cats), cats)
    return q2.recommendations(tv.events(spark, d), tv.friends(spark, d), attrs,
                              activity_types=q2.REC_TYPES, own_types=q2.REC_TYPES)


def _top_active_users(spark, d):
    return q2.top_active_users(tv.events(spark, d))


def _top_users_threshold(spark, d):
    from socialcart.operators.threshold_topk import top_counts

    return top_counts(tv.events(spark, d), "user_id", 100)


def _recs(spark, d):
    return q2.recommendations(tv.events(spark, d), tv.friends(spark, d), tv.products(spark, d))


def _q3_keywords(spark, d):
    return q3.keywords(_recs(spark, d), tv.products(spark, d))


def _q3_keywords_rows(spark, d):
    return q3.keywords(_recs(spark, d), tv.products(spark, d), distinct_products=False)


def _q3_keywords_dot(spark, d):
    return q3.keywords(_recs(spark, d), tv.products(spark, d), splitter=q3.DOT_SPLIT)


def _q3_token_search(spark, d):
    p = tv.products(spark, d)
    return q3.token_search(q3.keywords(_recs(spark, d), p), p)


def _q3_token_search_top20(spark, d):
    p = tv.products(spark, d)
    kw = q3.keywords(_recs(spark, d), p, distinct_products=False)
    return q3.token_search(kw, p, fields=("category_code", "brand"), per_keyword=20, overall=None)


def _q3_bm25(spark, d):
    p = tv.products(spark, d)
    return q3.token_search(q3.keywords(_recs(spark, d), p), p, score="bm25")


def _q3_substring_search(spark, d):
    p = tv.products(spark, d)
    return q3.substring_search(q3.keywords(_recs(spark, d), p, distinct_products=False), p)


def _q3_fallback(spark, d):
    p = tv.products(spark, d)
    return q3.fallback_search(q3.keywords(_recs(spark, d), p, distinct_products=False), p)


def _doc_token_search(spark, d):
    bench = spark.read.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return q3.document_search(q3.top_tokens(bench, "text"), docs)


def queries() -> dict[str, Query]:
    from socialcart.registry_checks import QUERIES as check_queries
    from socialcart.registry_documents import QUERIES as document_queries
    from socialcart.registry_ingest import QUERIES as ingest_queries
    from socialcart.registry_load import QUERIES as load_queries
    from socialcart.registry_model import QUERIES as model_queries
    from socialcart.registry_search import QUERIES as search_queries

    return {**_analysis_queries(), **model_queries, **search_queries, **document_queries, **ingest_queries,
            **load_queries, **check_queries}


def _analysis_queries() -> dict[str, Query]:
    return {
        "q1_campaign_conversion": _q1_campaign_conversion,
        "q1_zero_share": _q1_zero_share,
        "q1_document": _q1_document,
        "q1_hub": _q1_hub,
        "campaign_user_stats": _campaign_user_stats,
        "social_purchasers": _social_purchasers,
        "friends_edges": _friends_edges,
        "top_active_users": _top_active_users,
        "top_users_threshold": _top_users_threshold,
        "q2_recommendations": _q2(),
        "q2_array_topk": _q2(method="array"),
        "q2_graph": _q2_graph,
        "q2_dedupe_edges": _q2(dedupe_edges=True),
        "q3_keywords": _q3_keywords,
        "q3_keywords_rows": _q3_keywords_rows,
        "q3_keywords_dot": _q3_keywords_dot,
        "q3_token_search": _q3_token_search,
        "q3_token_search_top20": _q3_token_search_top20,
        "q3_bm25": _q3_bm25,
        "q3_substring_search": _q3_substring_search,
        "q3_fallback": _q3_fallback,
        "doc_token_search": _doc_token_search,
    }
