"""Registered queries of the search indexes (Q3-e, Q3-f, Q3-h)."""

from __future__ import annotations

import uuid

from socialcart.operators.gram_index import build_gram_index
from socialcart.operators.token_index import build_index
from socialcart.plans import recommend as q2
from socialcart.plans import search as q3
from socialcart.session import checkpoint_root
from socialcart.sources import testviews as tv


def _folder(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def _benchmark_tokens(spark, d, least: int = 1):
    return q3.all_tokens(spark.read.parquet(f"{d}/benchmark.parquet"), "text", least)


def _index_search(score: str, field: str = ""):
    """All tokens of the recommended products' codes and of the benchmark
    items, searched in the product index."""
    def run(spark, d):
        p = tv.products(spark, d)
        recs = q2.recommendations(tv.events(spark, d), tv.friends(spark, d), p)
        keywords = q3.all_tokens(recs, "category_code", 1).unionByName(_benchmark_tokens(spark, d)).distinct()
        index = build_index(p, "product_id", ["category_code", "brand"], _folder(spark, "token-index"), buckets=16)
        return index.search(keywords, field, score, id_name="product_id")
    return run


def doc_index_search(spark, d):
    """The 20 best documents by BM25 for each token of the benchmark."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    index = build_index(docs, "doc_id", ["text"], _folder(spark, "token-index"), buckets=16)
    return index.search(_benchmark_tokens(spark, d, 3), "text", "bm25", per_keyword=20, id_name="doc_id")


def q3_gram_search(spark, d):
    """Products whose code contains a token of the benchmark or of the brands,
    whatever its length."""
    p = tv.products(spark, d)
    keywords = _benchmark_tokens(spark, d).unionByName(q3.all_tokens(p, "brand", 1)).distinct()
    return build_gram_index(p, "product_id", "category_code", _folder(spark, "gram-index"), buckets=16).search(keywords, "product_id")


QUERIES = {
    "q3_index_search": _index_search("tf"),
    "q3_index_bm25": _index_search("bm25"),
    "q3_index_field": _index_search("bm25", "category_code"),
    "doc_index_search": doc_index_search,
    "q3_gram_search": q3_gram_search,
}
