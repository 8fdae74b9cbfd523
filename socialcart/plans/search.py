"""Q3 — keywords from the recommended products, then product text search.

* keywords: the 3 most frequent tokens (length > 2) in the category codes of
  the products Q2 recommends; ties by token.  ``distinct_products=True``
  counts each recommended product once (relational form); ``False`` counts
  per recommendation row (document and graph Python form).
* token search: products whose text contains the keyword as a whole token.
  The ≤ 3 keywords become one token-bounded regex (scalar subquery) and
  only their occurrences are extracted from each text — one pass over the
  products, no join and no per-pair test.
* score: ``tf`` (occurrences of the keyword among the product's tokens) or
  ``bm25`` (Robertson & Zaragoza 2009; k1 = 1.2, b = 0.75, df and average
  length from aggregates over all products).
* caps: ``per_keyword`` (top rows per keyword, document/graph form) and/or
  ``overall`` (top rows in output order, relational form).
* substring search: case-insensitive ``contains`` on the category code,
  score 0.0, first ``per_keyword`` products by id (document/graph fallback);
  ``fallback_search`` switches to it when the token search found nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from socialcart.functions.text import DOT_SPLIT, MIN_TOKEN_LEN, TOKEN_RE, WORD_SPLIT, keep_token, tokens  # noqa: F401

# BM25 parameters.
BM25_K1 = 1.2
BM25_B = 0.75
RESULT_COLUMNS = ["keyword", "product_id", "category_code", "brand", "text_score"]


def keywords(recs: DataFrame, products: DataFrame | None = None, n: int = 3,
             distinct_products: bool = True, splitter: str = WORD_SPLIT) -> DataFrame:
    """Q3-a…d: ``(keyword, frequency)``, at most ``n`` rows.

    ``recs`` are Q2 rows.  When they already carry ``category_code`` (Q2-g
    attached it) no product lookup is needed: the code depends on the
    product alone, so distinct (product, code) pairs are the distinct
    products.  Otherwise the codes come from ``products`` semi-joined to the
    (≤ targets × k) recommended ids."""
    if "category_code" in recs.columns:
        rows = recs.select("product_id", "category_code")
        codes = rows.distinct() if distinct_products else rows
    else:
        ids = F.broadcast(recs.select("product_id").distinct())
        codes = products.join(ids, "product_id", "left_semi").select("product_id", "category_code")
        if not distinct_products:
            codes = recs.select("product_id").join(codes, "product_id", "left")
    return top_tokens(codes, "category_code", n, splitter)


def top_tokens(df: DataFrame, text_col: str, n: int = 3, splitter: str = WORD_SPLIT) -> DataFrame:
    """``(keyword, frequency)`` of the ``n`` most frequent tokens of
    ``text_col`` (length > 2; ties by token)."""
    toks = df.select(F.explode(tokens(F.col(text_col), splitter)).alias("keyword"))
    return (toks.where(keep_token(F.col("keyword")))
            .groupBy("keyword").agg(F.count(F.lit(1)).alias("frequency"))
            .orderBy(F.col("frequency").desc(), F.col("keyword").asc())
            .limit(n))


def all_tokens(df: DataFrame, text_col: str, least: int = MIN_TOKEN_LEN) -> DataFrame:
    """``(keyword)``: every distinct token of ``text_col`` of at least
    ``least`` characters."""
    toks = df.select(F.explode(tokens(F.col(text_col))).alias("keyword"))
    return toks.where(keep_token(F.col("keyword"), least)).distinct()


def _lowered(text_cols: list[str]):
    """Lower-cased text of the columns; several columns are joined with a
    space (a separator), which pools their tokens."""
    if len(text_cols) == 1:
        return F.lower(F.coalesce(F.col(text_cols[0]), F.lit("")))
    return F.lower(F.concat_ws(" ", *[F.col(c) for c in text_cols]))


def keyword_pattern(kw: DataFrame):
    """Scalar-subquery column: one regex matching any keyword as a whole
    token, ``(?<![a-z0-9])(?:k1|k2|…)(?![a-z0-9])`` — an occurrence bounded
    by non-alphanumerics is exactly a token equal to the keyword.  Keywords
    with other characters can never equal a token and are left out; NULL
    when no keyword remains.  The keyword side is ≤ n rows."""
    ks = F.collect_set("keyword")
    return (kw.where(F.col("keyword").rlike("^[a-z0-9]+$"))
            .select(F.when(F.size(ks) > 0, F.concat(
                F.lit("(?<![a-z0-9])(?:"), F.array_join(ks, "|"), F.lit(")(?![a-z0-9])"))))
            .scalar())


def token_hits(kw: DataFrame, docs: DataFrame, id_col: str, text_cols: list[str],
               carry: tuple[str, ...] = (), with_len: bool = False) -> DataFrame:
    """``(keyword, <id_col>, *carry, [dl,] tf)`` for every document containing
    a keyword as a token of any of ``text_cols`` (tokens of all columns
    pooled); ``dl`` is the document's token count.

    One pass over the documents: the keywords (≤ n rows, a proven bound)
    become one regex through a scalar subquery, and only the keyword
    occurrences of each whole text are extracted, so no per-token rows or
    token arrays are built.  Counts use map-side partial aggregation."""
    pat = keyword_pattern(kw)
    base = docs.select(id_col, *carry, _lowered(text_cols).alias("_txt"))
    keep = [id_col, *carry]
    if with_len:
        base = base.withColumn("dl", F.regexp_count("_txt", F.lit(TOKEN_RE)))
        keep.append("dl")
    exploded = base.select(*keep, F.explode(F.regexp_extract_all("_txt", pat, F.lit(0)))
                           .alias("keyword"))
    return exploded.groupBy("keyword", *keep).agg(F.count(F.lit(1)).alias("tf"))


def bm25_scores(hits: DataFrame, docs: DataFrame, text_cols: list[str]) -> DataFrame:
    """Add ``bm25`` to token hits.  Corpus size and mean length are a one-row
    aggregate and document frequencies a per-keyword aggregate; both are
    joined on keys."""
    corpus = (docs.select(F.regexp_count(_lowered(text_cols), F.lit(TOKEN_RE)).alias("dl"))
              .agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl")))
    n_docs = corpus.select("n_docs").scalar()   # one-row aggregates as scalar subqueries
    avgdl = corpus.select("avgdl").scalar()
    df_ = hits.groupBy("keyword").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / avgdl)
    return (hits.join(F.broadcast(df_), "keyword")   # ≤ n keywords
            .withColumn("bm25", idf * F.col("tf") * (BM25_K1 + 1) / norm)
            .drop("df"))


def _cap(rows: DataFrame, per_keyword: int | None, overall: int | None,
         id_col: str = "product_id") -> DataFrame:
    order = [F.col("text_score").desc(), F.col(id_col).asc()]
    if per_keyword:
        w = Window.partitionBy("keyword").orderBy(*order)
        rows = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_keyword).drop("_r")
    if overall:
        return rows.orderBy(F.col("keyword").asc(), *order).limit(overall)  # TakeOrderedAndProject
    if per_keyword:
        # ≤ per_keyword × keywords rows: one sorted partition, no range-partitioning pass
        return rows.coalesce(1).sortWithinPartitions(F.col("keyword").asc(), *order)
    return rows.orderBy(F.col("keyword").asc(), *order)


def token_search(kw: DataFrame, products: DataFrame, fields: tuple[str, ...] = ("category_code",),
                 score: str = "tf", per_keyword: int | None = None,
                 overall: int | None = 60) -> DataFrame:
    """Q3-e/h/i/k over products."""
    hits = token_hits(kw, products, "product_id", list(fields), ("category_code", "brand"),
                      with_len=(score == "bm25"))
    if score == "bm25":
        hits = bm25_scores(hits, products, list(fields)).withColumn(
            "text_score", F.round("bm25", 6))
    else:
        hits = hits.withColumn("text_score", F.col("tf").cast("double"))
    return _cap(hits.select(*RESULT_COLUMNS), per_keyword, overall)


def substring_search(kw: DataFrame, products: DataFrame, per_keyword: int | None = 20) -> DataFrame:
    """Q3-f: case-insensitive substring of the category code, score 0.0.
    The ≤ n keywords become one array value (scalar subquery); each product
    row keeps the keywords its code contains — one pass, no join."""
    kw_arr = kw.select(F.collect_set("keyword")).scalar()
    code = F.lower(F.coalesce(F.col("category_code"), F.lit("")))
    rows = (products.withColumn("_kw", kw_arr)
            .select("product_id", "category_code", "brand",
                    F.explode(F.filter("_kw", lambda k: code.contains(k))).alias("keyword"))
            .select("keyword", "product_id", "category_code", "brand",
                    F.lit(0.0).alias("text_score")))
    return _cap(rows, per_keyword, None)


def fallback_search(kw: DataFrame, products: DataFrame, per_keyword: int = 20,
                    fields: tuple[str, ...] = ("category_code",)) -> DataFrame:
    """Q3-g: token hits when there are any, else substring hits."""
    tok = token_search(kw, products, fields, "tf", per_keyword, None)
    sub = substring_search(kw, products, per_keyword).where(~tok.exists())
    # both sides are capped per keyword: a small, bounded result
    return tok.unionByName(sub).coalesce(1).sortWithinPartitions(
        F.col("keyword").asc(), F.col("text_score").desc(), F.col("product_id").asc())


def graph_token_search(kw: DataFrame, categories: DataFrame, in_category: DataFrame,
                       product_nodes: DataFrame, per_keyword: int = 20) -> DataFrame:
    """Q3 graph form: keyword hits on *category* nodes, reached products over
    IN_CATEGORY edges, best ``per_keyword`` rows per keyword by (score desc,
    product), then one row per (keyword, product) — the first after the cap
    (Q3-i then Q3-j, in that order)."""
    hits = token_hits(kw, categories, "category_id", ["category_code"], ("category_code",))
    rows = (hits.join(in_category, "category_id")
            .join(product_nodes.select("product_id", "brand"), "product_id")
            .select("keyword", "product_id", "category_code", "brand",
                    F.col("tf").cast("double").alias("text_score")))
    order = [F.col("text_score").desc(), F.col("product_id").asc(), F.col("category_code").asc()]
    w = Window.partitionBy("keyword").orderBy(*order)
    capped = rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_keyword)
    first = Window.partitionBy("keyword", "product_id").orderBy("_r")
    deduped = (capped.withColumn("_f", F.row_number().over(first)).where(F.col("_f") == 1)
               .drop("_r", "_f"))
    # ≤ per_keyword × keywords rows
    return deduped.coalesce(1).sortWithinPartitions(F.col("keyword").asc(), *order)


def document_search(kw: DataFrame, docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", per_keyword: int | None = 20) -> DataFrame:
    """Token search over whole document texts: ``(keyword, <id_col>,
    text_score=tf)``, best ``per_keyword`` documents per keyword."""
    hits = token_hits(kw, docs, id_col, [text_col])
    rows = hits.select("keyword", id_col, F.col("tf").cast("double").alias("text_score"))
    return _cap(rows, per_keyword, None, id_col)


def bm25_idf(n_docs: int, df: int) -> float:
    """Reference value of the idf term (used by tests)."""
    return math.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))
