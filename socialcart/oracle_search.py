"""DuckDB SQL for the queries of the search indexes: no index, every text is
split and compared."""

from __future__ import annotations

from socialcart.sources.testviews import sql_with

_TOKENS = "unnest(regexp_extract_all(lower(coalesce({}, '')), '[a-z0-9]+'))"
_BENCHMARK = f"SELECT DISTINCT keyword FROM (SELECT {_TOKENS.format('text')} AS keyword FROM benchmark)"


def _bm25(tf: str, length: str, df: str, n: str, mean: str) -> str:
    return (f"round(ln(1.0 + ({n} - {df} + 0.5) / ({df} + 0.5)) * {tf} * 2.2"
            f" / ({tf} + 1.2 * (1 - 0.75 + 0.75 * {length} / {mean})), 6)")


def _products(score: str, fields: tuple[str, ...]) -> str:
    from socialcart.oracle_sql import q2_sql

    words = " UNION ALL ".join(f"SELECT product_id, {_TOKENS.format(f)} AS token FROM products_v" for f in fields)
    value = "CAST(h.tf AS DOUBLE)" if score == "tf" else _bm25("h.tf", "l.n", "f.df", "c.n_docs", "c.mean")
    return q2_sql() + f""",
wanted AS (
    SELECT DISTINCT {_TOKENS.format('category_code')} AS keyword FROM placed JOIN products_v USING (product_id)
    UNION {_BENCHMARK}),
words AS ({words}),
lengths AS (SELECT product_id, count(token) AS n FROM products_v LEFT JOIN words USING (product_id) GROUP BY product_id),
corpus AS (SELECT count(*) AS n_docs, avg(n) AS mean FROM lengths),
hits AS (SELECT keyword, product_id, count(*) AS tf FROM words JOIN wanted ON keyword = token GROUP BY ALL),
dfs AS (SELECT keyword, count(*) AS df FROM hits GROUP BY keyword)
SELECT h.keyword, h.product_id, {value} AS text_score
FROM hits h JOIN lengths l USING (product_id) JOIN dfs f USING (keyword), corpus c"""


DOCS = f"""
WITH wanted AS (SELECT keyword FROM ({_BENCHMARK}) WHERE length(keyword) >= 3),
words AS (SELECT doc_id, {_TOKENS.format('text')} AS token FROM documents),
lengths AS (SELECT doc_id, count(token) AS n FROM documents LEFT JOIN words USING (doc_id) GROUP BY doc_id),
corpus AS (SELECT count(*) AS n_docs, avg(n) AS mean FROM lengths),
hits AS (SELECT keyword, doc_id, count(*) AS tf FROM words JOIN wanted ON keyword = token GROUP BY ALL),
dfs AS (SELECT keyword, count(*) AS df FROM hits GROUP BY keyword),
scored AS (
    SELECT h.keyword, h.doc_id, {_bm25('h.tf', 'l.n', 'f.df', 'c.n_docs', 'c.mean')} AS text_score
    FROM hits h JOIN lengths l USING (doc_id) JOIN dfs f USING (keyword), corpus c)
SELECT * FROM scored
QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY text_score DESC, doc_id) <= 20"""

GRAMS = sql_with("products_v") + f""",
wanted AS ({_BENCHMARK} UNION SELECT DISTINCT {_TOKENS.format('brand')} FROM products_v)
SELECT keyword, product_id FROM wanted, products_v WHERE contains(lower(coalesce(category_code, '')), keyword)"""


def oracle() -> dict[str, str]:
    both = ("category_code", "brand")
    return {"q3_index_search": _products("tf", both), "q3_index_bm25": _products("bm25", both),
            "q3_index_field": _products("bm25", both[:1]), "doc_index_search": DOCS, "q3_gram_search": GRAMS}
