"""Independent SQL (DuckDB dialect) for every registered query.

Each string first defines the adapter views of ``sources.testviews`` as CTEs
over the driver's base tables and then states the query from its definition
(SURVEY §2.5-2.7) in a shape of its own: sets of recipients, buyers and friend
pairs for Q1, one tally of votes for and against each product for Q2.  Full
tie-breaks stand wherever a limit or a rank would leave the result open.
"""

from __future__ import annotations

from socialcart.sources.testviews import SQL_VIEWS, sql_with

# Exact half-up rounding of 100 * a / b to two decimals, as double: integer
# arithmetic, so it agrees digit for digit with Spark's decimal ``round``.
def _pct(a: str, b: str, zero: str = "NULL") -> str:
    return (f"CASE WHEN ({b}) = 0 THEN {zero} ELSE "
            f"CAST((20000 * ({a}) + ({b})) // (2 * ({b})) AS DOUBLE) / 100 END")


# Exact half-even rounding of 100 * a / b to two decimals (document form).
def _pct_even(a: str, b: str) -> str:
    q = f"((10000 * ({a})) // ({b}))"
    r = f"((10000 * ({a})) % ({b}))"
    return (f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST(CASE WHEN 2 * {r} > ({b}) THEN {q} + 1 "
            f"WHEN 2 * {r} < ({b}) THEN {q} ELSE {q} + ({q} % 2) END AS DOUBLE) / 100 END")


# Who got a campaign's messages, who bought, and which buyers of a campaign are
# friends of each other, as sets.
_Q1_SETS = """
reached AS (
    SELECT DISTINCT campaign_id AS id, message_type AS kind, user_id AS who
    FROM messages_v WHERE user_id IS NOT NULL),
bought AS (
    SELECT DISTINCT campaign_id AS id, message_type AS kind, user_id AS who
    FROM messages_v WHERE is_purchased AND user_id IS NOT NULL),
pairs AS (SELECT DISTINCT least(user_id, friend_id) AS a, greatest(user_id, friend_id) AS b FROM friends_v),
both_bought AS (
    SELECT x.id, x.kind, a, b
    FROM bought x JOIN pairs ON a = x.who JOIN bought y ON y.who = b AND y.id = x.id AND y.kind = x.kind),
supported AS (SELECT id, kind, a AS who FROM both_bought UNION SELECT id, kind, b FROM both_bought),
named AS (SELECT campaign_id AS id, campaign_type AS kind, channel, topic FROM campaigns_v)"""


def _q1(zero: str, even: bool = False, messages: str = "messages_v") -> str:
    sets = _Q1_SETS.replace("user_id AS who\n    FROM messages_v", f"CAST(user_id AS BIGINT) AS who\n    FROM {messages}")
    rate, share = (_pct_even("buyers", "people"), _pct_even("friendly", "buyers")) if even else \
        (_pct("buyers", "people", zero), _pct("friendly", "buyers", zero))
    by_number = "COALESCE(TRY_CAST(id AS BIGINT), 0) DESC, " if even else ""
    return (sql_with(messages, "campaigns_v", "friends_v") + "," + sets + f""",
marks AS (
    SELECT id, kind, 1 AS people, 0 AS buyers, 0 AS friendly FROM reached
    UNION ALL SELECT id, kind, 0, 1, 0 FROM bought
    UNION ALL SELECT id, kind, 0, 0, 1 FROM supported),
sums AS (
    SELECT id, kind, CAST(sum(people) AS BIGINT) AS people, CAST(sum(buyers) AS BIGINT) AS buyers,
           CAST(sum(friendly) AS BIGINT) AS friendly
    FROM marks GROUP BY id, kind)
SELECT id AS campaign_id, kind AS message_type, channel, topic, people AS recipients, buyers AS purchasers,
       {rate} AS conversion_rate_pct, friendly AS social_purchasers, {share} AS social_support_share_pct
FROM sums JOIN named USING (id, kind)
ORDER BY conversion_rate_pct DESC NULLS LAST, buyers DESC, {by_number}id, kind
LIMIT 20""")


def _q2_ctes(activity: str = "", own: str = "", twice: bool = True) -> str:
    """Q2 as one tally: friends' events vote for a product with their points,
    the target's own events against it.  ``activity`` / ``own`` restrict the
    events that make a user a target / that vote against; a pair stored both
    ways counts twice unless ``twice`` is off."""
    return f"""
chosen AS (
    SELECT who FROM (SELECT user_id AS who, row_number() OVER (ORDER BY count(*) DESC, user_id) AS place
                     FROM events_v {activity} GROUP BY user_id)
    WHERE place <= 100),
links AS (
    SELECT {"" if twice else "DISTINCT"} unnest([user_id, friend_id]) AS who, unnest([friend_id, user_id]) AS friend
    FROM friends_v),
votes AS (
    SELECT l.who, product_id, list_position(['view', 'cart', 'purchase'], event_type) AS points, false AS against
    FROM links l JOIN chosen USING (who) JOIN events_v ON user_id = friend
    WHERE event_type IN ('view', 'cart', 'purchase')
    UNION ALL
    SELECT who, product_id, 0, true FROM chosen JOIN events_v ON user_id = who {own}),
tally AS (
    SELECT who, product_id, sum(points) AS points, count(*) AS votes
    FROM votes GROUP BY who, product_id HAVING NOT bool_or(against)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY who ORDER BY points DESC, votes DESC, product_id) AS place
    FROM tally QUALIFY place <= 5)"""


_Q2_SELECT = """
SELECT who AS target_user_id, product_id, CAST(points AS BIGINT) AS weighted_score,
       CAST(votes AS BIGINT) AS interactions, p.category_code, p.brand, CAST(place AS INTEGER) AS rank_in_user
FROM placed LEFT JOIN products_v p USING (product_id)
ORDER BY who, place"""

_GRAPH_TYPES = "('view', 'cart', 'purchase')"

# Q2-g graph form: brand = first non-blank per product (by event id); code =
# smallest code among the product's category nodes (first non-blank per category).
_GRAPH_ATTRS = f""",
raw_events_v AS ({SQL_VIEWS['raw_events_v']}),
g_brand AS (
    SELECT k.product_id, f.brand FROM (SELECT DISTINCT product_id FROM raw_events_v
                                       WHERE product_id IS NOT NULL) k
    LEFT JOIN (SELECT product_id, brand, ROW_NUMBER() OVER (PARTITION BY product_id
                      ORDER BY event_id) AS rn
               FROM raw_events_v WHERE brand IS NOT NULL) f
      ON f.product_id = k.product_id AND f.rn = 1
),
g_cat AS (
    SELECT category_id, category_code FROM (
        SELECT category_id, category_code, ROW_NUMBER() OVER (PARTITION BY category_id
               ORDER BY event_id) AS rn
        FROM raw_events_v WHERE category_code IS NOT NULL AND category_id IS NOT NULL) WHERE rn = 1
),
graph_products AS (
    SELECT b.product_id, b.brand, c.category_code FROM g_brand b LEFT JOIN (
        SELECT ic.product_id, min(gc.category_code) AS category_code
        FROM (SELECT DISTINCT product_id, category_id FROM raw_events_v
              WHERE product_id IS NOT NULL AND category_id IS NOT NULL) ic
        JOIN g_cat gc ON gc.category_id = ic.category_id GROUP BY ic.product_id) c
      ON c.product_id = b.product_id
)"""


def q2_sql(**kw) -> str:
    return sql_with("events_v", "friends_v", "products_v") + "," + _q2_ctes(**kw)


def _split(col: str, pattern: str = "[^a-z0-9]+") -> str:
    return f"regexp_split_to_array(lower(COALESCE({col}, '')), '{pattern}')"


def _kw_cte(source: str = "distinct", token: str = "[a-z0-9]{3,}") -> str:
    """The three most frequent tokens of the recommended products' codes, each
    product once or once a recommendation; a token is a longest match."""
    codes = ("products_v WHERE product_id IN (SELECT product_id FROM placed)" if source == "distinct"
             else "placed JOIN products_v USING (product_id)")
    return f""",
words AS (SELECT unnest(regexp_extract_all(lower(category_code), '{token}')) AS keyword FROM {codes}),
kw AS (SELECT keyword, count(*) AS frequency FROM words GROUP BY keyword ORDER BY frequency DESC, keyword LIMIT 3)"""


def _hits_cte(fields: tuple[str, ...] = ("category_code",)) -> str:
    arr = _split(fields[0]) if len(fields) == 1 else \
        "list_concat(" + ", ".join(_split(f) for f in fields) + ")"
    return f""",
toks AS (
    SELECT product_id, category_code, brand, unnest(arr) AS token,
           len(list_filter(arr, lambda x: x <> '')) AS dl
    FROM (SELECT *, {arr} AS arr FROM products_v) p
),
hits AS (
    SELECT k.keyword, t.product_id, t.category_code, t.brand, t.dl, COUNT(*) AS tf
    FROM toks t JOIN kw k ON k.keyword = t.token
    GROUP BY k.keyword, t.product_id, t.category_code, t.brand, t.dl
)"""


_Q3_OUT = """
SELECT keyword, product_id, category_code, brand, CAST(tf AS DOUBLE) AS text_score FROM hits"""


_TOP20 = """
    SELECT keyword, product_id, category_code, brand, CAST(tf AS DOUBLE) AS text_score,
           ROW_NUMBER() OVER (PARTITION BY keyword ORDER BY tf DESC, product_id) AS rn
    FROM hits"""


def oracle() -> dict[str, str]:
    from socialcart.oracle_model import oracle as model_oracle
    from socialcart.oracle_documents import oracle as document_oracle
    from socialcart.oracle_ingest import oracle as ingest_oracle
    from socialcart.oracle_search import oracle as search_oracle

    q = model_oracle() | search_oracle() | document_oracle() | ingest_oracle()
    q["bucket_upsert"], q["snapshot_counts"] = q["incremental_upsert"], q["load_counts"]
    q["q1_campaign_conversion"] = _q1("NULL")
    q["q1_zero_share"] = _q1("0.0")
    q["q1_document"] = _q1("0.0", even=True)
    q["q1_hub"] = _q1("NULL").replace("FROM friends_v)", """FROM (
        SELECT * FROM friends_v UNION ALL SELECT (SELECT min(c_custkey) FROM customer), c_custkey FROM customer)
    WHERE user_id <> friend_id)""")
    sets = sql_with("messages_v", "campaigns_v", "friends_v") + "," + _Q1_SETS
    q["campaign_user_stats"] = sets + """
SELECT id AS campaign_id, kind AS message_type, channel, topic, who AS user_id, b.who IS NOT NULL AS did_purchase
FROM reached JOIN named USING (id, kind) LEFT JOIN bought b USING (id, kind, who)"""
    q["social_purchasers"] = sets + """
SELECT id AS campaign_id, kind AS message_type, who AS user_id FROM supported SEMI JOIN named USING (id, kind)"""
    q["friends_edges"] = sql_with("friends_v") + "SELECT * FROM friends_v"
    q["top_active_users"] = (sql_with("events_v") + """
SELECT user_id, COUNT(*) AS activity FROM events_v GROUP BY user_id
ORDER BY activity DESC, user_id LIMIT 100""")
    q["top_users_threshold"] = q["top_active_users"]
    q["q2_recommendations"] = q2_sql() + _Q2_SELECT
    q["q2_array_topk"] = q2_sql() + _Q2_SELECT
    q["q2_graph"] = (q2_sql(activity=f"WHERE event_type IN {_GRAPH_TYPES}",
                            own=f"AND event_type IN {_GRAPH_TYPES}") + _GRAPH_ATTRS
                     + _Q2_SELECT.replace("products_v p", "graph_products p"))
    q["q2_dedupe_edges"] = q2_sql(twice=False) + _Q2_SELECT
    q["q3_keywords"] = q2_sql() + _kw_cte() + "\nSELECT * FROM kw"
    q["q3_keywords_rows"] = q2_sql() + _kw_cte("rows") + "\nSELECT * FROM kw"
    q["q3_keywords_dot"] = q2_sql() + _kw_cte(token="[^.]{3,}") + "\nSELECT * FROM kw"
    q["q3_token_search"] = (q2_sql() + _kw_cte() + _hits_cte() + _Q3_OUT
                            + "\nORDER BY keyword, text_score DESC, product_id LIMIT 60")
    q["q3_token_search_top20"] = (
        q2_sql() + _kw_cte("rows") + _hits_cte(("category_code", "brand")) + f"""
SELECT keyword, product_id, category_code, brand, text_score FROM ({_TOP20}) WHERE rn <= 20""")
    q["q3_bm25"] = (q2_sql() + _kw_cte() + _hits_cte() + f""",
corpus AS (SELECT COUNT(*) AS n_docs, AVG(len(list_filter({_split('category_code')}, lambda x: x <> '')))
                  AS avgdl FROM products_v),
dfs AS (SELECT keyword, COUNT(*) AS df FROM hits GROUP BY keyword)
SELECT h.keyword, h.product_id, h.category_code, h.brand,
       ROUND(ln(1.0 + (c.n_docs - d.df + 0.5) / (d.df + 0.5)) * h.tf * 2.2
             / (h.tf + 1.2 * (1 - 0.75 + 0.75 * h.dl / c.avgdl)), 6) AS text_score
FROM hits h JOIN dfs d ON d.keyword = h.keyword CROSS JOIN corpus c
ORDER BY keyword, text_score DESC, product_id LIMIT 60""")
    sub = """,
sub AS (
    SELECT k.keyword, p.product_id, p.category_code, p.brand, CAST(0.0 AS DOUBLE) AS text_score,
           ROW_NUMBER() OVER (PARTITION BY k.keyword ORDER BY p.product_id) AS rn
    FROM products_v p JOIN kw k
      ON contains(lower(COALESCE(p.category_code, '')), k.keyword)
)"""
    q["q3_substring_search"] = (q2_sql() + _kw_cte("rows") + sub
                                + "\nSELECT keyword, product_id, category_code, brand, text_score"
                                + " FROM sub WHERE rn <= 20")
    q["q3_fallback"] = (q2_sql() + _kw_cte("rows") + _hits_cte() + sub + f""",
tok AS (
    SELECT keyword, product_id, category_code, brand, text_score FROM ({_TOP20}) WHERE rn <= 20
)
SELECT * FROM tok
UNION ALL
SELECT keyword, product_id, category_code, brand, text_score FROM sub
WHERE rn <= 20 AND NOT EXISTS (SELECT 1 FROM tok)""")
    q["doc_token_search"] = f"""
WITH kw AS (
    SELECT token AS keyword, COUNT(*) AS frequency
    FROM (SELECT unnest({_split('text')}) AS token FROM benchmark) t
    WHERE token <> '' AND length(token) > 2
    GROUP BY token ORDER BY frequency DESC, token LIMIT 3
),
hits AS (
    SELECT k.keyword, d.doc_id, COUNT(*) AS tf
    FROM (SELECT doc_id, unnest({_split('text')}) AS token FROM documents) d
    JOIN kw k ON k.keyword = d.token
    GROUP BY k.keyword, d.doc_id
)
SELECT keyword, doc_id, text_score FROM (
    SELECT keyword, doc_id, CAST(tf AS DOUBLE) AS text_score,
           ROW_NUMBER() OVER (PARTITION BY keyword ORDER BY tf DESC, doc_id) AS rn
    FROM hits) WHERE rn <= 20"""
    return q
