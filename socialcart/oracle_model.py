"""DuckDB SQL for the cleaning, typing, modelling, graph and check queries."""

from __future__ import annotations

from socialcart.sources.testviews import SQL_VIEWS, sql_with

_NUM = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def _strip(c: str) -> str:
    return f"regexp_replace(COALESCE({c}, ''), '^\\s+|\\s+$', '', 'g')"


def _missing(c: str) -> str:
    s = _strip(c)
    return f"(CASE WHEN lower({s}) IN ('', 'na', 'n/a', 'null', 'none', 'nan') THEN '' ELSE {s} END)"


def _bool(c: str) -> str:
    m = _missing(c)
    return (f"(CASE WHEN lower({m}) IN ('true', 't', '1', 'yes', 'y') THEN '1' "
            f"WHEN lower({m}) IN ('false', 'f', '0', 'no', 'n') THEN '0' ELSE {m} END)")


def _datetime(c: str) -> str:
    m = _missing(c)
    parsed = (f"COALESCE(try_strptime({m}, '%Y-%m-%d %H:%M:%S.%f'), "
              f"try_strptime({m}, '%Y-%m-%d %H:%M:%S'), "
              f"try_strptime({m}, '%Y-%m-%d %H:%M:%S UTC'), "
              f"try_strptime({m}, '%Y-%m-%d'), try_strptime({m}, '%Y-%-m-%-d'))")
    return (f"(CASE WHEN {m} = '' THEN '' WHEN {parsed} IS NULL THEN {m} "
            f"WHEN length({m}) = 10 THEN strftime({parsed}, '%Y-%m-%d') "
            f"ELSE strftime({parsed}, '%Y-%m-%d %H:%M:%S') END)")


def _integer(c: str, compat: bool = False) -> str:
    m = _missing(c)
    if compat:
        d = f"TRY_CAST({m} AS DOUBLE)"
        val = f"CAST(CAST({d} AS BIGINT) AS VARCHAR)"
    else:
        d = f"TRY_CAST({m} AS DECIMAL(38,18))"
        val = f"CAST(CAST({d} AS DECIMAL(38,0)) AS VARCHAR)"
    return (f"(CASE WHEN {m} = '' THEN '' WHEN regexp_full_match({m}, '{_NUM}') "
            f"AND {d} = floor({d}) THEN {val} ELSE {m} END)")


def _price(c: str) -> str:
    m = _missing(c)
    d = f"TRY_CAST({m} AS DOUBLE)"
    txt = f"rtrim(rtrim(printf('%.10f', {d}), '0'), '.')"
    return (f"(CASE WHEN {m} = '' THEN '' WHEN regexp_full_match({m}, '{_NUM}') "
            f"AND {d} IS NOT NULL THEN (CASE WHEN {txt} = '' THEN '0' ELSE {txt} END) "
            f"ELSE {m} END)")


_RAWM = sql_with("raw_messages_v")

_CLEAN_ROW = f"""
cleaned AS (
    SELECT {_integer('id')} AS id, {_missing('message_type')} AS message_type,
           {_bool('is_purchased')} AS is_purchased, {_datetime('sent_at')} AS sent_at,
           {_price('price')} AS price, {_missing('status')} AS status
    FROM raw_messages_v
),
kept AS (
    SELECT * FROM cleaned
    WHERE NOT (id = '' AND message_type = '' AND is_purchased = '' AND sent_at = ''
               AND price = '' AND status = '')
)"""


def _typed_campaigns() -> str:
    def nn(c):
        return f"NULLIF(trim({c}), '')"

    def tb(c):
        return (f"CASE WHEN lower({nn(c)}) IN ('1', 't', 'true', 'yes', 'y') THEN TRUE "
                f"WHEN lower({nn(c)}) IN ('0', 'f', 'false', 'no', 'n') THEN FALSE END")
    return sql_with("raw_campaigns_v") + f""",
typed AS (
    SELECT left(COALESCE({nn('id')}, '') || '|' || COALESCE({nn('campaign_type')}, ''), 50)
               AS campaign_pk,
           {nn('id')} AS campaign_id, {nn('campaign_type')} AS campaign_type,
           {nn('channel')} AS channel,
           CAST({nn('started_at')} AS TIMESTAMP) AS started_at,
           CAST({nn('finished_at')} AS TIMESTAMP) AS finished_at,
           CAST({nn('total_count')} AS INTEGER) AS total_count,
           {tb('ab_test')} AS ab_test,
           CAST({nn('hour_limit')} AS DECIMAL(38,10)) AS hour_limit,
           CAST({nn('position')} AS INTEGER) AS position
    FROM raw_campaigns_v
)
SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id, campaign_type
        ORDER BY finished_at DESC NULLS LAST, started_at DESC NULLS LAST,
                 campaign_pk DESC NULLS LAST, channel DESC NULLS LAST,
                 total_count DESC NULLS LAST, ab_test DESC NULLS LAST,
                 hour_limit DESC NULLS LAST, position DESC NULLS LAST) AS rn
    FROM typed WHERE campaign_id IS NOT NULL AND campaign_type IS NOT NULL
) WHERE rn = 1"""


_USERS = """
users AS (
    SELECT DISTINCT user_id FROM (
        SELECT user_id FROM clients_v UNION ALL SELECT user_id FROM events_v
        UNION ALL SELECT user_id FROM messages_v
        UNION ALL SELECT friend1 FROM friends_raw_v UNION ALL SELECT friend2 FROM friends_raw_v
    ) u WHERE user_id IS NOT NULL
)"""

_HELPERS = """
has_client AS (
    SELECT DISTINCT user_id, client_id FROM (
        SELECT user_id, client_id FROM clients_v UNION ALL
        SELECT user_id, client_id FROM messages_v) x
    WHERE user_id IS NOT NULL AND client_id IS NOT NULL
),
helpers AS (
    SELECT hc.user_id, m.campaign_id || '|' || m.message_type AS campaign_key,
           bool_or(COALESCE(m.is_purchased, false)) AS purchased
    FROM has_client hc JOIN messages_v m ON m.client_id = hc.client_id
    GROUP BY hc.user_id, m.campaign_id || '|' || m.message_type
)"""


def _first_by(value: str, order: str, key: str, table: str, last: bool = False) -> str:
    direction = "DESC" if last else "ASC"
    return f"""
SELECT k.{key}, f.{value} FROM (SELECT DISTINCT {key} FROM {table} WHERE {key} IS NOT NULL) k
LEFT JOIN (SELECT {key}, {value}, ROW_NUMBER() OVER (PARTITION BY {key}
                  ORDER BY {order} {direction}) AS rn
           FROM {table} WHERE {value} IS NOT NULL AND {key} IS NOT NULL) f
  ON f.{key} = k.{key} AND f.rn = 1"""


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    for name, col, fn in [("clean_missing", "status", _missing),
                          ("clean_boolean", "is_purchased", _bool),
                          ("clean_datetime", "sent_at", _datetime),
                          ("clean_integer", "id", _integer),
                          ("clean_price", "price", _price)]:
        q[name] = _RAWM + f"SELECT {col} AS raw, {fn(col)} AS cleaned FROM raw_messages_v"
    q["clean_integer_compat"] = (_RAWM + f"SELECT id AS raw, {_integer('id', True)} AS cleaned "
                                 "FROM raw_messages_v")
    q["clean_row"] = _RAWM + "," + _CLEAN_ROW + "\nSELECT * FROM kept"
    q["typed_messages"] = _RAWM + "," + _CLEAN_ROW + """
SELECT NULLIF(trim(id), '') AS row_id, NULLIF(trim(message_type), '') AS message_type,
       CASE WHEN lower(NULLIF(trim(is_purchased), '')) IN ('1', 't', 'true', 'yes', 'y') THEN TRUE
            WHEN lower(NULLIF(trim(is_purchased), '')) IN ('0', 'f', 'false', 'no', 'n') THEN FALSE
       END AS is_purchased,
       TRY_CAST(NULLIF(trim(sent_at), '') AS TIMESTAMP) AS sent_at,
       TRY_CAST(NULLIF(trim(price), '') AS DECIMAL(38,10)) AS price,
       NULLIF(trim(status), '') AS status
FROM kept
WHERE NULLIF(trim(id), '') IS NOT NULL AND NULLIF(trim(message_type), '') IS NOT NULL"""
    q["typed_campaigns"] = _typed_campaigns()
    q["typed_events"] = sql_with("raw_events_v") + """
SELECT 'ev_' || CAST(ROW_NUMBER() OVER (ORDER BY event_time, event_id) AS VARCHAR) AS event_id,
       event_time, event_type, user_id, product_id, CAST(price AS DECIMAL(38,10)) AS price,
       user_session
FROM raw_events_v WHERE user_id IS NOT NULL AND product_id IS NOT NULL"""
    q["messages_nested_roundtrip"] = sql_with("messages_v") + """
SELECT row_id, user_id, campaign_id || '|' || message_type AS campaign_key, campaign_id,
       is_purchased, sent_at FROM messages_v"""
    q["product_search_text"] = sql_with("products_v") + """
SELECT product_id, NULLIF(lower(concat_ws(' ', category_code, brand)), '') AS search_text
FROM products_v"""
    base = sql_with("clients_v", "events_v", "messages_v", "friends_raw_v", "products_v",
                    "campaigns_v", "friends_v")
    q["users_dim"] = base + "," + _USERS + "\nSELECT * FROM users"
    clients_dim = """
clients_dim AS (
    SELECT client_id, user_id, first_purchase_date, user_device_id FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY first_purchase_date
                  NULLS LAST, user_id NULLS LAST, user_device_id NULLS LAST) AS rn
        FROM clients_v WHERE client_id IS NOT NULL) WHERE rn = 1
)"""
    q["clients_dim"] = base + "," + clients_dim + "\nSELECT * FROM clients_dim"
    q["message_only_clients"] = base + "," + clients_dim + """
SELECT client_id, user_id, CAST(NULL AS DATE) AS first_purchase_date, user_device_id FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY user_id NULLS LAST,
              user_device_id NULLS LAST) AS rn
    FROM messages_v WHERE client_id IS NOT NULL) m
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM clients_dim c WHERE c.client_id = m.client_id)"""
    raw_ev = sql_with("raw_events_v")
    q["products_dim"] = raw_ev + """
SELECT product_id, category_id, category_code, brand FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY category_id NULLS LAST,
              category_code NULLS LAST, brand NULLS LAST) AS rn
    FROM raw_events_v WHERE product_id IS NOT NULL) WHERE rn = 1"""
    q["first_purchase"] = base + """
SELECT user_id, min(first_purchase_date) AS first_purchase_date,
       COALESCE(bool_or(first_purchase_date IS NOT NULL), false) AS has_first_purchase
FROM clients_v WHERE user_id IS NOT NULL GROUP BY user_id"""
    q["client_device"] = base + f""",
dev AS ({_first_by('user_device_id', 'row_ord', 'client_id', 'clients_v', last=True)})
SELECT d.client_id, d.user_device_id, f.first_purchase_date
FROM dev d JOIN (SELECT client_id, min(first_purchase_date) AS first_purchase_date
                 FROM clients_v GROUP BY client_id) f ON f.client_id = d.client_id"""
    q["client_device_first"] = base + f""",
dev AS ({_first_by('user_device_id', 'row_ord', 'client_id', 'clients_v', last=False)})
SELECT d.client_id, d.user_device_id, f.first_purchase_date
FROM dev d JOIN (SELECT client_id, min(first_purchase_date) AS first_purchase_date
                 FROM clients_v GROUP BY client_id) f ON f.client_id = d.client_id"""
    q["has_client_edges"] = base + "," + _HELPERS + "\nSELECT user_id, client_id FROM has_client"
    q["graph_products"] = raw_ev + _first_by("brand", "event_id", "product_id", "raw_events_v")
    q["graph_categories"] = raw_ev + _first_by("category_code", "event_id", "category_id",
                                               "raw_events_v")
    q["in_category_edges"] = raw_ev + """
SELECT DISTINCT product_id, category_id FROM raw_events_v
WHERE product_id IS NOT NULL AND category_id IS NOT NULL"""
    q["event_edges"] = raw_ev + """
SELECT user_id AS src, product_id AS dst,
       CASE lower(event_type) WHEN 'view' THEN 'VIEWED' WHEN 'cart' THEN 'CARTED'
                              WHEN 'purchase' THEN 'PURCHASED' END AS etype,
       user_session AS session_id, event_time, CAST(price AS DOUBLE) AS price
FROM raw_events_v
WHERE lower(event_type) IN ('view', 'cart', 'purchase')
  AND user_id IS NOT NULL AND product_id IS NOT NULL"""
    q["message_upsert"] = sql_with("messages_v") + """,
m AS (
    SELECT CAST(trunc(row_id / 2) AS BIGINT) AS message_id,
           CASE WHEN row_id % 3 = 0 THEN NULL ELSE row_id END AS row_id,
           row_id AS ord, campaign_id, message_type, user_id, is_purchased
    FROM messages_v
),
last_row AS (
    SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY message_id ORDER BY ord DESC) rn
                   FROM m) WHERE rn = 1
),
last_id AS (
    SELECT message_id, arg_max(row_id, ord) AS row_id FROM m WHERE row_id IS NOT NULL
    GROUP BY message_id
)
SELECT l.message_id, i.row_id, l.campaign_id, l.message_type, l.user_id, l.is_purchased
FROM last_row l LEFT JOIN last_id i ON i.message_id = l.message_id"""
    q["campaign_nodes"] = base + """
SELECT campaign_id || '|' || campaign_type AS campaign_key, campaign_id, campaign_type, channel,
       topic FROM campaigns_v
UNION ALL
SELECT k, split_part(k, '|', 1), split_part(k, '|', 2), NULL, NULL FROM (
    SELECT DISTINCT campaign_id || '|' || message_type AS k FROM messages_v
    WHERE campaign_id IS NOT NULL AND message_type IS NOT NULL) s
WHERE k NOT IN (SELECT campaign_id || '|' || campaign_type FROM campaigns_v)"""
    q["friend_of_edges"] = base + "," + _USERS + """
SELECT f.user_id, f.friend_id FROM friends_v f
WHERE f.user_id IN (SELECT user_id FROM users) AND f.friend_id IN (SELECT user_id FROM users)"""
    q["campaign_helper_edges"] = base + "," + _HELPERS + "\nSELECT * FROM helpers"
    q["helper_deltas"] = base + """,
latest AS (SELECT * FROM messages_v
           QUALIFY row_number() OVER (PARTITION BY row_id // 2 ORDER BY row_id DESC) = 1),""" + _HELPERS.replace(
        "messages_v", "latest") + "\nSELECT * FROM helpers"
    q["helper_counts"] = base + "," + _HELPERS + """
SELECT h.received_campaign_edges, h.purchased_campaign_edges, m.min_row_id, m.max_row_id,
       m.message_count
FROM (SELECT COUNT(*) AS received_campaign_edges,
             COUNT(*) FILTER (WHERE purchased) AS purchased_campaign_edges FROM helpers) h,
     (SELECT min(row_id) AS min_row_id, max(row_id) AS max_row_id, COUNT(*) AS message_count
      FROM messages_v) m"""
    q["q1_graph"] = base + "," + _USERS + "," + _HELPERS + """,
nodes AS (SELECT campaign_id || '|' || campaign_type AS campaign_key, * FROM campaigns_v),
fo AS (
    SELECT user_id, friend_id FROM friends_v
    WHERE user_id IN (SELECT user_id FROM users) AND friend_id IN (SELECT user_id FROM users)
),
und AS (SELECT user_id, friend_id FROM fo UNION ALL SELECT friend_id, user_id FROM fo),
pur AS (SELECT user_id, campaign_key FROM helpers WHERE purchased),
soc AS (
    SELECT p.campaign_key, COUNT(DISTINCT p.user_id) AS s
    FROM pur p JOIN und u ON u.user_id = p.user_id
    JOIN pur pf ON pf.campaign_key = p.campaign_key AND pf.user_id = u.friend_id
    GROUP BY p.campaign_key
),
agg AS (
    SELECT n.campaign_id, n.campaign_type AS message_type, n.channel, n.topic,
           COALESCE((SELECT COUNT(*) FROM helpers h WHERE h.campaign_key = n.campaign_key), 0)
               AS recipients,
           COALESCE((SELECT COUNT(*) FROM pur p WHERE p.campaign_key = n.campaign_key), 0)
               AS purchasers,
           COALESCE((SELECT s FROM soc WHERE soc.campaign_key = n.campaign_key), 0)
               AS social_purchasers
    FROM nodes n
)
SELECT campaign_id, message_type, channel, topic, recipients, purchasers,
       CASE WHEN recipients = 0 THEN 0.0 ELSE
            CAST((20000 * purchasers + recipients) // (2 * recipients) AS DOUBLE) / 100 END
           AS conversion_rate_pct,
       social_purchasers,
       CASE WHEN purchasers = 0 THEN 0.0 ELSE
            CAST((20000 * social_purchasers + purchasers) // (2 * purchasers) AS DOUBLE) / 100 END
           AS social_support_share_pct
FROM agg
ORDER BY conversion_rate_pct DESC, purchasers DESC, campaign_id, message_type
LIMIT 20"""
    q["dq_unique"] = base + """
SELECT client_id, COUNT(*) AS n FROM clients_v GROUP BY client_id HAVING COUNT(*) > 1"""
    q["dq_not_null"] = raw_ev + """
SELECT 'events' AS table_name, column_name, nulls FROM (
    SELECT 'category_code' AS column_name, COUNT(*) FILTER (WHERE category_code IS NULL) AS nulls
    FROM raw_events_v
    UNION ALL SELECT 'brand', COUNT(*) FILTER (WHERE brand IS NULL) FROM raw_events_v
    UNION ALL SELECT 'category_id', COUNT(*) FILTER (WHERE category_id IS NULL) FROM raw_events_v)"""
    q["dq_foreign_key"] = base + "," + _USERS + """
SELECT 'messages_user' AS constraint_name, COUNT(*) AS orphans FROM messages_v m
WHERE m.user_id IS NOT NULL AND m.user_id NOT IN (SELECT user_id FROM users)
UNION ALL
SELECT 'events_product', COUNT(*) FROM events_v e
WHERE e.product_id IS NOT NULL AND e.product_id NOT IN (SELECT product_id FROM products_v)
UNION ALL
SELECT 'messages_campaign', COUNT(*) FROM messages_v m
WHERE m.campaign_id IS NOT NULL AND m.message_type IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM campaigns_v c WHERE c.campaign_id = m.campaign_id
      AND c.campaign_type = m.message_type)
UNION ALL
SELECT 'friends_user', COUNT(*) FROM friends_v f
WHERE f.user_id IS NOT NULL AND f.user_id NOT IN (SELECT user_id FROM events_v)"""
    from socialcart.oracle_checks import oracle as check_oracle

    q |= check_oracle(clients_dim, _USERS)
    q["dq_schema"] = sql_with("products_v") + """
SELECT 'products' AS table_name, field, rule, violations FROM (
    SELECT 'category_id' AS field, 'type int != string' AS rule, CAST(NULL AS BIGINT) AS violations
    UNION ALL SELECT 'search_text', 'missing', NULL
    UNION ALL SELECT 'product_id', 'not null', COUNT(*) FILTER (WHERE product_id IS NULL)
              FROM products_v
    UNION ALL SELECT 'category_code', 'not null', COUNT(*) FILTER (WHERE category_code IS NULL)
              FROM products_v
    UNION ALL SELECT 'brand', 'not null', COUNT(*) FILTER (WHERE brand IS NULL) FROM products_v)"""
    q["load_counts"] = base + "," + _USERS + "," + clients_dim + """
SELECT 'users' AS label, COUNT(*) AS row_count FROM users
UNION ALL SELECT 'clients', COUNT(*) FROM clients_dim
UNION ALL SELECT 'products', COUNT(*) FROM products_v
UNION ALL SELECT 'events', COUNT(*) FROM events_v
UNION ALL SELECT 'campaigns', COUNT(*) FROM campaigns_v
UNION ALL SELECT 'messages', COUNT(*) FROM messages_v
UNION ALL SELECT 'friends', COUNT(*) FROM friends_v"""
    q["timing_stats"] = sql_with("events_v") + """
SELECT 'events' AS database, event_type AS query_name, COUNT(*) AS runs,
       round(avg(price), 3) AS avg_ms, round(stddev_samp(price), 3) AS stddev_ms,
       min(price) AS min_ms, max(price) AS max_ms
FROM events_v GROUP BY event_type"""
    q["incremental_upsert"] = sql_with("messages_v") + """
SELECT message_id, ord, campaign_id, message_type, user_id, is_purchased FROM (
    SELECT CAST(trunc(row_id / 2) AS BIGINT) AS message_id, row_id AS ord, campaign_id,
           message_type, user_id, is_purchased,
           ROW_NUMBER() OVER (PARTITION BY CAST(trunc(row_id / 2) AS BIGINT) ORDER BY row_id DESC)
               AS rn
    FROM messages_v) WHERE rn = 1"""
    from socialcart.oracle_sql import _GRAPH_TYPES, _kw_cte, q2_sql
    q["q3_graph_search"] = (
        q2_sql(activity=f"WHERE event_type IN {_GRAPH_TYPES}",
               own=f"AND event_type IN {_GRAPH_TYPES}")
        + _kw_cte("rows") + f""",
raw_events_v AS ({SQL_VIEWS['raw_events_v']}),
cats AS ({_first_by('category_code', 'event_id', 'category_id', 'raw_events_v')}),
pn AS ({_first_by('brand', 'event_id', 'product_id', 'raw_events_v')}),
ic AS (SELECT DISTINCT product_id, category_id FROM raw_events_v
       WHERE product_id IS NOT NULL AND category_id IS NOT NULL),
ch AS (
    SELECT k.keyword, c.category_id, c.category_code, COUNT(*) AS tf
    FROM (SELECT category_id, category_code,
                 unnest(regexp_split_to_array(lower(COALESCE(category_code, '')), '[^a-z0-9]+')) AS tok
          FROM cats) c
    JOIN kw k ON k.keyword = c.tok
    GROUP BY k.keyword, c.category_id, c.category_code
),
capped AS (
    SELECT * FROM (
        SELECT ch.keyword, ic.product_id, ch.category_code, pn.brand,
               CAST(ch.tf AS DOUBLE) AS text_score,
               ROW_NUMBER() OVER (PARTITION BY ch.keyword
                                  ORDER BY ch.tf DESC, ic.product_id, ch.category_code) AS r
        FROM ch JOIN ic ON ic.category_id = ch.category_id
        JOIN pn ON pn.product_id = ic.product_id) WHERE r <= 20
)
SELECT keyword, product_id, category_code, brand, text_score FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY keyword, product_id ORDER BY r) AS f FROM capped)
WHERE f = 1""")
    return q
