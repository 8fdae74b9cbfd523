"""The three analyses as Spark SQL over registered views.

``register_views(spark, tables)`` registers the typed tables (``messages,
campaigns, friends, events, products``) as temporary views;
``run(spark, name)`` runs one analysis.  The statements have the same
shape as the DataFrame plans (grouping before the dimension join, buyer
edges before the fan-out, one aggregate per (target, product)), so
Catalyst produces the same physical plans; they are for users who keep
their analyses as SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = ("messages", "campaigns", "friends", "events", "products")

Q1 = """
WITH cu AS (
    SELECT campaign_id, message_type, user_id,
           bool_or(coalesce(is_purchased, false)) AS did_purchase
    FROM messages WHERE user_id IS NOT NULL
    GROUP BY campaign_id, message_type, user_id
),
buyers AS (SELECT campaign_id, message_type, user_id FROM cu WHERE did_purchase),
buyer_users AS (SELECT DISTINCT user_id FROM buyers),
buyer_edges AS (
    SELECT f.user_id, f.friend_id FROM friends f
    LEFT SEMI JOIN buyer_users a ON a.user_id = f.user_id
    LEFT SEMI JOIN buyer_users b ON b.user_id = f.friend_id
),
both_ways AS (
    SELECT inline(array(named_struct('user_id', user_id, 'friend_id', friend_id),
                        named_struct('user_id', friend_id, 'friend_id', user_id)))
    FROM buyer_edges
),
reach AS (
    SELECT b.campaign_id, b.message_type, b.user_id, w.friend_id
    FROM buyers b JOIN both_ways w ON w.user_id = b.user_id
),
social AS (
    SELECT r.campaign_id, r.message_type, count(DISTINCT r.user_id) AS social_purchasers
    FROM reach r
    LEFT SEMI JOIN buyers f
      ON f.campaign_id = r.campaign_id AND f.message_type = r.message_type
     AND f.user_id = r.friend_id
    GROUP BY r.campaign_id, r.message_type
),
counts AS (
    SELECT campaign_id, message_type, count(*) AS recipients,
           count_if(did_purchase) AS purchasers
    FROM cu GROUP BY campaign_id, message_type
)
SELECT c.campaign_id, c.message_type, k.channel, k.topic, c.recipients, c.purchasers,
       CAST(round(100.0 * c.purchasers / nullif(c.recipients, 0), 2) AS DOUBLE)
           AS conversion_rate_pct,
       coalesce(s.social_purchasers, 0) AS social_purchasers,
       CAST(round(100.0 * coalesce(s.social_purchasers, 0) / nullif(c.purchasers, 0), 2)
            AS DOUBLE) AS social_support_share_pct
FROM counts c
JOIN campaigns k ON k.campaign_id = c.campaign_id AND k.campaign_type = c.message_type
LEFT JOIN social s ON s.campaign_id = c.campaign_id AND s.message_type = c.message_type
ORDER BY conversion_rate_pct DESC NULLS LAST, purchasers DESC, campaign_id, message_type
LIMIT 20
"""

Q2_RANKED = """
WITH targets AS (
    SELECT user_id FROM events GROUP BY user_id
    ORDER BY count(*) DESC, user_id LIMIT 100
),
roles AS (
    SELECT /*+ BROADCAST(t) */ t.user_id AS target_user_id, w.friend_id AS user_id,
           false AS is_self
    FROM (SELECT inline(array(named_struct('user_id', user_id, 'friend_id', friend_id),
                              named_struct('user_id', friend_id, 'friend_id', user_id)))
          FROM friends) w
    JOIN targets t ON t.user_id = w.user_id
    UNION ALL
    SELECT user_id, user_id, true FROM targets
),
scored AS (
    SELECT r.target_user_id, e.product_id,
           sum(CASE WHEN NOT r.is_self THEN CASE e.event_type WHEN 'purchase' THEN 3
               WHEN 'cart' THEN 2 WHEN 'view' THEN 1 ELSE 0 END END) AS weighted_score,
           sum(CASE WHEN NOT r.is_self AND e.event_type IN ('view', 'cart', 'purchase')
               THEN 1 ELSE 0 END) AS interactions,
           bool_or(r.is_self) AS own
    FROM events e JOIN roles r ON r.user_id = e.user_id
    GROUP BY r.target_user_id, e.product_id
),
ranked AS (
    SELECT target_user_id, product_id, CAST(weighted_score AS BIGINT) AS weighted_score,
           CAST(interactions AS BIGINT) AS interactions,
           row_number() OVER (PARTITION BY target_user_id
                              ORDER BY weighted_score DESC, interactions DESC, product_id)
               AS rank_in_user
    FROM scored WHERE NOT own AND interactions > 0
)
"""

Q2 = Q2_RANKED + """
SELECT r.target_user_id, r.product_id, r.weighted_score, r.interactions,
       p.category_code, p.brand, r.rank_in_user
FROM ranked r LEFT JOIN products p ON p.product_id = r.product_id
WHERE r.rank_in_user <= 5
ORDER BY r.target_user_id, r.rank_in_user
"""

Q3 = Q2_RANKED + """,
keywords AS (
    SELECT keyword, count(*) AS frequency
    FROM (SELECT explode(split(lower(coalesce(p.category_code, '')), '[^a-z0-9]+')) AS keyword
          FROM (SELECT DISTINCT product_id FROM ranked WHERE rank_in_user <= 5) q
          JOIN products p ON p.product_id = q.product_id) t
    WHERE keyword <> '' AND length(keyword) > 2
    GROUP BY keyword ORDER BY frequency DESC, keyword LIMIT 3
),
pattern AS (
    SELECT concat('(?<![a-z0-9])(?:', array_join(collect_set(keyword), '|'), ')(?![a-z0-9])') AS re
    FROM keywords
),
hits AS (
    SELECT keyword, product_id, category_code, brand, count(*) AS tf
    FROM (SELECT product_id, category_code, brand,
                 explode(regexp_extract_all(lower(coalesce(category_code, '')),
                                            (SELECT re FROM pattern), 0)) AS keyword
          FROM products) x
    GROUP BY keyword, product_id, category_code, brand
)
SELECT keyword, product_id, category_code, brand, CAST(tf AS DOUBLE) AS text_score
FROM hits ORDER BY keyword, text_score DESC, product_id LIMIT 60
"""

STATEMENTS = {"q1": Q1, "q2": Q2, "q3": Q3}


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name in VIEWS:
        tables[name].createOrReplaceTempView(name)


def run(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(STATEMENTS[name])
