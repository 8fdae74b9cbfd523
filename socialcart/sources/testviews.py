"""Adapter from the driver's test tables to the shop data model.

The test folder holds TPC-H-like tables, not the shop extracts the analyses
were written for.  Each view below derives one shop table from them with
plain DataFrame expressions, so every analysis reads the whole test tables
and its work grows with them.  ``SQL_VIEWS`` holds the same derivations as
ANSI SQL (DuckDB dialect) for the independent oracle.

Views (all ids stay integers):

* ``events``     – events: ``click`` is read as ``cart``; product = ``$.k`` of ``props``
* ``products``   – part: category_code = ``<type>.<name words>`` (NULL every 7th part)
* ``friends_raw``– customer → customer at a fixed set of key offsets when the
                   market segment matches; some pairs are also stored reversed
                   and a few self-loops are kept, so cleaning has work to do
* ``friends``    – cleaned directed pairs (distinct, no self-loops)
* ``messages``   – orders: campaign = (order year, order priority),
                   purchased = status F / O / P → true / false / NULL
* ``campaigns``  – distinct (year, priority) of orders with channel and topic
* ``clients``    – finished orders: client = customer key div 2, first purchase date
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _view(fn):
    """Build a view's plan once per (session, folder) and reuse it, like a
    catalog of views: DataFrames are immutable plans, so sharing them is
    safe, and it saves re-listing files and re-analysing the plan on every
    query."""
    cached = functools.lru_cache(maxsize=256)(fn)

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cached(spark, sf_dir.rstrip("/"))
    wrapper.uncached = fn
    return wrapper

# Fixed values of the adapter (must be identical in SQL_VIEWS below).
FRIEND_OFFSETS = (1, 2, 3, 5, 8, 13, 21)
REVERSE_EVERY = 5          # (a + b) % 5 == 0 → pair also stored as (b, a)
SELF_LOOP_EVERY = 50       # a % 50 == 0 → raw row (a, a)
NULL_CODE_EVERY = 7        # p_partkey % 7 == 0 → category_code NULL
CHANNEL_BY_PRIORITY = {
    "1-URGENT": "push",
    "2-HIGH": "email",
    "3-MEDIUM": "email",
    "4-NOT SPECIFIED": "sms",
    "5-LOW": "web",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_view
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("ts").alias("event_time"),
        F.col("user_id"),
        F.when(F.col("event_type") == "click", F.lit("cart"))
         .otherwise(F.col("event_type")).alias("event_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.col("value").alias("price"),
    )


@_view
def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    code = F.concat(F.lower("p_type"), F.lit("."), F.regexp_replace("p_name", " ", "."))
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_size").alias("category_id"),
        F.when(F.col("p_partkey") % NULL_CODE_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(code).alias("category_code"),
        F.col("p_brand").alias("brand"),
    )


@_view
def friends_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw friendship rows ``(friend1, friend2)``.

    Linear in the customer table: every customer proposes a fixed number of
    partners by key offset and one equi-join on the (unique) customer key
    checks that the partner exists and shares the segment.
    """
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    proposals = c.select(
        F.col("c_custkey").alias("friend1"),
        F.col("c_mktsegment").alias("seg1"),
        F.explode(F.array(*[F.lit(d) for d in FRIEND_OFFSETS])).alias("d"),
    ).withColumn("friend2", F.col("friend1") + F.col("d"))
    partner = c.select(F.col("c_custkey").alias("friend2"), F.col("c_mktsegment").alias("seg2"))
    fwd = (proposals.join(partner, "friend2")
           .where(F.col("seg1") == F.col("seg2"))
           .select("friend1", "friend2"))
    # the reversed copy is generated in the same pass as the forward row
    rows = F.array(
        F.struct(F.col("friend1"), F.col("friend2")),
        F.when((F.col("friend1") + F.col("friend2")) % REVERSE_EVERY == 0,
               F.struct(F.col("friend2").alias("friend1"), F.col("friend1").alias("friend2"))))
    pairs = (fwd.select(F.explode(rows).alias("_p")).where(F.col("_p").isNotNull())
             .select("_p.friend1", "_p.friend2"))
    loops = (c.where(F.col("c_custkey") % SELF_LOOP_EVERY == 0)
             .select(F.col("c_custkey").alias("friend1"), F.col("c_custkey").alias("friend2")))
    return pairs.unionByName(loops)


@_view
def friends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned friendship edges ``(user_id, friend_id)``."""
    from socialcart.operators.model import friend_edges

    return friend_edges(friends_raw(spark, sf_dir), "friend1", "friend2")


@_view
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderkey").alias("message_id"),
        F.year("o_orderdate").cast("string").alias("campaign_id"),
        F.col("o_orderpriority").alias("message_type"),
        (F.col("o_custkey") / 2).cast("bigint").alias("client_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(True))
         .when(F.col("o_orderstatus") == "O", F.lit(False))
         .alias("is_purchased"),
        F.col("o_orderdate").alias("sent_at"),
        (F.col("o_orderkey") % 5).alias("user_device_id"),
    )


def _channel(priority):
    expr = None
    for k, v in CHANNEL_BY_PRIORITY.items():
        expr = (F.when(priority == k, F.lit(v)) if expr is None
                else expr.when(priority == k, F.lit(v)))
    return expr


@_view
def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    keys = o.select(
        F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("campaign_type")
    ).distinct()
    return keys.select(
        F.col("y").cast("string").alias("campaign_id"),
        F.col("campaign_type"),
        _channel(F.col("campaign_type")).alias("channel"),
        F.when(F.col("campaign_type") == "5-LOW", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("topic_"), (F.col("y") % 3).cast("string"))).alias("topic"),
    )


@_view
def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    return o.where(F.col("o_orderstatus") == "F").select(
        (F.col("o_custkey") / 2).cast("bigint").alias("client_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("first_purchase_date"),
        (F.col("o_orderkey") % 3).alias("user_device_id"),
        F.col("o_orderkey").alias("row_ord"),
    )


# ---------------------------------------------------------------------------
# The same views in DuckDB SQL, for the oracle.  Each entry is a CTE body.
# ---------------------------------------------------------------------------

_CHANNEL_SQL = "CASE " + " ".join(
    f"WHEN o_orderpriority = '{k}' THEN '{v}'" for k, v in CHANNEL_BY_PRIORITY.items()
) + " END"

SQL_VIEWS: dict[str, str] = {
    "events_v": """
        SELECT event_id, ts AS event_time, user_id,
               CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
               value AS price
        FROM events""",
    "products_v": f"""
        SELECT p_partkey AS product_id, p_size AS category_id,
               CASE WHEN p_partkey % {NULL_CODE_EVERY} = 0 THEN NULL
                    ELSE lower(p_type) || '.' || replace(p_name, ' ', '.') END AS category_code,
               p_brand AS brand
        FROM part""",
    "friends_fwd_v": f"""
        SELECT pr.friend1, pr.friend2
        FROM (SELECT c_custkey AS friend1, c_mktsegment AS seg1,
                     c_custkey + unnest([{', '.join(str(d) for d in FRIEND_OFFSETS)}]) AS friend2
              FROM customer) pr
        JOIN customer c2 ON c2.c_custkey = pr.friend2
        WHERE c2.c_mktsegment = pr.seg1""",
    "friends_raw_v": f"""
        SELECT friend1, friend2 FROM friends_fwd_v
        UNION ALL
        SELECT friend2 AS friend1, friend1 AS friend2 FROM friends_fwd_v
        WHERE (friend1 + friend2) % {REVERSE_EVERY} = 0
        UNION ALL
        SELECT c_custkey AS friend1, c_custkey AS friend2 FROM customer
        WHERE c_custkey % {SELF_LOOP_EVERY} = 0""",
    "friends_v": """
        SELECT DISTINCT friend1 AS user_id, friend2 AS friend_id
        FROM friends_raw_v
        WHERE friend1 IS NOT NULL AND friend2 IS NOT NULL AND friend1 <> friend2""",
    "messages_v": """
        SELECT o_orderkey AS row_id, o_orderkey AS message_id,
               CAST(year(o_orderdate) AS VARCHAR) AS campaign_id,
               o_orderpriority AS message_type,
               CAST(trunc(o_custkey / 2) AS BIGINT) AS client_id,
               o_custkey AS user_id,
               CASE WHEN o_orderstatus = 'F' THEN TRUE
                    WHEN o_orderstatus = 'O' THEN FALSE END AS is_purchased,
               o_orderdate AS sent_at,
               o_orderkey % 5 AS user_device_id
        FROM orders""",
    "campaigns_v": f"""
        SELECT CAST(y AS VARCHAR) AS campaign_id, o_orderpriority AS campaign_type,
               {_CHANNEL_SQL} AS channel,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                    ELSE 'topic_' || CAST(y % 3 AS VARCHAR) END AS topic
        FROM (SELECT DISTINCT year(o_orderdate) AS y, o_orderpriority FROM orders) k""",
    "clients_v": """
        SELECT CAST(trunc(o_custkey / 2) AS BIGINT) AS client_id, o_custkey AS user_id,
               CAST(o_orderdate AS DATE) AS first_purchase_date,
               o_orderkey % 3 AS user_device_id,
               o_orderkey AS row_ord
        FROM orders WHERE o_orderstatus = 'F'""",
}

_VIEW_DEPS = {
    "friends_raw_v": ["friends_fwd_v"],
    "friends_v": ["friends_raw_v"],
}


def sql_with(*views: str) -> str:
    """``WITH`` clause defining the requested views (and what they need)."""
    ordered: list[str] = []

    def add(v: str) -> None:
        for dep in _VIEW_DEPS.get(v, []):
            add(dep)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        add(v)
    return "WITH " + ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in ordered) + "\n"


# ---------------------------------------------------------------------------
# Raw text extracts derived from the test tables, for the cleaning / typing /
# modelling operators.  Each dirty variant is chosen by key arithmetic, so
# every row of the source table is used.
# ---------------------------------------------------------------------------

# The dirty spellings injected into the raw extracts.
BOOL_SPELLINGS = ("Yes", "n/a", "0", "TRUE", "f", "other")
MISSING_SPELLINGS = ("NA", " n/a ", "Null", "none", "NaN", "")


def _pick(key, values):
    expr = None
    for i, v in enumerate(values):
        cond = (key % len(values)) == i
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


@_view
def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message extract as all-text columns, with dirty spellings."""
    o = _read(spark, sf_dir, "orders")
    return o.select(*raw_message_columns(o).values())


def raw_message_columns(o: DataFrame) -> dict:
    """The dirty message columns as expressions over the orders ``o``."""
    k = F.col("o_orderkey")
    ts = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    unpadded = F.concat_ws("-", F.year("o_orderdate").cast("string"),
                           F.month("o_orderdate").cast("string"),
                           F.dayofmonth("o_orderdate").cast("string"))
    sent = (F.when(k % 6 == 0, F.concat(ts, F.lit(".123456")))
            .when(k % 6 == 1, F.concat(ts, F.lit(" UTC")))
            .when(k % 6 == 2, day).when(k % 6 == 3, unpadded)
            .when(k % 6 == 4, F.lit("soon")).otherwise(F.lit("NULL")))
    ident = k.cast("string")
    rid = (F.when(k % 5 == 0, F.concat(ident, F.lit(".0")))
           .when(k % 5 == 1, F.concat(F.lit(" "), ident, F.lit(" ")))
           .when(k % 5 == 2, F.concat(F.lit("+"), ident))
           .when(k % 5 == 3, F.concat(F.lit("x"), ident))
           .otherwise(F.concat(ident, F.lit(".5"))))
    price = (F.when(k % 5 == 0, F.format_string("%.4f", F.col("o_totalprice")))
             .when(k % 5 == 1, F.lit("0.000")).when(k % 5 == 2, F.lit("1e2"))
             .when(k % 5 == 3, F.lit("x"))
             .otherwise(F.concat(F.lit(" "), F.format_string("%.2f", F.col("o_totalprice")),
                                 F.lit("0 "))))
    blank_all = (k % 13) == 0
    def dirty(c):  # a row with every column missing, every 13th order
        return F.when(blank_all, F.lit("NA")).otherwise(c)
    status = F.when(k % 7 == 0, _pick(k, MISSING_SPELLINGS)).otherwise(F.col("o_orderstatus"))
    columns = {"id": rid, "message_type": F.concat(F.lit("\t"), F.col("o_orderpriority"), F.lit("  ")),
               "is_purchased": _pick(k, BOOL_SPELLINGS), "sent_at": sent, "price": price, "status": status}
    return {name: dirty(c).alias(name) for name, c in columns.items()}


@_view
def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign rows with repeats per (id, type): every order proposes a
    version of its campaign; finish time NULL for every 11th."""
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    start = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    finish = F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(
        F.date_format(F.date_add(F.to_date("o_orderdate"), (k % 30).cast("int")),
                      "yyyy-MM-dd HH:mm:ss"))
    return o.select(
        F.year("o_orderdate").cast("string").alias("id"),
        F.col("o_orderpriority").alias("campaign_type"),
        F.col("o_orderstatus").alias("channel"),
        start.alias("started_at"), finish.alias("finished_at"),
        (k % 1000).cast("string").alias("total_count"),
        _pick(k, BOOL_SPELLINGS).alias("ab_test"),
        F.format_string("%.5f", F.col("o_totalprice") / 1000).alias("hour_limit"),
        (k % 97).cast("string").alias("position"),
    )


@_view
def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows carrying product attributes that disagree between rows
    (category id varies, brand missing every 5th event)."""
    e = events(spark, sf_dir)
    p = products(spark, sf_dir).select(
        "product_id", F.col("category_id").alias("base_cat"), "category_code",
        F.col("brand").alias("base_brand"))
    k = F.col("event_id")
    return e.join(p, "product_id", "left").select(
        "event_id", "event_time", "event_type", "user_id", "product_id", "price",
        (F.col("base_cat") + k % 3).alias("category_id"), "category_code",
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("base_brand")).alias("brand"),
        (F.col("user_id") * 1000 + F.dayofyear("event_time")).cast("string").alias("user_session"),
    )


_BOOL_SQL = "CASE o_orderkey % 6 " + " ".join(
    f"WHEN {i} THEN '{v}'" for i, v in enumerate(BOOL_SPELLINGS)) + " END"
_MISSING_SQL = "CASE o_orderkey % 6 " + " ".join(
    f"WHEN {i} THEN '{v}'" for i, v in enumerate(MISSING_SPELLINGS)) + " END"

SQL_VIEWS.update({
    "raw_messages_v": f"""
        SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE c.id END AS id,
               CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE c.message_type END AS message_type,
               CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE c.is_purchased END AS is_purchased,
               CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE c.sent_at END AS sent_at,
               CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE c.price END AS price,
               CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE c.status END AS status
        FROM (SELECT o_orderkey,
              CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) || '.0'
                   WHEN 1 THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
                   WHEN 2 THEN '+' || CAST(o_orderkey AS VARCHAR)
                   WHEN 3 THEN 'x' || CAST(o_orderkey AS VARCHAR)
                   ELSE CAST(o_orderkey AS VARCHAR) || '.5' END AS id,
              chr(9) || o_orderpriority || '  ' AS message_type,
              {_BOOL_SQL} AS is_purchased,
              CASE o_orderkey % 6
                   WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.123456'
                   WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' UTC'
                   WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
                   WHEN 3 THEN CAST(year(o_orderdate) AS VARCHAR) || '-'
                               || CAST(month(o_orderdate) AS VARCHAR) || '-'
                               || CAST(day(o_orderdate) AS VARCHAR)
                   WHEN 4 THEN 'soon' ELSE 'NULL' END AS sent_at,
              CASE o_orderkey % 5 WHEN 0 THEN printf('%.4f', o_totalprice)
                   WHEN 1 THEN '0.000' WHEN 2 THEN '1e2' WHEN 3 THEN 'x'
                   ELSE ' ' || printf('%.2f', o_totalprice) || '0 ' END AS price,
              CASE WHEN o_orderkey % 7 = 0 THEN {_MISSING_SQL} ELSE o_orderstatus END AS status
              FROM orders) c""",
    "raw_campaigns_v": f"""
        SELECT CAST(year(o_orderdate) AS VARCHAR) AS id, o_orderpriority AS campaign_type,
               o_orderstatus AS channel,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS started_at,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL
                    ELSE strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER),
                                  '%Y-%m-%d %H:%M:%S') END AS finished_at,
               CAST(o_orderkey % 1000 AS VARCHAR) AS total_count,
               {_BOOL_SQL} AS ab_test,
               printf('%.5f', o_totalprice / 1000) AS hour_limit,
               CAST(o_orderkey % 97 AS VARCHAR) AS position
        FROM orders""",
    "raw_events_v": """
        SELECT e.event_id, e.event_time, e.event_type, e.user_id, e.product_id, e.price,
               p.category_id + e.event_id % 3 AS category_id, p.category_code,
               CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE p.brand END AS brand,
               CAST(e.user_id * 1000 + dayofyear(e.event_time) AS VARCHAR) AS user_session
        FROM events_v e LEFT JOIN products_v p ON p.product_id = e.product_id""",
})
_VIEW_DEPS["raw_events_v"] = ["events_v", "products_v"]
