"""Full-width text extracts derived from the test tables: messages (34
columns) and campaigns (19 columns), with dirty spellings chosen by key
arithmetic, and the typed rows that they stand for as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from socialcart.plans.load import CAMPAIGN_BOOLEANS, MESSAGE_FLAGS, MESSAGE_TIMES
from socialcart.sources.testviews import BOOL_SPELLINGS, SQL_VIEWS, _pick, _read

NO_CLIENT_EVERY = 17   # o_orderkey % 17 == 0 → the message has no client
NO_FINISH_EVERY = 11   # o_orderkey % 11 == 0 → the campaign version has no finish time
TASKS_PER_CORE = 3
# What each of BOOL_SPELLINGS means.
_BOOL_MEANING = ("TRUE", "NULL", "FALSE", "TRUE", "FALSE", "NULL")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, dealt evenly: cleaning takes far longer than reading, and a
    small file, or one with few row groups, is read by few tasks."""
    return _read(spark, sf_dir, "orders").repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def _time_text(ts: Column, key: Column) -> Column:
    """A date-time in one of three spellings, or missing."""
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return (F.when(key % 4 == 0, F.concat(text, F.lit(".123456"))).when(key % 4 == 1, F.concat(text, F.lit(" UTC")))
            .when(key % 4 == 2, text).otherwise("NaN"))


def message_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per order, all 34 columns as text."""
    o = _orders(spark, sf_dir)
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    text = k.cast("string")
    unpadded = F.concat_ws("-", F.year(ts).cast("string"), F.month(ts).cast("string"), F.dayofmonth(ts).cast("string"))
    cols = {
        "id": F.when(k % 5 == 0, F.concat(text, F.lit(".0"))).otherwise(text),
        "message_id": F.concat(F.lit("m"), F.expr("o_orderkey div 2").cast("string")),
        "campaign_id": F.year(ts).cast("string"),
        "message_type": F.concat(F.lit("\t"), F.col("o_orderpriority"), F.lit("  ")),
        "client_id": F.when(k % NO_CLIENT_EVERY == 0, "NA").otherwise(F.concat(F.expr("o_custkey div 2").cast("string"), F.lit(".0"))),
        "channel": _pick(k, ("email", "push", "None")),
        "category": _pick(k, ("null", "promo_1", "promo_2", "promo_3")),
        "platform": F.col("o_orderstatus"),
        "email_provider": _pick(k, ("gmail.com", " n/a ")),
        "stream": _pick(k, ("", "desktop", "desktop", "mobile", "mobile")),
        "date": F.when(k % 3 == 0, unpadded).otherwise(F.date_format(ts, "yyyy-MM-dd")),
        "sent_at": F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        "user_device_id": F.concat((k % 5).cast("string"), F.lit(".0")),
        "user_id": F.col("o_custkey").cast("string"),
    }
    for i, name in enumerate(MESSAGE_FLAGS):
        cols[f"is_{name}"] = _pick(k + i, BOOL_SPELLINGS)
    cols["is_purchased"] = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "f").otherwise("n/a")
    for j, name in enumerate(MESSAGE_TIMES):
        cols[name] = _time_text(ts + F.expr(f"INTERVAL {j + 1} HOURS"), k + j)
    return o.select(*[c.alias(n) for n, c in cols.items()])


def campaign_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign versions, one per order, all 19 columns as text."""
    o = _orders(spark, sf_dir)
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    cols = {
        "id": F.concat(F.year(ts).cast("string"), F.lit(".0")),
        "campaign_type": F.col("o_orderpriority"),
        "channel": _pick(k, ("email", "push", "None")),
        "topic": F.concat(F.lit(" topic_"), (k % 7).cast("string")),
        "started_at": F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        "finished_at": F.when(k % NO_FINISH_EVERY == 0, "NULL").otherwise(
            F.date_format(ts + F.expr("make_interval(0, 0, 0, int(o_orderkey % 30))"), "yyyy-MM-dd HH:mm:ss")),
        "total_count": F.concat((k % 1000).cast("string"), F.lit(".0")),
        "hour_limit": (k % 24).cast("string"),
        "subject_length": F.concat((k % 90).cast("string"), F.lit(".5")),
        "position": (k % 97).cast("string"),
    }
    for i, name in enumerate(CAMPAIGN_BOOLEANS):
        cols[name] = _pick(k + i, BOOL_SPELLINGS)
    return o.select(*[c.alias(n) for n, c in cols.items()])


def _flag_sql(shift: int) -> str:
    return f"CASE (o_orderkey + {shift}) % {len(_BOOL_MEANING)} " + " ".join(
        f"WHEN {i} THEN {v}" for i, v in enumerate(_BOOL_MEANING)) + " END"


_FLAGS = ",\n".join(f"{_flag_sql(i)} AS is_{n}" for i, n in enumerate(MESSAGE_FLAGS) if n != "purchased")
_TIMES = ",\n".join(f"CASE WHEN (o_orderkey + {j}) % 4 <> 3 THEN o_orderdate + INTERVAL {j + 1} HOUR END AS {n}"
                    for j, n in enumerate(MESSAGE_TIMES))

SQL_VIEWS["typed_messages_v"] = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS row_id, 'm' || (o_orderkey // 2) AS message_id,
           CAST(year(o_orderdate) AS VARCHAR) AS campaign_id, o_orderpriority AS message_type,
           CAST(o_custkey // 2 AS VARCHAR) AS client_id, CAST(o_custkey AS VARCHAR) AS user_id,
           CASE o_orderkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'push' END AS channel,
           CASE WHEN o_orderkey % 4 > 0 THEN 'promo_' || (o_orderkey % 4) END AS category,
           o_orderstatus AS platform, CASE WHEN o_orderkey % 2 = 0 THEN 'gmail.com' END AS email_provider,
           CASE WHEN o_orderkey % 5 IN (1, 2) THEN 'desktop' WHEN o_orderkey % 5 > 2 THEN 'mobile' END AS stream,
           CAST(o_orderdate AS DATE) AS date, o_orderdate AS sent_at, {_FLAGS},
           CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS is_purchased, {_TIMES},
           CAST(o_orderkey % 5 AS VARCHAR) AS user_device_id
    FROM orders WHERE o_orderkey % {NO_CLIENT_EVERY} <> 0"""

_CAMPAIGN_FLAGS = ", ".join(f"{_flag_sql(i)} AS {n}" for i, n in enumerate(CAMPAIGN_BOOLEANS))
SQL_VIEWS["campaign_versions_v"] = f"""
    SELECT year(o_orderdate) || '|' || o_orderpriority AS campaign_pk, CAST(year(o_orderdate) AS VARCHAR) AS campaign_id,
           o_orderpriority AS campaign_type, CASE o_orderkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'push' END AS channel,
           'topic_' || (o_orderkey % 7) AS topic, o_orderdate AS started_at,
           CASE WHEN o_orderkey % {NO_FINISH_EVERY} <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) END AS finished_at,
           CAST(o_orderkey % 1000 AS INTEGER) AS total_count, {_CAMPAIGN_FLAGS},
           CAST(o_orderkey % 24 AS DECIMAL(38,10)) AS hour_limit, CAST(o_orderkey % 90 + 0.5 AS DECIMAL(38,10)) AS subject_length,
           CAST(o_orderkey % 97 AS INTEGER) AS position
    FROM orders"""
