"""DuckDB SQL for the ingest queries: what each raw line must become, from the
rows that the lines were written from."""

from __future__ import annotations

from socialcart.registry_ingest import FRIEND_COLUMNS, LONG_EVERY, MESSAGE_COLUMNS, MESSAGE_FILES, SHORT_EVERY
from socialcart.sources.testviews import SQL_VIEWS, sql_with


def _line(columns: list[str]) -> str:
    text = [f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns]
    return (f"CASE WHEN k % {LONG_EVERY} = 0 THEN concat_ws(',', {', '.join(text)}, 'extra')"
            f" WHEN k % {SHORT_EVERY} = 0 THEN concat_ws(',', {', '.join(text[:-1])}) ELSE concat_ws(',', {', '.join(text)}) END")


def oracle() -> dict[str, str]:
    from socialcart.oracle_model import _bool, _datetime, _integer, _missing, _price

    keyed = SQL_VIEWS["raw_messages_v"].replace("SELECT CASE", "SELECT o_orderkey AS k, CASE", 1)
    last = f"CASE WHEN k % {SHORT_EVERY} = 0 THEN NULL ELSE status END"
    base = sql_with("friends_raw_v") + f""",
keyed AS ({keyed}),
sent AS (
    SELECT k, 'messages_' || (k % {MESSAGE_FILES}) AS extract, {_line(MESSAGE_COLUMNS)} AS raw, * EXCLUDE (k, status),
           {last} AS status FROM keyed),
cleaned AS (
    SELECT k, extract, raw, {_integer('id')} AS id, {_missing('message_type')} AS message_type,
           {_bool('is_purchased')} AS is_purchased, {_datetime('sent_at')} AS sent_at, {_price('price')} AS price,
           {_missing('status')} AS status FROM sent),
pairs AS (SELECT *, friend1 * 1000 + friend2 AS k FROM friends_raw_v),
outcomes AS (
    SELECT extract, raw, CASE WHEN k % {LONG_EVERY} = 0 THEN 'malformed'
        WHEN concat(id, message_type, is_purchased, sent_at, price, status) = '' THEN 'empty' ELSE 'kept' END AS reason
    FROM cleaned
    UNION ALL
    SELECT 'friends_' || (friend1 % 2), {_line(FRIEND_COLUMNS)},
        CASE WHEN k % {LONG_EVERY} = 0 THEN 'malformed' ELSE 'kept' END FROM pairs)"""
    return {
        "ingest_kept": base + f"""
SELECT extract, {', '.join(MESSAGE_COLUMNS)} FROM cleaned
WHERE k % {LONG_EVERY} <> 0 AND concat(id, message_type, is_purchased, sent_at, price, status) <> ''""",
        "ingest_metrics": base + """
SELECT extract, count(*) FILTER (reason = 'kept') AS kept, count(*) FILTER (reason = 'empty') AS skipped_empty,
       count(*) FILTER (reason = 'malformed') AS skipped_malformed FROM outcomes GROUP BY extract""",
        "ingest_rejects": base + "\nSELECT extract, raw, reason FROM outcomes WHERE reason <> 'kept'",
    }
