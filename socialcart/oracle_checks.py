"""DuckDB SQL for the constraints over the whole model."""

from __future__ import annotations

from socialcart.sources.testviews import sql_with

_FLAGS = ("opened", "clicked", "unsubscribed", "hard_bounced", "soft_bounced", "complained", "blocked", "purchased")
# table, source of its rows, columns that may not be null (name, column)
_NOT_NULL = [
    ("users", "users", [("user_id", "user_id")]),
    ("clients", "clients_dim", [(c, c) for c in ("client_id", "user_id", "user_device_id")]),
    ("products", "(SELECT DISTINCT product_id FROM raw_events_v WHERE product_id IS NOT NULL)", [("product_id", "product_id")]),
    ("events", "(FROM raw_events_v WHERE user_id IS NOT NULL AND product_id IS NOT NULL)",
     [(c, c) for c in ("event_id", "event_time", "event_type", "user_id", "product_id", "price", "user_session")]),
    ("campaigns", "campaigns_full", [(c, c) for c in ("campaign_pk", "campaign_id", "campaign_type", "channel")]),
    ("messages", "typed_messages_v",
     [(c, c) for c in ("row_id", "message_id", "client_id", "user_id", "channel", "date", "sent_at", "created_at", "updated_at")]
     + [(f"engagement.is_{f}", f"is_{f}") for f in _FLAGS] + [("campaign_ref", "1"), ("engagement", "1")]),
    ("friendships", "friends_v", [("user_id", "user_id"), ("friend_id", "friend_id")]),
]


def _fk(name: str, child: str, cols: tuple[str, ...], parent: str, pcols: tuple[str, ...]) -> str:
    on = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(cols, pcols))
    there = " AND ".join(f"c.{a} IS NOT NULL" for a in cols)
    lost = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE {on})"
    keys = ", ".join(f"c.{a}" for a in cols)
    return (f"SELECT '{name}' AS constraint_name, count(*) AS checked, count(*) FILTER (lost) AS orphans,"
            f" count(DISTINCT k) FILTER (lost) AS orphan_keys FROM (SELECT ({keys}) AS k, {lost} AS lost FROM {child} c WHERE {there})")


def oracle(clients_dim: str, users: str) -> dict[str, str]:
    base = sql_with("clients_v", "events_v", "messages_v", "friends_raw_v", "products_v", "campaigns_v", "friends_v")
    user = ("user_id",)
    keys = " UNION ALL ".join([
        _fk("clients_user", "clients_dim", user, "known", user), _fk("events_user", "events_v", user, "known", user),
        _fk("events_product", "events_v", ("product_id",), "products_v", ("product_id",)),
        _fk("messages_campaign", "messages_v", ("campaign_id", "message_type"), "topics", ("campaign_id", "campaign_type")),
        _fk("messages_client", "messages_v", ("client_id",), "clients_dim", ("client_id",)),
        _fk("messages_user", "messages_v", user, "known", user), _fk("friends_user", "friends_v", user, "known", user),
        _fk("friends_friend", "friends_v", ("friend_id",), "known", user)])
    nulls = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS field, 'not null' AS rule, count(*) FILTER ({col} IS NULL) AS violations FROM {source}"
        for table, source, cols in _NOT_NULL for name, col in cols)
    from socialcart.oracle_documents import _VERSION_ORDER

    order = ", ".join(f"{c} DESC NULLS LAST" for c in _VERSION_ORDER)
    return {
        "dq_foreign_keys": base + f""", {clients_dim},
known AS (SELECT user_id FROM clients_dim UNION SELECT user_id FROM events_v),
topics AS (SELECT * FROM campaigns_v WHERE topic IS NOT NULL)
{keys}""",
        "dq_validators": sql_with("clients_v", "events_v", "messages_v", "friends_raw_v", "products_v", "campaigns_v", "friends_v",
                                  "raw_events_v", "typed_messages_v", "campaign_versions_v") + f""", {users}, {clients_dim},
campaigns_full AS (SELECT * FROM campaign_versions_v
    QUALIFY row_number() OVER (PARTITION BY campaign_id, campaign_type ORDER BY {order}) = 1)
{nulls}
UNION ALL SELECT 'messages', 'user_device_id', 'additional', count(*) FROM typed_messages_v""",
    }
