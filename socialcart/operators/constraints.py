"""Constraints over many tables at once: foreign keys (V03) in one shuffle and
schema validators (V04) compiled to one aggregate a table.

Both report and never drop rows (warn mode)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    child_key: tuple[str, ...]
    parent: str
    parent_key: tuple[str, ...]


# The eight foreign keys of the seven tables.
FOREIGN_KEYS = (
    ForeignKey("clients_user", "clients", ("user_id",), "users", ("user_id",)),
    ForeignKey("events_user", "events", ("user_id",), "users", ("user_id",)),
    ForeignKey("events_product", "events", ("product_id",), "products", ("product_id",)),
    ForeignKey("messages_campaign", "messages", ("campaign_id", "message_type"), "campaigns", ("campaign_id", "campaign_type")),
    ForeignKey("messages_client", "messages", ("client_id",), "clients", ("client_id",)),
    ForeignKey("messages_user", "messages", ("user_id",), "users", ("user_id",)),
    ForeignKey("friends_user", "friends", ("user_id",), "users", ("user_id",)),
    ForeignKey("friends_friend", "friends", ("friend_id",), "users", ("user_id",)),
)


def foreign_key_counts(tables: dict[str, DataFrame], keys: tuple[ForeignKey, ...] = FOREIGN_KEYS) -> DataFrame:
    """``(constraint_name, checked, orphans, orphan_keys)`` for every key.

    Each table is scanned once and says for each of its constraints which key
    it holds and on which side; one aggregate per (constraint, key) over the
    union tells whether a parent exists.  It combines inside each task first,
    so a key with a third of all rows moves one row a task.  Keys are compared
    as text; child rows with a NULL in the key are not checked."""
    sides: dict[str, list[Column]] = {}
    for i, k in enumerate(keys):
        for table, cols, child in ((k.child, k.child_key, 1), (k.parent, k.parent_key, 0)):
            key = F.array(*[F.col(c).cast("string") for c in cols])
            whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in cols])
            sides.setdefault(table, []).append(F.when(whole, F.struct(
                F.lit(i).alias("constraint"), key.alias("key"), F.lit(child).alias("child"), F.lit(1 - child).alias("parent"))))
    parts = [tables[t].select(F.explode(F.array_compact(F.array(*s))).alias("s")).select("s.*") for t, s in sides.items()]
    met = reduce(DataFrame.unionByName, parts).groupBy("constraint", "key").agg(
        F.sum("child").alias("rows"), F.max("parent").alias("parent"))
    orphan = F.col("parent") == 0
    counts = met.groupBy("constraint").agg(F.sum("rows").alias("checked"), F.sum(F.when(orphan, F.col("rows"))).alias("orphans"),
                                           F.count_if(orphan).alias("orphan_keys"))
    names = parts[0].sparkSession.createDataFrame([(i, k.name) for i, k in enumerate(keys)], "constraint int, constraint_name string")
    zero = F.lit(0).cast("long")
    # one row a constraint on both sides
    return names.join(F.broadcast(counts), "constraint", "left").select(
        "constraint_name", *[F.coalesce(c, zero).alias(c) for c in ("checked", "orphans", "orphan_keys")])


# The validators of the seven collections.  A path of a struct's
# field has a dot; "?" allows null; "!" requires the field to be there.
VALIDATORS: dict[str, dict[str, str]] = {
    "users": {"user_id": "string!"},
    "clients": {"client_id": "string!", "user_id": "string", "user_device_id": "string", "first_purchase_date": "date?"},
    "products": {"product_id": "string!", "category_id": "string?", "category_code": "string?",
                 "category_search_text": "string?", "brand": "string?"},
    "events": {"event_id": "string!", "event_time": "timestamp", "event_type": "string", "user_id": "string",
               "product_id": "string", "category_id": "string?", "category_code": "string?", "brand": "string?",
               "price": "decimal(38,10)", "user_session": "string"},
    "campaigns": {"campaign_pk": "string!", "campaign_id": "string", "campaign_type": "string", "channel": "string",
                  "topic": "string?", "started_at": "timestamp_ntz?", "finished_at": "timestamp_ntz?", "total_count": "int?",
                  "ab_test": "boolean?", "warmup_mode": "boolean?", "hour_limit": "decimal(38,10)?",
                  "subject_length": "decimal(38,10)?", "is_test": "boolean?", "position": "int?",
                  "subject_with_personalization": "boolean?", "subject_with_deadline": "boolean?",
                  "subject_with_emoji": "boolean?", "subject_with_bonuses": "boolean?", "subject_with_discount": "boolean?",
                  "subject_with_saleout": "boolean?"},
    "messages": {"row_id": "string!", "message_id": "string", "campaign_ref": "struct!", "campaign_ref.campaign_id": "string?",
                 "campaign_ref.campaign_type": "string?", "campaign_ref.campaign_key": "string?", "client_id": "string",
                 "user_id": "string", "channel": "string", "category": "string?", "platform": "string?",
                 "email_provider": "string?", "stream": "string?", "date": "date", "sent_at": "timestamp_ntz",
                 "engagement": "struct", "engagement.is_opened": "boolean", "engagement.opened_first_time_at": "timestamp_ntz?",
                 "engagement.opened_last_time_at": "timestamp_ntz?", "engagement.is_clicked": "boolean",
                 "engagement.clicked_first_time_at": "timestamp_ntz?", "engagement.clicked_last_time_at": "timestamp_ntz?",
                 "engagement.is_unsubscribed": "boolean", "engagement.unsubscribed_at": "timestamp_ntz?",
                 "engagement.is_hard_bounced": "boolean", "engagement.hard_bounced_at": "timestamp_ntz?",
                 "engagement.is_soft_bounced": "boolean", "engagement.soft_bounced_at": "timestamp_ntz?",
                 "engagement.is_complained": "boolean", "engagement.complained_at": "timestamp_ntz?",
                 "engagement.is_blocked": "boolean", "engagement.blocked_at": "timestamp_ntz?",
                 "engagement.is_purchased": "boolean", "engagement.purchased_at": "timestamp_ntz?",
                 "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
    "friendships": {"user_id": "string!", "friend_id": "string!"},
}


def _paths(schema: T.StructType, prefix: str = "") -> dict[str, str]:
    """Type of every field, struct fields by their dotted path."""
    out = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            out[prefix + f.name] = "struct"
            out |= _paths(f.dataType, f"{prefix}{f.name}.")
        else:
            out[prefix + f.name] = f.dataType.simpleString()
    return out


def compile_validator(schema: T.StructType, rules: dict[str, str]) -> list[tuple[str, str, Column]]:
    """(field, rule, violated): schema violations hold for every row, null
    violations where the field is null inside an object that is there."""
    have, out = _paths(schema), []
    for path, rule in rules.items():
        kind, parent = rule.rstrip("?!"), path.rpartition(".")[0]
        inside = F.col(parent).isNotNull() if parent else F.lit(True)
        if path not in have:
            if rule.endswith("!"):
                out.append((path, "required", inside if parent in have or not parent else F.lit(True)))
        elif have[path] != kind:
            out.append((path, f"type {have[path]} is not {kind}", inside & F.col(path).isNotNull()))
        elif not rule.endswith("?"):
            out.append((path, "not null", inside & F.col(path).isNull()))
    out += [(path, "additional", F.lit(True)) for path in have if path not in rules]
    return out


def validate(tables: dict[str, DataFrame], validators: dict[str, dict[str, str]] = VALIDATORS) -> DataFrame:
    """``(table_name, field, rule, violations)`` of every rule that data can
    break and every schema violation, from one aggregate a table."""
    parts = []
    for name, rules in validators.items():
        df = tables[name]
        checks = compile_validator(df.schema, rules)
        counts = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(checks)])
        rows = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(path).alias("field"), F.lit(rule).alias("rule"),
                                  F.col(f"n{i}").alias("violations")) for i, (path, rule, _) in enumerate(checks)])
        parts.append(counts.select(F.explode(rows).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)
