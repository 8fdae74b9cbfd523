"""DuckDB SQL for the queries over full extracts and documents."""

from __future__ import annotations

from socialcart.plans.documents import STEPS
from socialcart.sources import extracts  # noqa: F401 - adds the views
from socialcart.sources.testviews import sql_with

_VERSION_ORDER = ("finished_at", "started_at", "campaign_pk", "channel", "topic", "total_count", *extracts.CAMPAIGN_BOOLEANS,
                  "hour_limit", "subject_length", "position")


def oracle() -> dict[str, str]:
    from socialcart.oracle_sql import _Q2_SELECT, _q1, q2_sql

    steps = " UNION ALL ".join(
        f"SELECT campaign_id || '|' || message_type AS campaign_key, '{s}' AS step, coalesce(is_purchased, false) AS bought, {t} AS moment"
        f" FROM typed_messages_v WHERE is_{s}" for s, t in STEPS.items())
    order = ", ".join(f"{c} DESC NULLS LAST" for c in _VERSION_ORDER)
    return {
        "typed_messages_full": sql_with("typed_messages_v") + "SELECT * FROM typed_messages_v",
        "typed_campaigns_full": sql_with("campaign_versions_v") + f"""
SELECT * FROM campaign_versions_v
QUALIFY row_number() OVER (PARTITION BY campaign_id, campaign_type ORDER BY {order}) = 1""",
        "messages_document_form": sql_with("typed_messages_v") + """
SELECT * EXCLUDE (message_type), message_type AS campaign_type, campaign_id || '|' || message_type AS campaign_key
FROM typed_messages_v""",
        "q1_nested": _q1("0.0", even=True, messages="typed_messages_v"),
        "q2_nested": q2_sql() + _Q2_SELECT,
        "engagement_funnel": sql_with("typed_messages_v") + f"""
SELECT campaign_key, step, count(*) AS messages, count(*) FILTER (bought) AS with_purchase, min(moment) AS first_at
FROM ({steps}) GROUP BY ALL""",
    }
