"""Q1 — campaign conversion with a social-support signal.

For each campaign (campaign_id, message_type) with its channel and topic:
recipients, purchasers, conversion %, purchasers with at least one friend who
also purchased in the same campaign, and that share %.

Plan shape (see README, "Q1 plan"):

1. messages → ``(campaign, type, user, did_purchase)`` — one hash aggregate
   with map-side combine; the only pass over the message fact.
2. per-campaign counts from (1) — partial aggregation, so a campaign that
   holds a third of all messages is combined before the shuffle.
3. social purchasers: edges are first cut to buyer↔buyer pairs (two semi
   joins against the distinct buyers), then purchasers ⋈ those undirected
   edges on user, a semi join back to purchasers on (campaign, type,
   friend), distinct.  The edge join is the only data-sized join; AQE
   splits hot users.
4. The campaign dimension joins only the per-campaign aggregates (one row
   per campaign), never the message fact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from socialcart.operators.hub_join import supported_buyers
from socialcart.operators.joins import bounded_broadcast, hot_keys, salted_join, undirected

CAMPAIGN_KEY = ["campaign_id", "message_type"]
RESULT_COLUMNS = [
    "campaign_id", "message_type", "channel", "topic", "recipients", "purchasers",
    "conversion_rate_pct", "social_purchasers", "social_support_share_pct",
]


def pct(part: Column, whole: Column, zero_as_null: bool = True,
        rounding: str = "half_up") -> Column:
    """``round(100.0 * part / whole, 2)`` on exact decimals, as double.

    ``zero_as_null``: NULL when ``whole`` is 0 (relational form), else 0.0
    (document and graph forms).  ``rounding``: ``half_up`` (relational) or
    ``half_even`` (document form).
    """
    ratio = F.lit(Decimal("100.0")) * part / F.nullif(whole, F.lit(0))
    rounded = F.round(ratio, 2) if rounding == "half_up" else F.bround(ratio, 2)
    out = rounded.cast("double")
    return out if zero_as_null else F.coalesce(out, F.lit(0.0))


def campaign_users(messages: DataFrame) -> DataFrame:
    """Q1-b/c: one row per (campaign_id, message_type, user_id) with
    ``did_purchase`` = any message of the user in the campaign purchased
    (NULL counts as false)."""
    return (messages.where(F.col("user_id").isNotNull())
            .groupBy(*CAMPAIGN_KEY, "user_id")
            .agg(F.bool_or(F.coalesce(F.col("is_purchased"), F.lit(False))).alias("did_purchase")))


def campaign_user_stats(messages: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Q1-a…c as a table: campaign-user rows with channel and topic, only for
    known campaigns (inner join on both key columns)."""
    dim = bounded_broadcast(campaigns.select(
        F.col("campaign_id"), F.col("campaign_type").alias("message_type"), "channel", "topic"))
    return campaign_users(messages).join(dim, CAMPAIGN_KEY).select(
        *CAMPAIGN_KEY, "channel", "topic", "user_id", "did_purchase")


def buyer_edges(friends: DataFrame, buyer_users: DataFrame) -> DataFrame:
    """Friend edges whose two ends both purchased in some campaign.

    Only such edges can make a purchaser "social", so filtering them before
    the (campaign × friend) fan-out keeps the largest intermediate of Q1
    proportional to buyer-buyer edges instead of all edges of buyers.  Two
    semi joins against the distinct buyer set (AQE broadcasts it when small).
    """
    u = buyer_users.select("user_id")
    return (friends.join(u, "user_id", "left_semi")
            .join(u.select(F.col("user_id").alias("friend_id")), "friend_id", "left_semi"))


def social_purchasers(cu: DataFrame, friends: DataFrame, salt_buckets: int = 0,
                      hot_min_rows: int = 1_000_000, by_degree: bool = False) -> DataFrame:
    """Q1-d/e: purchasers with at least one friend who purchased in the same
    campaign → distinct ``(campaign_id, message_type, user_id)``.

    ``salt_buckets > 1`` splits users with at least ``hot_min_rows`` edges
    over that many tasks in the edge fan-out join (explicit salting, for
    clusters without AQE skew handling); ``by_degree`` orders every pair by
    the degrees of its ends instead (``operators.hub_join``), which needs no
    setting; otherwise AQE splits hot users."""
    buyers = cu.where("did_purchase").select(*CAMPAIGN_KEY, "user_id")
    if by_degree:
        return supported_buyers(buyers, buyer_edges(friends, buyers.select("user_id").distinct()), CAMPAIGN_KEY)
    edges = undirected(buyer_edges(friends, buyers.select("user_id").distinct()),
                       "user_id", "friend_id")
    if salt_buckets > 1:
        reach = salted_join(edges, buyers, "user_id", hot_keys(edges, "user_id", hot_min_rows),
                            salt_buckets)
    else:
        reach = buyers.join(edges, "user_id")  # (campaign, type, user, friend)
    friend_buyers = buyers.select(*CAMPAIGN_KEY, F.col("user_id").alias("friend_id"))
    return (reach.join(friend_buyers, CAMPAIGN_KEY + ["friend_id"], "left_semi")
            .select(*CAMPAIGN_KEY, "user_id").distinct())


def campaign_conversion(messages: DataFrame, campaigns: DataFrame, friends: DataFrame,
                        top_n: int | None = 20, zero_as_null: bool = True,
                        rounding: str = "half_up", tie_break: str = "key",
                        salt_buckets: int = 0, hot_min_rows: int = 1_000_000, by_degree: bool = False) -> DataFrame:
    """Q1: the full report, best conversion first (top ``top_n``).

    ``tie_break='key'`` orders remaining ties by (campaign_id, message_type);
    ``'numeric_desc'`` (document form) first by the campaign id as a number,
    descending, 0 when it is not numeric."""
    cu = campaign_users(messages)
    counts = cu.groupBy(*CAMPAIGN_KEY).agg(
        F.count(F.lit(1)).alias("recipients"),
        F.count_if(F.col("did_purchase")).alias("purchasers"))
    social = (social_purchasers(cu, friends, salt_buckets, hot_min_rows, by_degree)
              .groupBy(*CAMPAIGN_KEY).agg(F.count(F.lit(1)).alias("social_purchasers")))
    dim = campaigns.select(F.col("campaign_id"), F.col("campaign_type").alias("message_type"),
                           "channel", "topic")
    out = (counts.join(dim, CAMPAIGN_KEY)
           .join(social, CAMPAIGN_KEY, "left")
           .select(
               *CAMPAIGN_KEY, "channel", "topic", "recipients", "purchasers",
               pct(F.col("purchasers"), F.col("recipients"), zero_as_null, rounding)
               .alias("conversion_rate_pct"),
               F.coalesce(F.col("social_purchasers"), F.lit(0)).cast("bigint")
               .alias("social_purchasers"),
               pct(F.coalesce(F.col("social_purchasers"), F.lit(0)), F.col("purchasers"),
                   zero_as_null, rounding).alias("social_support_share_pct")))
    order = [F.col("conversion_rate_pct").desc_nulls_last(), F.col("purchasers").desc()]
    if tie_break == "numeric_desc":
        order.append(F.coalesce(F.col("campaign_id").try_cast("bigint"), F.lit(0)).desc())
    out = out.orderBy(*order, F.col("campaign_id").asc(), F.col("message_type").asc())
    return out.limit(top_n) if top_n else out


# ---------------------------------------------------------------------------
# Graph form (M1, M5, M6): recipients are all users of the receiving client,
# every campaign is listed, empty ratios are 0.
# ---------------------------------------------------------------------------

def campaign_conversion_graph(campaign_nodes: DataFrame, received: DataFrame,
                              purchased: DataFrame, friend_of: DataFrame,
                              top_n: int | None = 20) -> DataFrame:
    """Q1-j over helper edges ``received``/``purchased`` = (user_id, campaign_key).

    ``campaign_nodes`` carries campaign_key, campaign_id, campaign_type,
    channel, topic.  Each per-campaign count is one grouped aggregate; the
    campaigns are the preserved side of left joins (OPTIONAL MATCH).
    """
    rec = received.groupBy("campaign_key").agg(F.count(F.lit(1)).alias("recipients"))
    pur = purchased.groupBy("campaign_key").agg(F.count(F.lit(1)).alias("purchasers"))
    edges = undirected(buyer_edges(friend_of, purchased.select("user_id").distinct()),
                       "user_id", "friend_id")
    reach = purchased.join(edges, "user_id")
    fb = purchased.select("campaign_key", F.col("user_id").alias("friend_id"))
    soc = (reach.join(fb, ["campaign_key", "friend_id"], "left_semi")
           .select("campaign_key", "user_id").distinct()
           .groupBy("campaign_key").agg(F.count(F.lit(1)).alias("social_purchasers")))
    r = F.coalesce(F.col("recipients"), F.lit(0))
    p = F.coalesce(F.col("purchasers"), F.lit(0))
    s = F.coalesce(F.col("social_purchasers"), F.lit(0))
    out = (campaign_nodes.join(rec, "campaign_key", "left").join(pur, "campaign_key", "left")
           .join(soc, "campaign_key", "left")
           .select(F.col("campaign_id"), F.col("campaign_type").alias("message_type"),
                   "channel", "topic",
                   r.cast("bigint").alias("recipients"), p.cast("bigint").alias("purchasers"),
                   pct(p, r, zero_as_null=False).alias("conversion_rate_pct"),
                   s.cast("bigint").alias("social_purchasers"),
                   pct(s, p, zero_as_null=False).alias("social_support_share_pct")))
    out = out.orderBy(F.col("conversion_rate_pct").desc(), F.col("purchasers").desc(),
                      F.col("campaign_id").asc(), F.col("message_type").asc())
    return out.limit(top_n) if top_n else out
