"""A hot key holding a third of the rows: results stay whole and exact
under AQE skew splitting (brute force in plain Python as the reference)."""

import random
from collections import defaultdict

import pytest

from socialcart.plans import campaigns as q1
from socialcart.plans import recommend as q2

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data(seed=7, n_users=300):
    rnd = random.Random(seed)
    users = [f"u{i}" for i in range(n_users)]
    hub = "u0"
    edges = set()
    for u in users[1:]:
        if rnd.random() < 0.5:
            edges.add((hub, u))        # the hub: about a third of all edges
        for _ in range(2):
            v = rnd.choice(users[1:])
            if v != u:
                edges.add((u, v))
    msgs = []
    for i in range(3000):
        u = hub if i % 3 == 0 else rnd.choice(users)  # the hub: a third of the messages
        msgs.append((str(2000 + i % 3), "email", u, rnd.random() < 0.3))
    events = []
    for i in range(3000):
        u = hub if i % 3 == 0 else rnd.choice(users)
        events.append((i, u, rnd.choice(["view", "cart", "purchase", "error"]), rnd.randrange(40)))
    return sorted(edges), msgs, events


def _brute_q1(edges, msgs):
    did = defaultdict(bool)
    for c, t, u, p in msgs:
        did[(c, t, u)] = did[(c, t, u)] or bool(p)
    nb = defaultdict(set)
    for a, b in edges:
        nb[a].add(b)
        nb[b].add(a)
    out = {}
    for (c, t, u), p in did.items():
        r = out.setdefault((c, t), [0, 0, 0])
        r[0] += 1
        if p:
            r[1] += 1
            if any(did.get((c, t, f)) for f in nb[u]):
                r[2] += 1
    return {k: tuple(v) for k, v in out.items()}


def test_q1_under_skew(spark, skew_conf):
    edges, msgs, _ = _data()
    m = spark.createDataFrame(msgs, "campaign_id string, message_type string, user_id string, "
                                    "is_purchased boolean")
    c = spark.createDataFrame([(str(y), "email", "mail", None) for y in (2000, 2001, 2002)],
                              "campaign_id string, campaign_type string, channel string, topic string")
    f = spark.createDataFrame(edges, "user_id string, friend_id string")
    got = {(r["campaign_id"], r["message_type"]): (r["recipients"], r["purchasers"], r["social_purchasers"])
           for r in q1.campaign_conversion(m, c, f, top_n=None).collect()}
    assert got == _brute_q1(edges, msgs)


def _brute_q2(edges, events, n_targets=100, k=5):
    act = defaultdict(int)
    for _, u, _, _ in events:
        act[u] += 1
    targets = [u for u, _ in sorted(act.items(), key=lambda x: (-x[1], x[0]))[:n_targets]]
    w = {"purchase": 3, "cart": 2, "view": 1}
    own = {(u, p) for _, u, _, p in events}
    out = []
    for t in targets:
        friends = [b for a, b in edges if a == t] + [a for a, b in edges if b == t]
        score, n = defaultdict(int), defaultdict(int)
        for f in friends:
            for _, u, et, p in events:
                if u == f and et in w:
                    score[p] += w[et]
                    n[p] += 1
        cands = sorted(((-score[p], -n[p], p) for p in score if (t, p) not in own))
        out += [(t, p, -s, -c, i + 1) for i, (s, c, p) in enumerate(cands[:k])]
    return sorted(out)


@pytest.mark.parametrize("broadcast_max_rows", [0, 1_000_000])
def test_q2_under_skew(spark, skew_conf, broadcast_max_rows):
    edges, _, events = _data()
    e = spark.createDataFrame(events, "event_id long, user_id string, event_type string, product_id long")
    f = spark.createDataFrame(edges, "user_id string, friend_id string")
    p = spark.createDataFrame([(i, f"c{i}", "b") for i in range(40)],
                              "product_id long, category_code string, brand string")
    got = sorted((r["target_user_id"], r["product_id"], r["weighted_score"], r["interactions"],
                  r["rank_in_user"]) for r in
                 q2.recommendations(e, f, p, broadcast_max_rows=broadcast_max_rows).collect())
    assert got == _brute_q2(edges, events)


def test_q1_salted_without_aqe(spark):
    """Explicit salting gives the same result with AQE switched off."""
    edges, msgs, _ = _data()
    m = spark.createDataFrame(msgs, "campaign_id string, message_type string, user_id string, "
                                    "is_purchased boolean")
    c = spark.createDataFrame([(str(y), "email", "mail", None) for y in (2000, 2001, 2002)],
                              "campaign_id string, campaign_type string, channel string, topic string")
    f = spark.createDataFrame(edges, "user_id string, friend_id string")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = q1.campaign_conversion(m, c, f, top_n=None, salt_buckets=8, hot_min_rows=20)
        got = {(r["campaign_id"], r["message_type"]): (r["recipients"], r["purchasers"],
                                                       r["social_purchasers"]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert got == _brute_q1(edges, msgs)
