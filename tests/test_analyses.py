"""Q1/Q2/Q3 semantics on hand-made rows (FIXTURES §5) and variant agreement."""

from socialcart.plans import campaigns as q1
from socialcart.plans import recommend as q2
from socialcart.plans import search as q3


def _q1_inputs(spark):
    messages = spark.createDataFrame([
        # campaign 1/email: u1, u2 friends and both purchase; u3 purchases alone; u4 NULL
        ("1", "email", "u1", True), ("1", "email", "u1", False), ("1", "email", "u2", True),
        ("1", "email", "u3", True), ("1", "email", "u4", None),
        # campaign 2/push: no purchasers
        ("2", "push", "u1", False), ("2", "push", None, True),
        # campaign 9/sms: unknown campaign → dropped
        ("9", "sms", "u1", True),
    ], "campaign_id string, message_type string, user_id string, is_purchased boolean")
    campaigns = spark.createDataFrame([
        ("1", "email", "mail", "t1"), ("2", "push", "app", None), ("3", "web", "site", "t3"),
    ], "campaign_id string, campaign_type string, channel string, topic string")
    friends = spark.createDataFrame([("u1", "u2"), ("u3", "u9")], "user_id string, friend_id string")
    return messages, campaigns, friends


def test_q1_relational(spark):
    m, c, f = _q1_inputs(spark)
    rows = {(r["campaign_id"], r["message_type"]): r for r in q1.campaign_conversion(m, c, f).collect()}
    assert set(rows) == {("1", "email"), ("2", "push")}
    r1 = rows[("1", "email")]
    assert (r1["recipients"], r1["purchasers"], r1["social_purchasers"]) == (4, 3, 2)
    assert r1["conversion_rate_pct"] == 75.0 and r1["social_support_share_pct"] == 66.67
    r2 = rows[("2", "push")]
    assert (r2["recipients"], r2["purchasers"], r2["topic"]) == (1, 0, None)
    assert r2["conversion_rate_pct"] == 0.0 and r2["social_support_share_pct"] is None
    zero = {(r["campaign_id"]): r for r in q1.campaign_conversion(m, c, f, zero_as_null=False).collect()}
    assert zero["2"]["social_support_share_pct"] == 0.0


def test_q1_order_and_rounding(spark):
    m, c, f = _q1_inputs(spark)
    got = [r["campaign_id"] for r in q1.campaign_conversion(m, c, f).collect()]
    assert got == ["1", "2"]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 8), (1, 3), (5, 0)], "p long, r long")
    up = [r[0] for r in df.select(q1.pct(F.col("p"), F.col("r"))).collect()]
    even = [r[0] for r in df.select(q1.pct(F.col("p"), F.col("r"), rounding="half_even")).collect()]
    assert up == [12.5, 33.33, None] and even == [12.5, 33.33, None]
    df2 = spark.createDataFrame([(1, 800)], "p long, r long")
    assert df2.select(q1.pct(F.col("p"), F.col("r"))).first()[0] == 0.13
    assert df2.select(q1.pct(F.col("p"), F.col("r"), rounding="half_even")).first()[0] == 0.12


def test_q1_graph_lists_campaign_without_messages(spark):
    nodes = spark.createDataFrame([("1|email", "1", "email", "mail", "t"), ("3|web", "3", "web", "site", None)],
                                  "campaign_key string, campaign_id string, campaign_type string, "
                                  "channel string, topic string")
    received = spark.createDataFrame([("u1", "1|email"), ("u2", "1|email")], "user_id string, campaign_key string")
    purchased = spark.createDataFrame([("u1", "1|email")], "user_id string, campaign_key string")
    fo = spark.createDataFrame([("u1", "u2")], "user_id string, friend_id string")
    rows = {r["campaign_id"]: r for r in q1.campaign_conversion_graph(nodes, received, purchased, fo).collect()}
    assert rows["3"]["recipients"] == 0 and rows["3"]["conversion_rate_pct"] == 0.0
    assert rows["1"]["conversion_rate_pct"] == 50.0 and rows["1"]["social_purchasers"] == 0


def _q2_inputs(spark):
    ev = []
    eid = 0
    def add(u, p, t):
        nonlocal eid
        eid += 1
        ev.append((eid, u, t, p))
    for _ in range(5):
        add("t1", "own", "view")          # target activity
    add("t1", "signup_only", "signup")     # non-recommendation type on its own product
    add("f1", "pA", "purchase"); add("f1", "pA", "view"); add("f1", "pB", "cart")
    add("f2", "pB", "cart"); add("f2", "own", "purchase"); add("f2", "signup_only", "view")
    add("f2", "pMissing", "view"); add("f2", "pC", "error")
    events = spark.createDataFrame(ev, "event_id long, user_id string, event_type string, product_id string")
    friends = spark.createDataFrame([("t1", "f1"), ("f2", "t1")], "user_id string, friend_id string")
    products = spark.createDataFrame([("pA", "a.b", "BA"), ("pB", "c", "BB"), ("signup_only", "s", "S")],
                                     "product_id string, category_code string, brand string")
    return events, friends, products


def test_q2_relational_and_graph(spark):
    e, f, p = _q2_inputs(spark)
    rel = [(r["target_user_id"], r["product_id"], r["weighted_score"], r["interactions"], r["brand"],
            r["rank_in_user"]) for r in q2.recommendations(e, f, p, n_targets=1).collect()]
    assert rel == [("t1", "pA", 4, 2, "BA", 1), ("t1", "pB", 4, 2, "BB", 2),
                   ("t1", "pMissing", 1, 1, None, 3)]
    graph = [r["product_id"] for r in q2.recommendations(
        e, f, p, n_targets=1, activity_types=q2.REC_TYPES, own_types=q2.REC_TYPES).collect()]
    assert graph == ["pA", "pB", "pMissing", "signup_only"]
    arr = q2.recommendations(e, f, p, n_targets=1, method="array").collect()
    assert [tuple(r) for r in arr] == [tuple(r) for r in q2.recommendations(e, f, p, n_targets=1).collect()]


def test_q2_pair_stored_both_ways_counts_twice(spark):
    e, f, p = _q2_inputs(spark)
    f2 = f.unionByName(spark.createDataFrame([("f1", "t1")], "user_id string, friend_id string"))
    a = {r["product_id"]: r["weighted_score"] for r in q2.recommendations(e, f2, p, n_targets=1).collect()}
    b = {r["product_id"]: r["weighted_score"] for r in
         q2.recommendations(e, f2, p, n_targets=1, dedupe_edges=True).collect()}
    assert a["pA"] == 8 and b["pA"] == 4


def test_q3_tokens_and_search(spark):
    products = spark.createDataFrame(
        [(1, "electronics.smartphone", "Apple"), (2, ".tv..kids", "LG"), (3, None, "x"),
         (4, "electronics.tv", "Sony"), (5, "kids.electronics.electronics", None)],
        "product_id long, category_code string, brand string")
    recs = spark.createDataFrame([(1,), (2,), (4,), (5,)], "product_id long")
    kws = [r["keyword"] for r in q3.keywords(recs, products).collect()]
    assert kws == ["electronics", "kids", "smartphone"]
    rows = q3.token_search(q3.keywords(recs, products), products).collect()
    top = [(r["keyword"], r["product_id"], r["text_score"]) for r in rows]
    assert top[:3] == [("electronics", 5, 2.0), ("electronics", 1, 1.0), ("electronics", 4, 1.0)]
    bm = q3.token_search(q3.keywords(recs, products), products, score="bm25").collect()
    assert all(r["text_score"] > 0 for r in bm)
    sub = q3.substring_search(spark.createDataFrame([("tv",)], "keyword string"), products).collect()
    assert [r["product_id"] for r in sub] == [2, 4]


def test_q3_fallback_switch(spark):
    products = spark.createDataFrame([(1, "smartphones.x", "A")], "product_id long, category_code string, "
                                                                  "brand string")
    kw = spark.createDataFrame([("smartphone",)], "keyword string")
    rows = q3.fallback_search(kw, products).collect()
    assert [(r["product_id"], r["text_score"]) for r in rows] == [(1, 0.0)]
