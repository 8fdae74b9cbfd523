"""Modelling, graph and check operators on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from socialcart.operators import graph as G
from socialcart.operators import model as M
from socialcart.operators import quality as V


def test_friend_edges_directed_distinct(spark):
    raw = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "a"), ("a", "b"), (None, "c")],
                                "friend1 string, friend2 string")
    assert sorted(tuple(r) for r in M.friend_edges(raw).collect()) == [("a", "b"), ("b", "a")]


def test_clients_best_row_and_message_only(spark):
    d = dt.date
    clients = spark.createDataFrame(
        [("c1", "u2", d(2020, 1, 2), "x"), ("c1", "u1", d(2020, 1, 1), None),
         ("c1", "u0", None, "a"), ("c2", None, None, "z")],
        "client_id string, user_id string, first_purchase_date date, user_device_id string")
    best = {r["client_id"]: r for r in M.clients_dim(clients).collect()}
    assert best["c1"]["user_id"] == "u1" and best["c1"]["first_purchase_date"] == d(2020, 1, 1)
    msgs = spark.createDataFrame([("c1", "u9", "q"), ("c3", "u5", None), ("c3", "u4", "k")],
                                 "client_id string, user_id string, user_device_id string")
    only = M.message_only_clients(msgs, M.clients_dim(clients)).collect()
    assert [(r["client_id"], r["user_id"], r["first_purchase_date"]) for r in only] == [("c3", "u4", None)]


def test_campaign_latest_nulls_last(spark):
    ts = dt.datetime
    rows = [("1", "email", ts(2020, 1, 1), None, "a"), ("1", "email", ts(2019, 1, 1), ts(2019, 2, 1), "b"),
            ("2", "push", ts(2020, 1, 1), None, "c"), ("2", "push", ts(2021, 1, 1), None, "d")]
    df = spark.createDataFrame(rows, "campaign_id string, campaign_type string, started_at timestamp, "
                                     "finished_at timestamp, channel string")
    got = {r["campaign_id"]: r["channel"] for r in M.campaigns_dim(df).collect()}
    assert got == {"1": "b", "2": "d"}


def test_products_lowest_attributes(spark):
    ev = spark.createDataFrame([("p", None, "z", "b"), ("p", "2", None, None), ("p", "2", "a", None)],
                               "product_id string, category_id string, category_code string, brand string")
    r = M.products_dim(ev).first()
    assert (r["category_id"], r["category_code"], r["brand"]) == ("2", "a", None)


def test_dense_ids(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("k"))
    out = M.dense_ids(df, ["k"], name="eid", prefix="ev_")
    got = sorted((r["k"], r["eid"]) for r in out.collect())
    assert got[0] == (0, "ev_1") and got[-1] == (999, "ev_1000")
    assert len({e for _, e in got}) == 1000
    pos = M.dense_ids(spark.range(0, 500, 1, 5), None, name="eid", prefix="")
    assert sorted((r["id"], int(r["eid"])) for r in pos.collect()) == [(i, i + 1) for i in range(500)]


def test_graph_upsert_and_first_non_blank(spark):
    m = spark.createDataFrame([("m1", "r1", 1, "a"), ("m1", None, 2, "b"), ("m2", "r3", 3, None)],
                              "message_id string, row_id string, ord int, channel string")
    got = {r["message_id"]: (r["row_id"], r["channel"]) for r in G.message_upsert(m, "ord").collect()}
    assert got == {"m1": ("r1", "b"), "m2": ("r3", None)}
    ev = spark.createDataFrame([("p", None, 1), ("p", "B2", 2), ("p", "B3", 3), ("q", None, 4)],
                               "product_id string, brand string, ord int")
    got = {r["product_id"]: r["brand"] for r in G.product_nodes(ev, "ord").collect()}
    assert got == {"p": "B2", "q": None}


def test_campaign_stubs(spark):
    camps = spark.createDataFrame([("1", "email", "e")], "campaign_id string, campaign_type string, channel string")
    bt = spark.createDataFrame([("m1", "1|email"), ("m2", "9|push")], "message_id string, campaign_key string")
    got = {r["campaign_key"]: (r["campaign_id"], r["channel"]) for r in G.campaign_nodes(camps, bt).collect()}
    assert got == {"1|email": ("1", "e"), "9|push": ("9", None)}


def test_quality_checks(spark):
    t = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert V.duplicate_keys(t, ["k"]).collect()[0]["k"] == "a"
    nulls = {r["column_name"]: r["nulls"] for r in V.null_counts(t, ["k", "v"], "t").collect()}
    assert nulls == {"k": 1, "v": 0}
    parent = spark.createDataFrame([("a",)], "k string")
    assert V.orphans(t, parent, ["k"]).count() == 0
    child = spark.createDataFrame([("b",), (None,)], "k string")
    assert V.orphans(child, parent, ["k"]).count() == 1


def test_friend_of_check_is_vacuous_for_d01_users(spark):
    """q1_graph skips the FRIEND_OF existence check because D01 users hold
    every friendship endpoint; verify that on the test tables."""
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    q = entry.queries()
    assert q["friend_of_edges"](spark, SF_SMALL).count() == q["friends_edges"](spark, SF_SMALL).count()
