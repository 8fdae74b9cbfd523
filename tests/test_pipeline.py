"""End to end: raw CSV extracts → clean → load → Q1/Q2/Q3 → result files."""

import os

from socialcart import cli
from socialcart.plans.load import build_relational, read_cleaned
from socialcart.sources import csv_io, results

CAMPAIGNS = """id,campaign_type,channel,topic,started_at,finished_at,total_count,ab_test,warmup_mode,hour_limit,subject_length,subject_with_personalization,subject_with_deadline,subject_with_emoji,subject_with_bonuses,subject_with_discount,subject_with_saleout,is_test,position
1,bulk,email,sale,2021-04-01 10:00:00,,100.0,yes,no,5,40,t,f,f,f,f,f,false,1
1,bulk,email,sale,2021-04-01 10:00:00,2021-04-02 10:00:00,100,true,n,5.0,40,1,0,0,0,0,0,0,1
2,trigger,push,NA,2021-04-03,2021-04-04,50,no,no,,,,,,,,,,2
"""
CLIENTS = """client_id,first_purchase_date,user_id,user_device_id
c1,2021-01-02,u1,d1
c1,2021-01-01,u1,d2
c2,,u2,d3
"""
EVENTS = """event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session
2021-04-01 10:00:00 UTC,view,p1,10,electronics.smartphone,apple,100.00,u1,s1
2021-04-01 10:01:00 UTC,purchase,p1,10,electronics.smartphone,apple,100.00,u2,s2
2021-04-01 10:02:00 UTC,cart,p2,11,electronics.tv,lg,50.5,u2,s2
2021-04-01 10:03:00 UTC,view,p3,12,kids.toys,,5,u3,s3
2021-04-01 10:04:00 UTC,view,p4,11,electronics.tv,sony,60,u1,s1
"""
MESSAGES = """id,message_id,campaign_id,message_type,client_id,channel,category,platform,email_provider,stream,date,sent_at,is_opened,opened_first_time_at,opened_last_time_at,is_clicked,clicked_first_time_at,clicked_last_time_at,is_unsubscribed,unsubscribed_at,is_hard_bounced,hard_bounced_at,is_soft_bounced,soft_bounced_at,is_complained,complained_at,is_blocked,blocked_at,is_purchased,purchased_at,created_at,updated_at,user_device_id,user_id
r1,m1,1,bulk,c1,email,marketing,web,gmail,desktop,2021-04-01,2021-04-01 10:00:00,t,,,f,,,f,,f,,f,,f,,f,,t,2021-04-01 11:00:00,2021-04-01 09:00:00,2021-04-01 09:00:00,d1,u1
r2,m2,1,bulk,c2,email,marketing,web,gmail,desktop,2021-04-01,2021-04-01 10:00:00,f,,,f,,,f,,f,,f,,f,,f,,yes,,2021-04-01 09:00:00,2021-04-01 09:00:00,d3,u2
r3,m3,1,bulk,c3,email,marketing,web,gmail,desktop,2021-04-01,2021-04-01 10:00:00,f,,,f,,,f,,f,,f,,f,,f,,no,,2021-04-01 09:00:00,2021-04-01 09:00:00,d4,u3
r4,m4,9,bulk,c3,email,marketing,web,gmail,desktop,2021-04-01,2021-04-01 10:00:00,f,,,f,,,f,,f,,f,,f,,f,,t,,2021-04-01 09:00:00,2021-04-01 09:00:00,d4,u3
"""
FRIENDS = """friend1,friend2
u1,u2
u2,u1
u1,u1
u2,u3
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_end_to_end(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    for name, text in [("campaigns", CAMPAIGNS), ("client_first_purchase_date", CLIENTS),
                       ("events", EVENTS), ("messages", MESSAGES), ("friends", FRIENDS)]:
        _write(os.path.join(raw, f"{name}.csv"), text)
    clean = os.path.join(tmp_dir, "clean")
    metrics = {r["file"]: r["kept"] for r in csv_io.clean_csv_tree(spark, raw, clean).collect()}
    assert metrics["TOTAL"] == 3 + 3 + 5 + 4 + 4
    t = build_relational(read_cleaned(spark, clean))
    camp = {r["campaign_id"]: r for r in t["campaigns"].collect()}
    assert camp["1"]["finished_at"] is not None and camp["1"]["ab_test"] is True
    assert camp["1"]["total_count"] == 100 and camp["2"]["topic"] is None
    assert {r["client_id"]: str(r["first_purchase_date"]) for r in t["clients"].collect()} == \
        {"c1": "2021-01-01", "c2": "None", "c3": "None"}
    assert sorted(r["event_id"] for r in t["events"].collect()) == [f"ev_{i}" for i in range(1, 6)]
    assert sorted(tuple(r) for r in t["friends"].collect()) == [("u1", "u2"), ("u2", "u1"), ("u2", "u3")]
    assert t["messages"].count() == 4 and t["users"].count() == 3
    q = cli.analyses(t)
    q1 = q["q1"]().collect()
    assert [(r["campaign_id"], r["recipients"], r["purchasers"], r["social_purchasers"]) for r in q1] == \
        [("1", 3, 2, 2)]
    recs = q["q2"]().collect()
    assert {(r["target_user_id"], r["product_id"]) for r in recs} >= {("u1", "p2"), ("u3", "p1")}
    hits = q["q3"]().collect()
    assert {r["keyword"] for r in hits} >= {"electronics"}
    out = os.path.join(tmp_dir, "out")
    meta = results.write_result(q["q1"](), os.path.join(out, "q1"), "q1")
    assert meta["row_count"] == 1
    from socialcart.plans.load import build_document, build_graph
    doc = build_document(t)
    m1 = doc["messages"].where("row_id = 'r1'").first()
    assert m1["campaign_ref"]["campaign_key"] == "1|bulk" and m1["engagement"]["is_purchased"] is True
    assert doc["products"].where("product_id = 'p1'").first()["category_search_text"] == \
        "electronics.smartphone apple"
    g = build_graph(t, read_cleaned(spark, clean)["events"])
    assert {r["etype"] for r in g["e_event"].collect()} == {"VIEWED", "CARTED", "PURCHASED"}
    # the graph keeps the message of unknown campaign 9 (stub campaign, M4)
    assert g["e_received_campaign"].count() == 4 and g["e_purchased_campaign"].count() == 3
    assert g["g_campaign"].where("campaign_key = '9|bulk'").count() == 1
    assert g["g_category"].count() == 3 and g["e_in_category"].count() == 4
    assert g["g_user"].where("has_first_purchase").count() == 1


def test_cli_load_and_analyze(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    for name, text in [("campaigns", CAMPAIGNS), ("client_first_purchase_date", CLIENTS),
                       ("events", EVENTS), ("messages", MESSAGES), ("friends", FRIENDS)]:
        _write(os.path.join(raw, f"{name}.csv"), text)
    clean, model, out = (os.path.join(tmp_dir, x) for x in ("clean", "model", "out"))
    csv_io.clean_csv_tree(spark, raw, clean)
    from socialcart.plans.load import write_tables
    write_tables(build_relational(read_cleaned(spark, clean)), model)
    from socialcart.plans.load import read_tables
    t = read_tables(spark, model)
    metas = [results.write_result(fn(), os.path.join(out, n), n) for n, fn in cli.analyses(t).items()]
    summary = results.result_summary(spark, [os.path.join(out, m["query"], "summary") for m in metas],
                                     ["spark"], ["q1", "q2", "q3"])
    got = {r["query"]: r["row_count"] for r in summary.collect()}
    assert got["q1"] == 1 and got["q2"] >= 2 and got["q3"] >= 1
    cli.main(["benchmark", model, os.path.join(tmp_dir, "bench"), "--runs", "2"])
    timings = spark.read.option("header", True).csv(os.path.join(tmp_dir, "bench", "timings"))
    assert sorted((r["query_name"], r["run_number"]) for r in timings.collect()) == \
        [(q, str(i)) for q in ("q1", "q2", "q3") for i in (1, 2)]
