"""Helper edges after each batch against a full rebuild."""

import glob
import os
import random

import pytest

from socialcart.streaming.helper_deltas import HelperEdges

SCHEMA = "message_id long, user_id long, client_id long, campaign_key string, is_purchased boolean, ord long"


def rebuild(clients, versions):
    last = {}
    for v in versions:
        if v[0] is not None and (v[0] not in last or (v[5], v[1:5]) > (last[v[0]][5], last[v[0]][1:5])):
            last[v[0]] = v
    owners = {(u, c) for u, c in clients} | {(v[1], v[2]) for v in last.values()}
    out = {}
    for u, c in owners:
        for v in last.values():
            if None not in (u, c) and v[2] == c and v[3] is not None:
                out[u, v[3]] = out.get((u, v[3]), False) or bool(v[4])
    return out


def versions(pick, n, start):
    return [(pick.randrange(12), pick.randrange(5), pick.choice([0, 1, 2, 3, None]), pick.choice(["a", "b", "c", None]),
             pick.choice([True, False, None]), start + pick.randrange(3 * n) * 10 + i) for i in range(n)]


def test_each_batch_equals_a_rebuild(spark, tmp_dir):
    pick = random.Random(4)
    clients = [(9, 0), (9, 1), (8, 1)]
    edges = HelperEdges(spark, f"{tmp_dir}/h", buckets=3)
    edges.seed(spark.createDataFrame(clients, "user_id long, client_id long"))
    seen = []
    for batch_id in range(1, 4):
        batch = versions(pick, 8, 0)
        edges.apply(spark.createDataFrame(batch, SCHEMA), batch_id)
        seen += batch
        assert {(r.user_id, r.campaign_key): r.purchased for r in edges.edges().collect()} == rebuild(clients, seen)


def test_flips_both_ways_and_a_batch_that_dies(spark, tmp_dir, monkeypatch):
    edges = HelperEdges(spark, f"{tmp_dir}/h", buckets=2)
    edges.seed(spark.createDataFrame([(7, 1)], "user_id long, client_id long"))

    def state():
        return {(r.user_id, r.campaign_key): r.purchased for r in edges.edges().collect()}

    def put(batch_id, *rows):
        edges.apply(spark.createDataFrame(rows, SCHEMA), batch_id)

    put(1, (1, 5, 1, "a", False, 1))
    assert state() == {(5, "a"): False, (7, "a"): False}
    put(2, (1, 5, 1, "a", True, 2))
    assert state() == {(5, "a"): True, (7, "a"): True}
    put(3, (1, 5, 1, "a", False, 3), (2, 6, 1, "b", True, 3))
    assert state()[5, "a"] is False and state()[6, "a"] is False and state()[5, "b"] is True
    upsert = edges.owners.upsert

    def fail(*_):
        raise OSError("lost")
    monkeypatch.setattr(edges.owners, "upsert", fail)
    with pytest.raises(OSError):
        put(4, (2, 5, 1, "b", True, 4))
    monkeypatch.setattr(edges.owners, "upsert", upsert)
    put(4, (2, 5, 1, "b", True, 4))
    assert state() == {(5, "a"): False, (7, "a"): False, (5, "b"): True, (7, "b"): True}
    put(4, (2, 5, 1, "c", True, 9))
    assert (5, "c") not in state()


def test_a_batch_is_several_files(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F

    from socialcart.streaming import helper_deltas as H

    monkeypatch.setattr(H, "checkpoint_root", lambda _: tmp_dir)
    monkeypatch.setattr(H, "ROWS_A_FILE", 40, raising=False)
    rows = [(i // 2, i % 7, i % 4, str(2000 + i % 2), "1-URGENT", i % 3 == 0, i) for i in range(200)]
    messages = spark.createDataFrame(rows, "message_id long, user_id long, client_id long, campaign_id string, message_type string, "
                                           "is_purchased boolean, ord long")
    clients = spark.createDataFrame([(9, 0)], "user_id long, client_id long")
    out = H.helper_edges_by_deltas(messages, clients, batches=2)
    keys = messages.select(*messages.columns, H.campaign_key(messages).alias("k")).collect()
    want = rebuild([(9, 0)], [(r.message_id, r.user_id, r.client_id, r.k, r.is_purchased, r.ord) for r in keys])
    assert {(r.user_id, r.campaign_key): r.purchased for r in out.collect()} == want
    (run,) = glob.glob(f"{tmp_dir}/helper-deltas-*")
    sizes = spark.read.parquet(f"{run}/source").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 100
    assert len([f for f in os.listdir(f"{run}/checkpoint/commits") if f.isdigit()]) == 2
