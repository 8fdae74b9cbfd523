"""Bucketed upserts and whole snapshots: batches, failures, what a read does."""

import pytest

from socialcart.plans import snapshot as S
from socialcart.streaming.bucket_table import BucketTable

SCHEMA = "id long, ord long, v string"


@pytest.fixture()
def table(spark, tmp_dir):
    schema = spark.createDataFrame([], SCHEMA).schema
    return BucketTable(spark, f"{tmp_dir}/t", schema, ["id"], "ord", buckets=4)


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def state(table):
    return {r.id: (r.ord, r.v) for r in table.read().collect()}


def test_updates_late_rows_and_replays(spark, table):
    assert state(table) == {}
    assert table.upsert(rows(spark, (1, 1, "a"), (2, 1, "b"), (1, 2, "c"), (None, 1, "n")), 0) == 0
    assert state(table) == {1: (2, "c"), 2: (1, "b"), None: (1, "n")}
    assert table.upsert(rows(spark, (1, 1, "late"), (2, 3, "d"), (3, 1, "e"), (None, 2, "m")), 1) == 1
    want = {1: (2, "c"), 2: (3, "d"), 3: (1, "e"), None: (2, "m")}
    assert state(table) == want
    assert table.upsert(rows(spark, (1, 9, "again")), 1) == 1 and state(table) == want
    assert table.upsert(rows(spark, (1, 2, "b"), (1, 2, "d")), 2) == 2 and state(table)[1] == (2, "d")
    assert table.upsert(rows(spark), 3) == 3 and state(table)[2] == (3, "d")


def test_only_touched_buckets_are_written(spark, table):
    table.upsert(spark.range(1000).selectExpr("id", "1L AS ord", "'x' AS v"), 0)
    table.upsert(rows(spark, (5, 2, "y")), 1)
    entries = {r.bucket: r.data_version for r in table.manifest.read(1).where("bucket >= 0").collect()}
    assert sorted(entries.values()) == [0, 0, 0, 1]
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    assert len(state(table)) == 1000 and state(table)[5] == (2, "y")


def test_a_batch_without_manifest_changes_nothing(spark, table, monkeypatch):
    table.upsert(rows(spark, (1, 1, "a")), 0)
    commit = table.manifest.commit

    def fail(*_):
        raise OSError("lost")
    monkeypatch.setattr(table.manifest, "commit", fail)
    with pytest.raises(OSError):
        table.upsert(rows(spark, (1, 2, "b"), (2, 1, "c")), 1)
    assert state(table) == {1: (1, "a")}
    monkeypatch.setattr(table.manifest, "commit", commit)
    table.upsert(rows(spark, (1, 2, "b"), (2, 1, "c")), 1)
    assert state(table) == {1: (2, "b"), 2: (1, "c")}


def test_snapshot_swaps_all_or_nothing(spark, tmp_dir):
    root = f"{tmp_dir}/s"
    with pytest.raises(FileNotFoundError):
        S.open_snapshot(spark, root)
    users, edges = spark.createDataFrame([(1,), (2,)], "user_id long"), spark.createDataFrame([(1, 2)], "user_id long, friend_id long")
    checks = {"pk": S.unique("users", ["user_id"]), "nn": S.not_null("users", ["user_id"]),
              "fk": S.references("friends", ["friend_id"], "users", ["user_id"])}
    assert S.publish(spark, root, {"users": users, "friends": edges}, checks) == 0
    for bad_users, bad_edges, name in ((users.union(users), edges, "pk"), (users.limit(1), edges, "fk"),
                                       (spark.createDataFrame([(None,), (2,)], "user_id long"), edges, "nn")):
        with pytest.raises(S.LoadRejected) as e:
            S.publish(spark, root, {"users": bad_users, "friends": bad_edges}, checks)
        assert e.value.name == name
    broken = users.selectExpr("raise_error('lost') AS user_id")
    with pytest.raises(Exception, match="lost"):
        S.publish(spark, root, {"friends": edges, "users": broken})
    assert S.open_snapshot(spark, root)["users"].count() == 2
    assert S.publish(spark, root, {"users": users, "friends": edges.limit(0)}, checks) == 1
    assert S.open_snapshot(spark, root)["friends"].count() == 0 and S.open_snapshot(spark, root, 0)["friends"].count() == 1
