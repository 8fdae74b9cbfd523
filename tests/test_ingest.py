"""Ingest of a tree of CSV files: outcomes, metrics, and one job per header."""

import os

import pytest

from socialcart.sources.ingest import file_headers, ingest


@pytest.fixture()
def tree(tmp_dir):
    def put(rel, text):
        path = os.path.join(tmp_dir, "raw", rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    for i in range(12):
        put(f"events/day {i}.csv", f" id ,status,price\n{i}.0, ok ,1.50\n\n{i},too,many,fields\nNA,null,\n{i}\nid,status,price\n")
    put("friends.csv", 'friend1,friend2\n1.0,"2"\n"a,b",3\n')
    put("empty.csv", "")
    put("header.csv", "id,status,price\n")
    put("note.txt", "id,status,price\n1,2,3\n")
    return tmp_dir


def test_outcomes_and_metrics(spark, tree):
    got = ingest(spark, f"{tree}/raw", f"{tree}/out")
    kept = got.kept(["id", "status", "price"]).where("file like '%day%203.csv'").drop("file").collect()
    assert sorted(map(tuple, kept)) == [("3", "", ""), ("3", "ok", "1.5"), ("id", "status", "price")]
    rejects = got.rejects().where("file like '%day%203.csv'").drop("file").collect()
    assert sorted(map(tuple, rejects)) == [("3,too,many,fields", "malformed"), ("NA,null,", "empty")]
    metrics = {os.path.basename(r.file): (r.kept, r.skipped_empty, r.skipped_malformed) for r in got.metrics().collect()}
    assert len(metrics) == 14 and metrics["header.csv"] == (0, 0, 0)
    assert metrics["friends.csv"] == (2, 0, 0)
    assert sorted(map(tuple, got.kept(["friend1", "friend2"]).drop("file").collect())) == [("1", "2"), ("a,b", "3")]


def test_jobs_follow_headers_not_files(spark, tree):
    sc = spark.sparkContext
    sc.setJobGroup("ingest", "count jobs")
    ingest(spark, f"{tree}/raw", f"{tree}/out")
    jobs = len(sc.statusTracker().getJobIdsForGroup("ingest"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(file_headers(spark, f"{tree}/raw")) == 14
    assert jobs <= 2 * 3 + 4  # three headers (one with blanks), 14 files


def test_refused_inputs(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/a.csv", "w") as f:
        f.write("version https://git-lfs.github.com/spec/v1\noid sha256:0\n")
    with pytest.raises(ValueError, match="pointer"):
        ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out")
    with open(f"{tmp_dir}/raw/a.csv", "w") as f:
        f.write("id, id\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        ingest(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out")
