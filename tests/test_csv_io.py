"""CSV ingest edge cases."""

import json
import os

import pytest

from socialcart.sources import csv_io, results

RAW = (
    'id,user_id,is_opened,price\n'
    '1,5.0,yes,123.4500\n'
    '2,6,no,1,extra\n'              # too long → malformed
    '3,7\n'                         # too short → padded
    'NA,none,,\n'                   # blank after cleaning → dropped
    '\n'                            # empty line → skipped
    '4,"8,9",t,"1e2"\n'             # quoted comma
    '5,"say ""hi""",f,0.000\n'      # doubled quote
    '6,"multi\nline",y,2\n'         # quoted newline
)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_read_and_clean_csv(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw", "sub", "messages.csv")
    _write(src, RAW)
    out = os.path.join(tmp_dir, "out")
    metrics = csv_io.clean_csv_tree(spark, os.path.join(tmp_dir, "raw"), out, fmt="csv",
                                    multiline=True)
    m = {r["file"]: r for r in metrics.collect()}
    assert m["sub/messages.csv"]["kept"] == 5
    assert m["sub/messages.csv"]["skipped_empty"] == 1
    assert m["sub/messages.csv"]["skipped_malformed"] == 1
    assert m["TOTAL"]["kept"] == 5
    back = (spark.read.option("header", True).option("multiLine", True)
            .csv(os.path.join(out, "sub", "messages.csv")))
    rows = {r["id"]: r for r in back.collect()}
    assert rows["1"]["user_id"] == "5" and rows["1"]["is_opened"] == "1" and rows["1"]["price"] == "123.45"
    assert rows["3"]["user_id"] == "7" and rows["3"]["price"] is None  # padded: blank written as empty
    assert rows["4"]["user_id"] == "8,9" and rows["4"]["price"] == "100"
    assert rows["5"]["user_id"] == 'say "hi"' and rows["5"]["price"] == "0"
    assert rows["6"]["user_id"] == "multi\nline"


def test_default_parquet_output_and_splittable_read(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw", "events.csv")
    _write(src, "event_time,price,user_id\n2020-1-5,1.50,7.0\n,,\n")
    metrics = {r["file"]: r for r in csv_io.clean_csv_tree(spark, os.path.join(tmp_dir, "raw"),
                                                           os.path.join(tmp_dir, "out")).collect()}
    assert (metrics["events.csv"]["kept"], metrics["events.csv"]["skipped_empty"]) == (1, 1)
    row = spark.read.parquet(os.path.join(tmp_dir, "out", "events")).first()
    assert (row["event_time"], row["price"], row["user_id"]) == ("2020-01-05 00:00:00", "1.5", "7")


def test_header_names_are_trimmed(spark, tmp_dir):
    src = os.path.join(tmp_dir, "h.csv")
    _write(src, " id , note \n1,x\n")
    df = csv_io.read_text_table(spark, src)
    assert df.columns == ["id", "note", "_malformed"]
    assert df.first()["note"] == "x"


def test_lfs_pointer_is_rejected(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw", "events.csv")
    _write(src, "version https://git-lfs.github.com/spec/v1\noid sha256:abc\nsize 1\n")
    with pytest.raises(ValueError):
        csv_io.preflight(spark, csv_io.list_csv_files(spark, os.path.join(tmp_dir, "raw")))


def test_list_csv_files_sorted_recursive(spark, tmp_dir):
    for rel in ["b/x.csv", "a.csv", "b/y.txt"]:
        _write(os.path.join(tmp_dir, rel), "id\n1\n")
    files = csv_io.list_csv_files(spark, tmp_dir)
    assert [f.rsplit("/", 2)[-1] for f in files] == ["a.csv", "x.csv"]


def test_result_json_and_summary(spark, tmp_dir):
    df = spark.range(7).withColumnRenamed("id", "n")
    meta = results.write_result(df, os.path.join(tmp_dir, "q1"), "q1")
    assert meta["row_count"] == 7
    os.makedirs(os.path.join(tmp_dir, "empty", "summary"))
    summary = results.result_summary(spark, [os.path.join(tmp_dir, "q1", "summary"),
                                             os.path.join(tmp_dir, "missing", "summary"),
                                             os.path.join(tmp_dir, "empty", "summary")],
                                     ["spark", "other"], ["q1", "q2"])
    got = {(r["database"], r["query"]): r["row_count"] for r in summary.collect()}
    assert got[("spark", "q1")] == 7 and got[("spark", "q2")] is None and len(got) == 2
    rows = [json.loads(line) for p in os.listdir(os.path.join(tmp_dir, "q1", "rows"))
            if p.endswith(".json") for line in open(os.path.join(tmp_dir, "q1", "rows", p))]
    assert sorted(r["n"] for r in rows) == list(range(7))


def test_timings_csv(spark, tmp_dir):
    df = results.write_timings(spark, [("q1", 1, 12.34567, "spark"), ("q1", 2, 10.0, "spark")],
                               os.path.join(tmp_dir, "t"))
    assert [r["execution_time_ms"] for r in df.collect()] == [12.346, 10.0]


def test_empty_file_counts_zero(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw", "empty.csv")
    _write(src, "")
    m = {r["file"]: r for r in csv_io.clean_csv_tree(spark, os.path.join(tmp_dir, "raw"),
                                                     os.path.join(tmp_dir, "out")).collect()}
    assert m["TOTAL"]["kept"] == 0  # zero-length files hold no rows and are not listed
    assert csv_io.clean_csv(spark, src, os.path.join(tmp_dir, "o2")) == \
        {"kept": 0, "skipped_empty": 0, "skipped_malformed": 0}
