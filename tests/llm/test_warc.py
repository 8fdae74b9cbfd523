import gzip
import hashlib
from collections import defaultdict

import duckdb
import pytest

from socialcart.llm import oracle, queries
from socialcart.llm.warc import archive_round_trip, assemble, parse_archive, read_records, write_archives
from tests.conftest import SF_SMALL

BODY = "<p>" + "payload " * 30 + "</p>"
TRICKY = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 8 + "é\x00\n"
PAGES = "page_id long, url string, html string, id string, sha string, found string, revisit int"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(5, "http://a.org/x y\r\nz", BODY), (3, "https://b.org", BODY), (9, None, BODY), (3, "https://b.org", BODY),
            (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (None, None, None), (None, "u", TRICKY),
            (7, "http://c.org/q?a=b#f", TRICKY), (8, "u", "x" * 99), (10, "u", "x" * 99), (11, "u", "y" * 100), (12, "u", "y" * 100)]
    return spark.createDataFrame([(*r, "i", "s", "f", 1) for r in rows], PAGES).repartition(2)


def test_round_trip_of_odd_pages(pages):
    rows = [(r.page_id, r.html) for r in pages.collect()]
    groups = defaultdict(list)
    for page_id, text in rows:
        groups[text or ""].append(page_id)
    want = []
    for page_id, text in rows:
        raw = (text or "").encode()
        first = min((x for x in groups[text or ""] if x is not None), default=None)
        again = len(raw) >= 100 and page_id != first
        want.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted((tuple(r) for r in archive_round_trip(pages).collect()), key=key) == sorted(want, key=key)


def test_records_and_captures(spark, pages, tmp_dir):
    write_archives(pages, f"{tmp_dir}/w")
    records = read_records(spark, f"{tmp_dir}/w").cache()
    n = pages.count()
    by = {r["type"]: r["count"] for r in records.groupBy("type").count().collect()}
    assert by["request"] == by["metadata"] == by["response"] + by["revisit"] == n
    captures = assemble(records).collect()
    assert len(captures) == n
    for c in captures:
        assert (c.n_response, c.n_request, c.n_metadata) == (1, 1, 1)
        if c.response.type == "response":
            assert c.response.block_digest == c.response.payload_digest == hashlib.sha256(c.response.payload).hexdigest()
        else:
            assert c.response.payload is None
    texts = {c.response.payload.decode() for c in captures if c.response.type == "response"}
    assert texts == {r.html or "" for r in pages.collect()}
    lonely = assemble(records.where("type = 'request'")).collect()
    assert len(lonely) == n and all(c.response is None and c.n_request == 1 for c in lonely)


def test_archive_forms():
    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <a>\r\nContent-Type: application/warc-fields\r\n" \
             b"Content-Length: 8\r\n\r\nk: v\r\n\r\n\r\n\r\n"
    for data in (record * 2, gzip.compress(record * 2), gzip.compress(record) * 2):
        assert [r["fields"] for r in parse_archive(data)] == [{"k": "v"}] * 2
    with pytest.raises(ValueError):
        list(parse_archive(record[:-8]))
    with pytest.raises(ValueError):
        list(parse_archive(b"nonsense\r\n"))


def test_empty_table(spark):
    assert archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_query_matches_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_SMALL}/pages.parquet')")
    want = con.execute(oracle.oracle()["op8_warc"]).fetchall()
    got = [tuple(r) for r in queries.queries()["op8_warc"](spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(want)
