import hashlib
import re
from collections import Counter, defaultdict

import duckdb

from socialcart.llm import oracle, queries
from socialcart.llm.bloom import fill, probe
from socialcart.llm.exact_dedup import digest_table, drop_exact_copies, exact_copies, label_copies
from tests.conftest import SF_SMALL


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[_norm(text)].append(doc_id)
    return Counter((d, min(x for x in g if x is not None) if any(x is not None for x in g) else None, len(g),
                    hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g)


def test_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = exact_copies(odd_documents).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == _expected(rows)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({_norm(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_a_full_filter_gives_the_same_result(odd_documents):
    digests = digest_table(odd_documents, "doc_id", "text")
    small = label_copies(digests, max_words=1).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in small) == \
        Counter((r.doc_id, r.keep_id, r.group_size) for r in label_copies(digests).collect())


def test_survivors_keep_all_columns(odd_documents):
    got = drop_exact_copies(odd_documents)
    assert got.columns == odd_documents.columns
    texts = [_norm(r.text) for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({_norm(r.text) for r in odd_documents.collect()})
    assert [r.doc_id for r in got.collect() if _norm(r.text) == "same text of a few words here"] == [3]


def test_hot_group_and_empty_table(spark, no_documents):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) AS text")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_copies(df).collect()}
    assert len(got) == 3000
    assert all((k == 0 and n == 1000 and stays == (d == 0)) if d % 3 == 0 else (k == d and n == 1 and stays) for d, k, n, stays in got)
    assert exact_copies(no_documents).count() == 0 and drop_exact_copies(no_documents).count() == 0


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(500).selectExpr("concat('k', id) AS key")
    asked = spark.range(2000).selectExpr("concat('k', id) AS key", "id")
    got = probe(asked, fill(keys, "key", 256), "key", 256).collect()
    assert all(r._possible for r in got if r.id < 500)
    assert sum(r._possible for r in got if r.id >= 500) < 150


def test_query_matches_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(oracle.oracle()["op2_exact_dedup"]).fetchall()
    got = [tuple(r) for r in queries.queries()["op2_exact_dedup"](spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(want)
