import hashlib
import random
import re
import zlib

import pytest

from socialcart.llm import position_sets, queries
from socialcart.llm.periodic_runs import MIN_LCP, collapse, find_runs, run_digests, runs_of
from tests.conftest import SF_SMALL


def brute(words):
    """Every period tried at every start."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j + q - i
            stretch = words[i:i + n]
            if n >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def documents(seed, count):
    pick = random.Random(seed)
    for _ in range(count):
        n, k = pick.choice([0, 1, 5, 6, 7, 20, 60, 200]), pick.choice([1, 2, 3, 5])
        words = [b"%d" % pick.randrange(k) for _ in range(n)]
        if pick.random() < 0.5 and n > 8:
            a = pick.randrange(n)
            p = 1 + (n - a) // pick.randint(3, 10)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words


def test_runs_equal_brute_force():
    docs = list(documents(1, 600))
    for i in range(0, 600, 5):
        assert runs_of(docs[i:i + 5]) == [brute(d) for d in docs[i:i + 5]]
    assert sum(map(len, runs_of(docs))) > 200


def test_runs_with_small_blocks(monkeypatch):
    monkeypatch.setattr(position_sets, "BLOCK", 2)
    docs = list(documents(2, 200))
    assert runs_of(docs) == [brute(d) for d in docs]


def test_long_repeats():
    assert MIN_LCP == 5
    assert runs_of([[b"a"] * 100_000, [b"a"] * 5, [b"a"] * 6]) == [[(0, 100_000, 1)], [], [(0, 6, 1)]]
    words = [b"%d" % i for i in range(5000)]
    assert runs_of([words + words * 3 + words[:7]]) == [[(0, 20_007, 5000)]]
    assert collapse([b"x", *[b"a", b"b"] * 4, b"y"], [(1, 8, 2)]) == b"x a b y"


def want(doc_id, text, rewrite):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    if rewrite and doc_id is not None and words and zlib.crc32(b"%d" % doc_id) % 10 == 0:
        g = zlib.crc32(b"%d" % doc_id) // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.queries()["op13_periodic_runs"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(want(d.doc_id, d.text, True) for d in docs)
    assert sum(r[1] for r in rows) > 0


def test_odd_documents(spark, odd_documents):
    found = find_runs(odd_documents)
    rows = [(r.doc_id, r.text) for r in odd_documents.where("text is null or length(text) < 1000").collect()]
    small = sorted((tuple(r) for r in run_digests(find_runs(odd_documents.where("text is null or length(text) < 1000"))).collect()), key=str)
    assert small == sorted((want(*r, False) for r in rows), key=str)
    assert found.count() == odd_documents.count()
    assert found.where("n_words > 50000 and size(runs) = 0").count() == 2


@pytest.mark.parametrize("text,n", [("a a a a a a", 1), ("a\ta\na a  a", 0), ("a\x0ba\x0ca\ra a a", 1),
                                    ("a a a a a a a", 0), ("a\x1ca a a a a a", 0)])
def test_words_split_at_ascii_space_only(spark, text, n):
    row = run_digests(find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert row.n_runs == n


def test_empty_table(no_documents):
    assert run_digests(find_runs(no_documents)).count() == 0
