import random
from collections import defaultdict

import numpy as np

from socialcart.llm import queries
from socialcart.llm.bm25 import Index
from socialcart.llm.decontamination import Matcher, drop_leaking, leaks, question_answer, words_of
from tests.conftest import SF_SMALL

ITEMS = "item_id long, text string, doc_id int, bm25 string"
Q = "Which of the seven rivers of the northern plain reaches the inner sea before the first snow falls? The slow green Aldera does"


def _scores(index, query):
    out = defaultdict(float)
    for t in query:
        for u, w in zip(index.units[t], index.impacts[t], strict=True):
            out[u] += w
    return out


def test_block_max_wand_finds_all_above_the_threshold():
    rnd = random.Random(2)
    vocab = [f"w{int(rnd.paretovariate(0.7))}".encode() for _ in range(4000)]
    units = [[rnd.choice(vocab) for _ in range(rnd.randint(1, 30))] for _ in range(150)]
    for block in (1, 4, 64):
        index = Index(units, block)
        for _ in range(60):
            words = [rnd.choice(vocab) for _ in range(40)] + rnd.choice(units)[:rnd.randint(0, 20)]
            query = sorted({t for t in index.terms(words).tolist() if t >= 0})
            if not query:
                continue
            for threshold in (0.2, 0.5, 0.9):
                live = index.live_blocks(np.array(query), np.array([0]), threshold)
                got = dict(index.search(query, live[0][1].tolist(), threshold)) if live else {}
                want = {u: s for u, s in _scores(index, query).items() if s >= threshold}
                assert got.keys() == want.keys() and all(abs(got[u] - want[u]) < 1e-9 for u in got)


def test_question_and_answer():
    question, answer = question_answer(Q)
    assert question[-1] == b"falls" and answer == words_of("the slow green Aldera does")
    assert question_answer("one two three four five six seven eight") == (
        words_of("one two three four five six"), [b"seven", b"eight"])


def test_leaks_wherever_they_stand(spark):
    noise = [f"x{i}" for i in range(5000)]
    rnd = random.Random(1)

    def around(text, before, after):
        return " ".join([*(rnd.choice(noise) for _ in range(before)), text, *(rnd.choice(noise) for _ in range(after))])

    edited = Q.replace("seven", "eight").replace("slow", "fast")
    rows = [(i, around(Q, n, 200), "en", "s", 1) for i, n in enumerate(range(0, 140, 7))]
    rows += [(100, around(Q.upper().replace(" ", "\n"), 50, 5), "", "", 1), (101, around(edited, 40, 40), "", "", 1),
             (102, around("the of first sea before", 300, 300), "", "", 1), (103, Q[:30], "", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    items = spark.createDataFrame([(7, Q, 1, "b"), (7, Q, 1, "b"), (8, None, 1, "b"), (9, "", 1, "b"), (10, "the of", 1, "b"),
                                   (None, around("", 40, 0), 1, "b")], ITEMS)
    got = leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted((i, 7) for i in [*range(20), 100, 101])
    assert {r.doc_id for r in leaks(docs, items, index_bytes=60).collect()} == {r.doc_id for r in got}  # several blocks
    assert sorted(r.doc_id for r in drop_leaking(docs, items, index_bytes=60).collect()) == [102, 103]


def test_odd_rows_and_empty_tables(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "same text of a few words", 1, "b")], ITEMS)
    want = sorted((str(r.doc_id) for r in odd_documents.collect() if "of a few words" in (r.text or "")))
    assert sorted(str(r.doc_id) for r in leaks(odd_documents, items).collect()) == want
    clean = drop_leaking(odd_documents, items)
    assert clean.columns == odd_documents.columns and clean.count() == odd_documents.count() - len(want)
    none = spark.createDataFrame([], ITEMS)
    assert leaks(odd_documents, none).count() == 0 and leaks(no_documents, items).count() == 0
    assert drop_leaking(odd_documents, none).count() == odd_documents.count()
    assert Matcher([]).find(["x"]) == [[]]


def test_query_finds_the_items_that_stand_in_documents(spark):
    flat = lambda t: " ".join(t.lower().split())
    docs = [(r.doc_id, flat(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, flat(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    whole = {(d, i) for d, t in docs for i, x in items if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.queries()["op9_decontamination"](spark, SF_SMALL).collect()}
    assert whole <= got and len(got - whole) <= 1
