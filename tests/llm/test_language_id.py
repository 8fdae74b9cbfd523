import zlib

import numpy as np

from socialcart.llm import queries
from socialcart.llm.language_id import fit, identify, keep_known_languages
from socialcart.llm.subwords import Scorer, bucket_counts, scores, train
from tests.conftest import SF_SMALL


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.queries()["op10_language_id"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.95


def test_odd_rows(spark, odd_documents, no_documents):
    got = identify(odd_documents).collect()
    rows = odd_documents.collect()
    assert len(got) == len(rows)
    no_letter = sum(not any(c.isalpha() for c in r.text or "") for r in rows)
    assert sum(r.lang_pred == "und" for r in got) == no_letter
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in got if r.lang_pred != "en")
    kept = keep_known_languages(odd_documents, fit(odd_documents))
    assert kept.columns == odd_documents.columns and kept.count() == len(rows) - no_letter
    assert identify(no_documents).count() == 0
    assert {r.lang_pred for r in identify(no_documents.union(odd_documents.withColumn("lang", odd_documents.text).limit(0))).collect()} == set()


def test_no_labels(spark):
    df = spark.createDataFrame([(1, "a text", None), (2, "more", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in identify(df).collect()] == [("und", 0.0)] * 2


def test_word_sums_equal_whole_text_counts():
    texts = ["Ünter the tree, unter THE 3 trees", "", "...", "x" * 5000, "a b c", None]
    counts = [bucket_counts(t) for t in texts]
    logits = np.random.default_rng(1).normal(size=(2 ** 16, 3))
    want = scores(logits, *zip(*counts, strict=True))
    for cache in (2, 1000):
        ask = Scorer(logits, cache)
        assert np.allclose(np.concatenate([ask(texts[:3]), ask(texts[3:])]), want, atol=1e-4)


def test_training_separates_two_kinds():
    texts = [f"{'sch' if i % 2 else 'que'}{i} {'ung' if i % 2 else 'ion'}{i}" for i in range(200)]
    b, c = zip(*map(bucket_counts, texts), strict=True)
    y = np.arange(200) % 2
    logits = train(list(b[:150]), list(c[:150]), y[:150], 2)
    assert (scores(logits, list(b[150:]), list(c[150:])).argmax(axis=1) == y[150:]).mean() > 0.95
