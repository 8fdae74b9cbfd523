import zlib

import numpy as np

from socialcart.llm import queries
from socialcart.llm.quality import classify, fit_network
from socialcart.llm.random_index import BUCKETS, CAPITALS, DIM, REPEAT, ContextSums, TokenCoder, index_vectors, pool, word_vectors
from tests.conftest import SF_SMALL

LABELS = "doc_id long, quality int, toxic int, text string"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    got = queries.queries()["op4_quality"](spark, SF_SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
               and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9


def test_odd_rows_and_empty_tables(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(3, 1, 0, "t"), (3, 0, 0, "t"), (8, 1, None, "t"), (9, 0, 0, "t"), (None, 1, 1, "t"),
                                    (4, None, 1, "t"), (99, 1, 0, "t")], LABELS)
    got = classify(odd_documents, labels).collect()
    assert len(got) == odd_documents.count() and all(0 <= r.score <= 1 for r in got)
    none = classify(odd_documents, spark.createDataFrame([], LABELS)).collect()
    assert {r.score for r in none} == {0.5}
    assert classify(no_documents, labels).count() == 0


def test_tokens():
    coder = TokenCoder(cache_chunks=1)
    assert coder(None).tolist() == coder(b" \n").tolist() == []
    a, b = coder("Word word!! ORD word".encode()), coder("word WORD".encode())
    assert a[0] == b[0] and a[1] == REPEAT and a[3] == CAPITALS and a[5] == a[0]
    assert b.tolist() == [b[0], CAPITALS, b[0]]


def test_context_sums_equal_a_plain_loop():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 50, n) for n in (0, 1, 2, 9, 30)]
    sums, places, want = ContextSums(), *index_vectors()[:1], np.zeros((BUCKETS, DIM))
    sums.add(texts)
    signs = index_vectors()[1]
    for t in texts:
        for i, word in enumerate(t):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(t):
                    want[word, places[t[j]]] += signs[t[j]]
    assert np.allclose(sums.sums.reshape(BUCKETS, DIM), want)
    vectors = word_vectors(sums.sums)
    both = np.concatenate([vectors, vectors ** 2], axis=1)
    out = pool(both, texts)
    assert not out[0].any() and np.allclose(out[4][:DIM], vectors[texts[4]].mean(axis=0), atol=1e-5)
    assert np.allclose(out[4][DIM:2 * DIM], vectors[texts[4]].std(axis=0), atol=1e-3)


def test_network_is_calibrated():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 5))
    p = 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 1]))
    y = (rng.random(4000) < p).astype(float)
    score = fit_network(x[:3000], y[:3000]).score(x[3000:])
    assert np.abs(score - p[3000:]).mean() < 0.12
    assert abs(score.mean() - y[3000:].mean()) < 0.05
