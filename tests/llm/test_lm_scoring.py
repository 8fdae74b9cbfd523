import math
import zlib
from collections import Counter

import numpy as np

from socialcart.llm import lm_scoring, queries
from socialcart.llm.lm_scoring import score
from socialcart.llm.ngrams import (BASE, CountFilter, bigram_keys, fill_segment, followers_exponent, histogram, level, level_counts, pack,
                                   pack_sorted, unpack, unpack_sorted)
from socialcart.llm.shingles import WordHasher
from tests.conftest import SF_SMALL


def _words(text):
    return [*(text or "").encode().lower().split(), b""]


def _held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def _check_base(rows, got):
    c = Counter(w for d, t in rows if not _held(d) for w in _words(t))
    n, v = sum(c.values()), len(c)
    norm = n + 0.1 * (v + 1)
    want = sorted(((d, _held(d), len(_words(t)), sum(c[w] > 0 for w in _words(t)),
                    sum(math.log10((c[w] + 0.1) / norm) for w in _words(t))) for d, t in rows), key=str)
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in got), key=str)
    assert [x[:4] for x in have] == [x[:4] for x in want]
    assert np.allclose([x[4] for x in have], [x[4] for x in want], rtol=1e-9)
    assert {r.train_tokens for r in got} <= {n}


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.queries()["op6_lm_scoring"](spark, SF_SMALL).collect()
    _check_base(rows, got)
    # the model, with exact counts in place of the filter's
    uni = Counter(w for d, t in rows if not _held(d) for w in _words(t))
    two = Counter(p for d, t in rows if not _held(d) for p in zip([b"", *_words(t)], _words(t), strict=False))
    norm = sum(uni.values()) + 0.1 * (len(uni) + 1)
    expected = level_counts(60)
    low, high = 0.0, 1.0
    for _ in range(60):
        b = (low + high) / 2
        low, high = (b, high) if sum(c ** b for c in uni.values()) < len(two) else (low, b)

    def p(v, w):
        base = (uni[w] + 0.1) / norm
        if not uni[v]:
            return base
        pair = expected[level(np.array([two[v, w]]))[0]] if two[v, w] else 0
        return (min(pair, uni[v], uni[w]) + uni[v] ** b * base) / (uni[v] + uni[v] ** b)

    want = {d: sum(math.log10(p(v, w)) for v, w in zip([b"", *_words(t)], _words(t), strict=False)) for d, t in rows}
    off = [r.score - want[r.doc_id] for r in got]
    # counts of a level stand for their mean in b, so b differs a little; a false hit only adds
    assert min(x / -want[r.doc_id] for x, r in zip(off, got, strict=True)) > -1e-3
    assert np.mean(off) < 0.01 * -np.mean(list(want.values()))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_a_second_copy_raises_the_score(spark):
    """Bigrams seen once are in the model, so a second training copy shows."""
    train = [i for i in range(400) if not _held(i)]
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 3000, 60))) for i in train]
    again = [(1000 + i, t) for i, t in rows if i < 40 and not _held(1000 + i)]
    once, twice = ({r.doc_id: r.score for r in score(spark.createDataFrame(x, "doc_id long, text string")).collect()}
                   for x in (rows, rows + again))
    copied = {d - 1000 for d, _ in again}
    assert min(twice[d] - once[d] for d in copied) > 5
    assert max(abs(twice[d] - once[d]) for d, _ in rows if d not in copied) < 5


def test_followers_exponent():
    rng = np.random.default_rng(3)
    counts = rng.zipf(1.5, 20_000)
    for b in (0.3, 0.6, 0.9):
        got = followers_exponent(*histogram(counts.astype(np.uint64)), int((counts ** float(b)).sum()))
        assert abs(got - b) < 0.01
    assert followers_exponent(*histogram(np.zeros(0, np.uint64)), 0) < 1.0


def test_odd_rows_small_chunks_and_filter(spark, odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_TOKENS", 50)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = score(odd_documents, max_filter_bytes=4096).collect()
    _check_base(rows, got)
    assert all(math.isfinite(r.score) for r in got)
    assert score(no_documents).count() == 0


def test_a_filter_of_many_blocks_is_the_same_model(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_TOKENS", 4000)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in np.minimum(rng.zipf(1.3, 100), 150))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).persist()
    one, many, cut = (sorted((r.doc_id, r.score) for r in score(docs, max_filter_bytes=n).collect()) for n in (2 ** 27, 4096, 600))
    assert [d for d, _ in one] == [d for d, _ in many] == [d for d, _ in cut]
    assert np.allclose([x for _, x in one], [x for _, x in many], rtol=1e-9)
    # cut segments lie in other words of the filter, so other pairs are false hits
    assert np.allclose([x for _, x in one], [x for _, x in cut], rtol=0.02)


def test_no_training_documents(spark):
    held = next(i for i in range(1000) if _held(i))
    got = score(spark.createDataFrame([(held, "some words")], "doc_id long, text string")).collect()
    _check_base([(held, "some words")], got)
    assert abs(got[0].score - got[0].base_score) < 1e-9


def test_filter_holds_quantised_counts():
    rng = np.random.default_rng(2)
    h = WordHasher().hashes([b"w%d" % i for i in range(4000)])
    seg, key = bigram_keys(h[:-1], h[1:], 4)
    counts = np.minimum(rng.zipf(1.6, len(key)), 10_000).astype(np.uint32)
    words = 4000
    table = np.concatenate([fill_segment(s, key[seg == s], counts[seg == s], words) for s in range(4)])
    got = CountFilter(table, 4, int(level(counts).max())).counts(h[:-1], h[1:])
    want = level_counts(40)[level(counts)]
    assert (got >= want).all() and (got == want).mean() > 0.99
    assert all(BASE ** (level(np.array([c]))[0] - 1) <= c + 1e-6 < BASE ** level(np.array([c]))[0] + 1e-3 for c in range(1, 500))


def test_packed_arrays():
    x = np.sort(np.random.default_rng(1).integers(0, 2 ** 63, 1000, np.uint64))
    assert (unpack_sorted(pack_sorted(x), np.uint64) == x).all() and (unpack(pack(x), np.uint64) == x).all()
    assert len(unpack(pack(x[:0]), np.uint64)) == 0
