import zlib
from collections import defaultdict

import numpy as np
import pytest

from socialcart.llm.mixture import Schedule, apportion, phases, rounds
from socialcart.llm.packing import pack, sequences
from socialcart.llm.tokens import ChunkEncoder, public_path

TOKENIZER = public_path("word_bpe_49k.json")


def _whole(encoder, text):
    return [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_chunk_ids_are_the_tokenizers_ids():
    enc = ChunkEncoder(TOKENIZER, cache_chunks=5)  # starts afresh all the time
    texts = ["A<|endoftext|>b don't it's I'LL <|ENDOFTEXT|>, <|startoftext|>. x", "İstanbul, ǅ. ß!, a\x1cb !\x1c! é, ́.",
             "日本。 ١٢. 3.14, v2.0. ², Ⅷ, a.,b., ,. .,", " \n\t", "", "K x, y. ﬁn, Σας, ΟΔΟΣ.", "word word, Word."]
    for t in texts * 2:
        (got,) = enc.encode([t.encode()])
        assert np.frombuffer(got, enc.dtype).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids


def _check(pieces, docs, capacity, enc):
    """Every id in exactly one piece; sequences gapless and within capacity."""
    whole = defaultdict(list)
    for doc_id, text in docs:
        whole[doc_id].append(np.array(_whole(enc, text), "<u4"))
    covered = defaultdict(int)
    for p in pieces:
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32
                   for x in whole[p.doc_id])
        covered[p.doc_id] += p.length
    assert covered == {d: sum(map(len, xs)) for d, xs in whole.items()}
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append((p.offset, p.length))
    assert sorted(windows) == list(range(len(windows)))
    for k, runs in windows.items():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at and length > 0
            at += length
        assert at == capacity or k == max(windows)


@pytest.mark.parametrize("mixture", [None, {"s": 3.0, "t": 1.0}])
def test_odd_rows(spark, odd_documents, mixture):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    enc = ChunkEncoder(TOKENIZER)
    got = pack(odd_documents, capacity=64, mixture=mixture).collect()
    _check(got, docs, 64, enc)


def test_windows_have_the_target_mixture(spark):
    df = spark.range(600).selectExpr("id AS doc_id", "repeat('some words of text ', 1 + cast(id % 37 AS int)) AS text",
                                     "concat('src', if(id % 3 = 0, 0, id % 11)) AS source").repartition(5)
    got = pack(df, capacity=256, with_ids=True)
    rows = got.collect()
    total, own = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in rows:
        total[p.source] += p.length
        own[p.sequence_id][p.source] += p.length
    every, last = sum(total.values()), max(own)
    for k, by in own.items():
        if k != last:
            assert all(abs(by[s] - 256 * n / every) < 3 for s, n in total.items())
    whole = sequences(got).collect()
    assert all(len(r.input_ids) == 256 for r in whole if r.sequence_id != last)


def test_few_queues_share_the_rest(spark):
    df = spark.range(200).selectExpr("id AS doc_id", "'a few words' AS text", "concat('s', id) AS source")
    rows = pack(df, capacity=32, max_queues=4).collect()
    _check(rows, [(i, "a few words") for i in range(200)], 32, ChunkEncoder(TOKENIZER))


def test_empty_table(no_documents):
    assert pack(no_documents).count() == 0


def test_rounds_and_schedule_are_exact():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, capacity = int(rng.integers(1, 300)), int(rng.integers(3, 40))
        weights = [int(x) for x in rng.integers(0, 1000, 7)]
        quota = apportion(n * capacity, weights if any(weights) else [1] * 7)
        dealt = list(rounds(quota, [1] * n, capacity))
        assert all(sum(t) == capacity and min(t) >= 0 for t in dealt)
        assert [sum(x) for x in zip(*dealt, strict=True)] == quota
        totals = [int(x) for x in rng.integers(0, 5000, 7)]
        plan = phases(totals, weights if rng.random() < 0.5 else None, capacity)
        assert [sum(x) for x in zip(*(q for _, q in plan), strict=True)] == totals
        assert all(sum(q) == k * capacity for k, q in plan[:-1])
        schedule, filled = Schedule(plan, capacity), defaultdict(list)
        for queue, t in enumerate(totals):
            for a, b, window, offset in schedule.pieces(queue, 0, t):
                filled[window].append((offset, b - a))
        for window, runs in filled.items():
            at = 0
            for offset, length in sorted(runs):
                assert offset == at
                at += length
            assert at == capacity or window == max(filled)


def test_a_step_that_does_not_encode_drops_the_tokenizer(spark):
    from socialcart.llm.common import map_arrow
    from socialcart.llm.packing import tokenise

    def held(batches):
        import sys

        import pyarrow as pa

        tokens = sys.modules.get("socialcart.llm.tokens")
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([tokens.encoder.cache_info().currsize if tokens else 0] * batch.num_rows, pa.int64())], names=["n"])

    docs = spark.createDataFrame([(i, "some words", "a") for i in range(40)], "doc_id long, text string, source string").repartition(4)
    for _ in range(2):
        assert tokenise(docs).count() == 40
    assert {r.n for r in map_arrow(docs.select("doc_id"), held, "n long").collect()} == {0}
