import random
from collections import defaultdict

import numpy as np
import pytest

from socialcart.llm import near_dedup, queries
from socialcart.llm.components import components
from socialcart.llm.near_dedup import drop_near_copies, near_copies
from socialcart.llm.shingles import WordHasher, band_keys, overlap, shingle_hashes, sketches
from tests.conftest import SF_SMALL


def _set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*(words[i:] for i in range(5)))) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def _groups(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _brute(rows):
    """Per row (doc_id, set size, component id) by comparing all pairs."""
    sets = [_set(t) for _, t in rows]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    members = defaultdict(list)
    for i, g in enumerate(_groups(len(rows), links)):
        members[g].append(i)
    out = {}
    for own in members.values():
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        for i in own:
            out[i] = (rows[i][0], len(sets[i]), min(ids) if ids else None)
    return sorted(out.values(), key=str)


def test_odd_rows(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = near_copies(odd_documents).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_drifting_copies_in_small_blocks(spark, monkeypatch):
    """A family whose members drift from its centre, and texts that share a
    common passage: same components as comparing all pairs."""
    for name, value in (("BLOCK", 16), ("CELL", 10), ("ROWS_A_CELL", 50)):
        monkeypatch.setattr(near_dedup, name, value)
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    base, common = ([rnd.choice(vocab) for _ in range(n)] for n in (150, 60))
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rnd.randint(0, 10)):
            words[rnd.randrange(len(words))] = rnd.choice(vocab)
        texts.append(" ".join(words))
    texts += [" ".join(common + [rnd.choice(vocab) for _ in range(rnd.randint(5, 60))]) for _ in range(80)]
    texts += [" ".join(rnd.choice(vocab) for _ in range(80)) for _ in range(30)]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    got = near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _brute(rows)


def test_low_bytes_that_agree_are_no_earlier_band(spark):
    """Nodes 2 and 3 agree on all low bytes of band 0 but not on its key, and
    share bands 1 and 2 with the centre 1: the pair counts in band 1 alone."""
    keys = {1: [10, 21, 22, *range(100, 129)], 2: [11, 21, 22, *range(200, 229)], 3: [12, 21, 22, *range(300, 329)]}
    rows = [(band, no, 3, 1, node, 1, node, bytes(128), keys[node], 0) for no, band in ((1, 21), (2, 22)) for node in keys]
    members = spark.createDataFrame(rows, "band long, no int, n long, main long, node long, centre long, component long, "
                                          "sketch binary, bands array<long>, cell long")
    got = near_dedup._candidates(members, near_dedup.MIN_AGREE).collect()
    assert sorted((str(r.node), r.ys) for r in got) == [("2", [3]), ("None", [3])]
    # in band 2 alone they have met before
    assert near_dedup._candidates(members.where("no = 2"), near_dedup.MIN_AGREE).count() == 0


def test_survivors_keep_all_columns(odd_documents):
    got = drop_near_copies(odd_documents)
    assert got.columns == odd_documents.columns
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    kept = [(r.doc_id, r.text) for r in got.collect()]
    sets = [s for s in map(_set, (t for _, t in kept)) if s]
    assert not any(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert all(any(100 * len(_set(t) & s) >= 75 * len(_set(t) | s) for s in sets) for _, t in rows if _set(t))
    assert sum(not _set(t) for _, t in kept) == sum(not _set(t) for _, t in rows)


def test_empty_table(no_documents):
    assert near_copies(no_documents).count() == 0


def test_query_on_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.queries()["op7_near_dedup"](spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _brute(rows)


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    x = np.unique(rng.integers(0, 2 ** 63, 1200, np.uint64))
    sets = [x[:1000], x[143:1143], x[:1], x[:3], x[:0], np.unique(x[600:])]
    s = sketches(sets, 128)
    assert (s[[0, 1, 2, 3, 5]] != np.iinfo(np.uint64).max).all()
    both = overlap(sets[0], sets[1])
    assert abs((s[0] == s[1]).mean() - both / (2000 - both)) < 0.15
    assert (sketches(sets[:1], 128)[0] == s[0]).all()  # alone or in a batch
    assert band_keys(s, 4).shape == (6, 32)
    many = [np.unique(np.concatenate([x[:800], rng.integers(0, 2 ** 63, 114, np.uint64)])) for _ in range(200)]
    agree = [(a == b).mean() for a, b in zip(sketches(many, 128)[:-1], sketches(many, 128)[1:], strict=True)]
    assert abs(np.mean(agree) - 800 / 1028) < 0.01 and np.std(agree) < 0.05


@pytest.mark.parametrize("text", ["", "  ", "A b", "a  B\tc d e", "a b c d e f a b c d e", "É é x y z w"])
def test_shingle_counts(text):
    (got,) = shingle_hashes(WordHasher(cache_words=2), [text.encode()])
    assert len(got) == len(_set(text)) and (np.diff(got.astype(object)) > 0).all()


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 300)]
    links += [(rng.randrange(500, 700), rng.randrange(500, 700)) for _ in range(90)] + [(1, 0), (7, 7)]
    want = _groups(700, links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in nodes}


def test_plans_stay_small(spark):
    """What the driver holds grows with the joins and broadcasts it plans: each
    value attached to the pairs is one join and no aggregate."""
    pairs = spark.createDataFrame([(1, i) for i in range(2, 9)], "a long, b long")
    table = spark.createDataFrame([(i, bytes(128)) for i in range(1, 9)], "node long, sketch binary")
    both = near_dedup._agreeing(pairs, table, 128)
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("Join "), plan.count("Aggregate ")) == (2, 0)
    assert sorted(map(tuple, both.collect())) == [(1, i) for i in range(2, 9)]
    # a star step plans one join, over stored tables
    star = components(pairs.withColumnsRenamed({"a": "u", "b": "v"}))
    assert star._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 0
    assert {tuple(r) for r in star.collect()} == {(i, 1) for i in range(1, 9)}
