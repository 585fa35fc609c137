import random

import numpy as np
import pytest

from smoglake.llm import near_dedup as nd
from smoglake.llm.components import components

from llm_texts import words


def jaccard(a, b):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def edited(text, edits, seed):
    pick, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[pick.randrange(len(w))] = "x" + str(pick.random())
    return " ".join(w)


def test_linked_is_jaccard_of_shingles_in_order():
    for n in (8, 30, 80, 400):
        base = " ".join(words(n, n))
        for edits in range(0, 12):
            other = edited(base, edits, edits)
            want = jaccard(base, other) >= 0.8
            assert nd.linked(nd.text_shingles(base), nd.text_shingles(other)) == want
    w = words(400, 9)
    swapped = " ".join(w[200:] + w[:200])
    assert jaccard(" ".join(w), swapped) > 0.8 and not nd.linked(nd.text_shingles(" ".join(w)), nd.text_shingles(swapped))


def test_in_order():
    left = np.arange(6)
    assert nd.in_order(left, np.array([0, 1, 2, 3, 4, 5]), 2) == 6
    assert nd.in_order(left, np.array([1, 0, 2, 5, 4, 3]), 6) == 3
    assert nd.in_order(left, np.array([0, 1, 2, 3, 4, 50]), 2) == 5


def test_sketches_meet_at_the_threshold():
    missed = total = 0
    for n in (12, 18, 22, 50, 60, 68, 120, 500):
        for seed in range(60):
            base = " ".join(words(n, seed))
            other = edited(base, max(1, n // 45), seed)
            if jaccard(base, other) >= 0.8:
                total += 1
                missed += not set(nd.sketch_keys(base)) & set(nd.sketch_keys(other))
    assert total > 150 and missed == 0


def test_classes_against_brute_force_with_a_hot_group(spark):
    rng, texts = random.Random(4), []
    hot = " ".join(words(150, 1))
    texts += [edited(hot, rng.randrange(0, 5), i) for i in range(300)]  # near copies of one text
    texts += [hot] * 100
    shared = " ".join(words(60, 2))
    texts += [shared + " " + " ".join(words(rng.randrange(20, 200), 100 + i)) for i in range(150)]  # one common passage
    for i in range(60):
        base = " ".join(words(rng.randrange(6, 300), 1000 + i))
        texts += [base, edited(base, rng.randrange(0, 4), i), base.upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.id: r.component_id for r in nd.classes(docs).collect()}
    codes = [nd.text_shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if root(i) != root(j) and nd.linked(codes[i], codes[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: root(i) for i in range(len(texts))}


def test_components_of_a_long_chain(spark):
    n = 200
    edges = [(i, i + 1) for i in range(n)] + [(500, 501), (700, 700)]
    random.Random(3).shuffle(edges)
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(n + 1)}, 500: 500, 501: 500}


def test_awkward_rows(awkward, no_docs, clashing):
    assert nd.keep_one(no_docs).count() == 0
    rows = nd.classes(awkward).collect()
    assert len(rows) == awkward.count()
    got = {r.id: (r.component_id, r.kept) for r in rows}
    assert got[2] == (1, False) and got[8][0] == 1 and got[1] == (1, True)
    assert got[3] == (3, True) and got[4] == (4, True) and got[5] == (5, True)  # no words, no links
    assert got[7] == (7, True) and got[9] == (9, True)
    kept = nd.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "7", "9", "None"])


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    want = sorted(con.sql(nd.OP6_SQL).fetchall())
    assert sorted(map(tuple, nd.op6_near_dedup(spark, f"/root/testdata/{sf}").collect())) == want


def test_a_large_family_whose_pairs_miss_every_pivot(spark):
    """Extracts of three quarters of a text, all shorter than it and unlike it: whole copies link with each other only."""
    pick, parts = random.Random(6), [" ".join(words(14, 700 + i)) for i in range(24)]
    whole = " ".join(parts)
    texts = [" ".join(parts[k] for k in sorted(pick.sample(range(24), 18))) for _ in range(500)]
    texts += [edited(whole, 2, i) for i in range(3)]
    codes = [nd.text_shingles(t) for t in texts]
    assert not any(nd.linked(a, b) for a in codes[500:] for b in codes[:500]) and nd.linked(codes[500], codes[501])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.id: r.component_id for r in nd.classes(docs).collect()}
    assert [got[i] for i in (500, 501, 502)] == [500, 500, 500]


def test_signatures_never_differ_in_more_than_the_texts():
    for edits in range(0, 40, 3):
        base = " ".join(words(200, edits))
        a, b = nd.text_shingles(base), nd.text_shingles(edited(base, edits, edits))
        bits = np.bitwise_count((nd.signature(a) ^ nd.signature(b)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_texts_that_repeat_a_passage_meet():
    for n, repeats in ((12, 4), (30, 3), (60, 2), (60, 8), (300, 3), (300, 12)):
        for seed in range(20):
            passage = words(n, seed)
            once, often = " ".join(passage), " ".join(passage * repeats)
            if jaccard(once, often) >= 0.8:
                assert nd.linked(nd.text_shingles(once), nd.text_shingles(often))
                assert set(nd.sketch_keys(once)) & set(nd.sketch_keys(often)), (n, repeats, seed)


def test_classes_of_repeated_passages_against_brute_force(spark):
    texts = []
    for i in range(12):
        passage, tail = words(40 + 20 * i, 2000 + i), words(5, 3000 + i)
        texts += [" ".join(passage * k + tail) for k in (1, 3, 7)] + [" ".join(words(40, 4000 + i))]
    codes = [nd.text_shingles(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:  # the least label around, until nothing changes
        label = [min(label[j] for j in range(len(texts)) if i == j or nd.linked(codes[i], codes[j])) for i in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.id: r.component_id for r in nd.classes(docs).collect()} == dict(enumerate(label))


def test_keep_one_loses_no_text(spark):
    one, two = " ".join(words(60, 41)), " ".join(words(60, 42))
    rows = [(1, one, "a"), (1, two, "b"), (2, one, "c"), (None, two, "d"), (None, one + " x", "e"), (None, one + " x", "f"),
            (3, "", "g"), (3, "", "h"), (3, None, "i"), (1, one, "j")]
    kept = [tuple(r) for r in nd.keep_one(spark.createDataFrame(rows, "doc_id long, text string, words_digest string")).collect()]
    assert sorted((str(i), str(t)) for i, t, _ in kept) == sorted(
        [("1", one), ("1", two), ("None", one + " x"), ("3", ""), ("3", "None")])


def test_slots_are_counted_in_a_row_per_task_and_range(spark):
    """A task sends its counts by ranges of slots, however many texts a large bucket has; the sums are exact."""
    from collections import Counter

    hot, sent = " ".join(words(150, 51)), {}
    for n in (100, 400):
        texts = [edited(hot, 6, i) for i in range(n)] + [None, ""]
        docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
        parts = nd.slot_parts(docs).collect()
        sent[n] = len(parts)
        want = Counter(s for t in texts for s in nd.slots_of(nd.text_shingles(t)).tolist())
        got = Counter()
        for r in parts:
            got.update(dict(zip(r.slots, r.counts)))
        assert got == want
        rows = nd.slot_counts(docs).collect()
        assert {s: c for r in rows for s, c in zip(r.slots, r.counts, strict=True)} == {s: c for s, c in want.items() if c > 1}
        assert all(s // nd.SLOT_RANGE == r.range for r in rows for s in r.slots) and len({r.range for r in rows}) == len(rows)
        assert len(want) > 5 * nd.SLOTS // nd.SLOT_RANGE >= sent[n]
