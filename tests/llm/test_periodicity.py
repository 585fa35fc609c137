import random
import zlib

import pytest
from llm_texts import words
from pyspark.sql import functions as F

from smoglake.llm import periodicity as P


def brute(ids, least=P.LEAST):
    """Every (start, length, period) by comparing all lags, keeping the smallest period of a stretch."""
    n, found = len(ids), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            j = i
            while j < n and ids[j] == ids[j - q]:
                j += 1
            if j - i >= max(least - q, q):
                found.setdefault((i - q, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def as_words(text):
    return [str(x).encode() for x in text]


def test_small_cases():
    assert P.find_runs(as_words("a" * 11)) == [] and P.find_runs(as_words("a" * 12)) == [(0, 12, 1)]
    assert P.find_runs(as_words("abababababab")) == [(0, 12, 2)]
    assert P.find_runs(as_words("xabcdefgabcdefgy")) == [(1, 14, 7)]
    assert P.find_runs(as_words("abcdefabcdefa")) == [(0, 13, 6)]
    assert P.find_runs([]) == [] and P.find_runs([b"a"]) == []


@pytest.mark.parametrize("seed", range(12))
def test_random_texts_against_brute_force(seed):
    pick = random.Random(seed)
    for _ in range(150):
        letters = pick.choice([1, 2, 2, 3, 5, 50])
        text = []
        while len(text) < pick.choice([5, 40, 130, 400]):
            part = [pick.randrange(letters) for _ in range(pick.choice([1, 2, 7, 13, 30, 60]))]
            text += (part * pick.choice([1, 1, 2, 3, 9]))[:pick.choice([None, None, -1, -3])]
            if pick.random() < 0.2:
                text += text[-pick.randrange(1, 80):]
        assert P.find_runs(as_words(text)) == brute(text), text


def test_fibonacci_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    for text in (b, b * 2, [0] * 700, ([0] * 40 + [1]) * 17, ([0, 1] * 30 + [2]) * 9 + [0, 1] * 50,
                 ([0, 1] * 60 + [0]) * 3, ([0, 0, 1] * 40 + [0]) * 2 + [0, 0, 1] * 30, [0, 1, 2] * 50 + [1, 2] + [0, 1, 2] * 50):
        assert P.find_runs(as_words(text)) == brute(text)


def test_work_follows_the_length_in_texts_of_one_word_and_long_loops(monkeypatch):
    opened = []
    real = P._sweep
    monkeypatch.setattr(P, "_sweep", lambda ids, places, *rest: (opened.append(len(places)), real(ids, places, *rest)))
    for text in ([b"a"] * 20_000, words(500, 1) * 40, ([b"a"] * 99 + [b"b"]) * 200):
        opened.clear()
        runs = P.find_runs([w if isinstance(w, bytes) else w.encode() for w in text])
        assert (0, len(text)) in {r[:2] for r in runs}
        assert sum(opened) <= 30 * len(text)


def test_kept_words():
    text = as_words("xabcdefgabcdefgaby")
    assert b"".join(P.kept_words(text, P.find_runs(text))) == b"xabcdefgy"
    assert P.kept_words(text, []) == text


def test_looped():
    def slow(i, w):
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 or not n:
            return w
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [w[a + (k - a) % p] if k >= a else w[k] for k in range(n)]

    for i in range(300):
        for n in (0, 1, 5, 200):
            w = as_words(range(n))
            assert P.looped(i, w) == slow(i, w)


def test_awkward_rows(spark, awkward, no_docs, clashing):
    for docs in (awkward, clashing):
        out = P.periodic_runs(docs)
        assert out.columns == [*docs.columns, "runs", "collapsed"] and out.count() == docs.count()
        for r in out.collect():
            assert r.collapsed.encode() == b" ".join((r.text or "").encode().split()) and r.runs == []  # these texts have no run
    assert P.periodic_runs(no_docs).count() == 0
    loops = spark.createDataFrame([(None, "x y " * 10), (3, "x y " * 10), (3, "x y " * 10)], "doc_id long, text string")
    out = P.periodic_runs(loops).collect()
    assert all(r.collapsed == "x y" and [tuple(x) for x in r.runs] == [(0, 20, 2)] for r in out)


def test_query_columns(spark):
    from smoglake.llm.catalog import QUERIES

    out = QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001")
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint"] * 6 + ["string"] * 2
    rows = out.collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)
    for r in rows:
        w = P.looped(r.doc_id, (texts[r.doc_id] or "").encode().split())
        numbers = {x: i for i, x in enumerate(dict.fromkeys(w))}
        runs = brute([numbers[x] for x in w]) if len(w) < 1500 else P.find_runs(w)
        assert r.n_runs == len(runs)
        if runs:
            best = min(runs, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (*best, 1000 * best[1] // best[2])
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert out.filter(F.col("runs_sha256").isNull() | F.col("collapsed_sha256").isNull()).count() == 0


def test_query_against_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cur = con.execute(P.OP11_SQL)
    got = P.op11_periodic_runs(spark, sf)
    assert got.columns == [c[0] for c in cur.description]
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())
