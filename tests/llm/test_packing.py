import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from smoglake.llm import cutting_stock, packing
from smoglake.llm.tokens import COVERED, Encoder, _tokenizer


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=25))
def test_patterns_meet_the_demand_exactly(demand):
    patterns, left = cutting_stock.whole_patterns(demand, 64, spare=1)
    met = dict(left)
    for pattern, times in patterns:
        total = sum(s * c for s, c in pattern.items())
        assert times > 0 and total <= 64 and cutting_stock.pattern_cost(total, 64) - total <= 1
        for s, c in pattern.items():
            met[s] = met.get(s, 0) + c * times
    assert met == demand


def test_column_generation_reaches_the_optimum():
    # 6 of 0.4, 6 of 0.35, 6 of 0.25 of the capacity fill 6 sequences without waste; no power of two is met
    basis, times = cutting_stock.solve({40: 6, 35: 6, 25: 6}, 100)
    cost = sum(cutting_stock.pattern_cost(sum(s * c for s, c in p.items()), 100) * x for p, x in zip(basis, times, strict=True))
    assert abs(cost - 600) < 1e-6


def test_price_is_the_best_pattern():
    worth = np.full(21, -np.inf)
    worth[[3, 5, 7]] = [2.9, 5.2, 7.4]
    reduced, pattern = cutting_stock.price(worth, 20)
    best = min(cutting_stock.pattern_cost(3 * a + 5 * b + 7 * c, 20) - (2.9 * a + 5.2 * b + 7.4 * c)
               for a in range(7) for b in range(5) for c in range(3) if 0 < 3 * a + 5 * b + 7 * c <= 20)
    assert abs(reduced - best) < 1e-9 and sum(s * c for s, c in pattern.items()) <= 20


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet=st.characters(max_codepoint=COVERED - 1), max_size=40)
       | st.lists(st.sampled_from([" ", "  ", "\n", "'s", "'ll", "don't", "12", "é", "²", "\xa0", "\x85", "\x1c", "<|endoftext|>", "!?", "word"]),
                  max_size=12).map("".join))
def test_ids_are_the_tokenizers(text):
    path = packing.tokenizer_path()
    want = _tokenizer(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(Encoder(path).encode([text])[0], "<u4").tolist() == want


def check(pieces, docs):
    """Exact round trip: every id of every row lies in one piece, sequences are gapless and not over-full."""
    path = packing.tokenizer_path()
    tok = _tokenizer(path)
    left = {}
    for r in pieces:
        left.setdefault((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens), []).append(r)
    by_doc = {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        while at < len(ids):  # any piece of this id that starts here and holds these ids
            r = next(r for r in by_doc[doc_id] if r.start == at and r.doc_tokens == len(ids)
                     and zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32)
            by_doc[doc_id].remove(r)
            at += r.length
        assert at == len(ids)
    assert not any(by_doc.values())
    places = {}
    for r in pieces:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = 0
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
        padding += cutting_stock.pattern_cost(end, 2048) - end
    return padding


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_round_trip(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()]
    pieces = packing.op4_packing(spark, f"/root/testdata/{sf}").collect()
    total = sum(r.length for r in pieces)
    assert check(pieces, docs) <= 0.01 * total


def test_awkward_rows(awkward, awkward_rows, no_docs, clashing):
    assert packing.pack(no_docs).count() == 0
    check(packing.pack(awkward).collect(), [(r[0], r[1]) for r in awkward_rows])
    assert packing.pack(clashing).columns == packing.PIECES


def test_added_tokens_get_their_own_ids():
    from tokenizers import Tokenizer
    path = packing.tokenizer_path()
    plain = Tokenizer.from_file(path)
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\ny é", "<|endoftext| >", "漢<|endoftext|>字"):
        got = np.frombuffer(Encoder(path).encode([text])[0], "<u4").tolist()
        assert got == plain.encode(text, add_special_tokens=False).ids
    assert 50256 in plain.encode("a <|endoftext|> b", add_special_tokens=False).ids


def test_the_piece_cache_is_bounded_and_keeps_what_is_used(monkeypatch):
    from smoglake.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    made = Encoder(packing.tokenizer_path())
    calls, piece = [], made._piece
    monkeypatch.setattr(made, "_piece", lambda p: calls.append(p) or piece(p))
    plain = tokens._tokenizer(made.path)
    for i in range(100):
        text = "common words stay " + " ".join(f"q{i}x{k}" for k in "abc")
        assert np.frombuffer(made.encode([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(made.known) + len(made.older) <= 2 * 50
    assert calls.count(" words") == 1


def test_maps_hold_a_bounded_number_of_rows(spark):
    from pyspark.sql import functions as F
    from smoglake.llm import common

    def run(values):
        return [[len(values)] * len(values), [2 * v for v in values]]

    docs = spark.range(0, 3000, 1, 1).select("id", F.col("id").alias("v"))
    rows = common.map_columns(docs, ["v"], [common.field("held", common.LONG), common.field("twice", common.LONG)], run, ["id"]).collect()
    assert [(r.id, r.twice) for r in rows] == [(i, 2 * i) for i in range(3000)]
    assert max(r.held for r in rows) <= 512


def test_other_maps_drop_the_piece_cache(spark):
    from smoglake.llm import common, tokens

    path = packing.tokenizer_path()

    def fill(values):
        tokens.encoder(path).encode(["some words"])
        return [[1] * len(values)]

    def look(values):
        return [[tokens.encoder.cache_info().currsize] * len(values)]

    one, kind = spark.range(0, 40, 1, 1), [common.field("n", common.LONG)]
    for _ in range(3):
        assert common.map_columns(one, ["id"], kind, fill, [], tokens=True).distinct().count() == 1
        assert [r.n for r in common.map_columns(one, ["id"], kind, look, []).distinct().collect()] == [0]


def test_few_ranked_rows_make_few_files(spark):
    import os

    from pyspark.sql import functions as F
    from smoglake.llm import common

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = spark.range(0, 3000, 1, 4).select("id", (F.col("id") * 7919 % 3001).alias("v"))
        made = common.ranked(rows, ["v"], "rank", "test-ranks")
        assert [r["rank"] for r in made.orderBy("v").collect()] == list(range(3000))
        assert len([x for x in made.inputFiles() if os.path.basename(x).startswith("part-")]) < 64
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ids_of_rows_that_are_not_cut_are_not_shuffled(spark, awkward, awkward_rows, monkeypatch):
    docs = [(r[0], r[1]) for r in awkward_rows]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = packing.pack(awkward)
        assert "SortMergeJoin" not in made._jdf.queryExecution().executedPlan().toString()
        check(made.collect(), docs)
        monkeypatch.setattr(packing, "BROADCAST_CROSSING", 0)  # too many to broadcast: the same pieces by a shuffle
        many = packing.pack(awkward)
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, many.collect())) == sorted(map(str, made.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_long_texts_reach_the_encoder_in_small_batches(spark, awkward, monkeypatch):
    import pyarrow as pa
    from pyspark.sql import functions as F
    from smoglake.llm import common

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    seen, write = [], packing.staged

    def watched(df, name):
        texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
        seen.append(texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0])
        return write(df, name)

    monkeypatch.setattr(packing, "staged", watched)
    packing.tokenized(awkward, packing.tokenizer_path())
    assert len(seen) == 1 and seen[0] <= 2 * common.BATCH_BYTES
    assert spark.conf.get(common.BATCH_LIMIT, None) is None
