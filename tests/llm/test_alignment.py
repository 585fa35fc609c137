import hashlib
from collections import Counter

import public_tokenizers as public
import pytest
import sentencepiece
from llm_texts import words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from smoglake.llm import alignment as X
from smoglake.llm.tokens import _byte_letters

A_PATH, B_PATH = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
TEXTS = ["", None, "Hello, world!  Two blanks\nand a line\n  indented", "<|endoftext|> <s> </s> <unk> plain", "a▁b", "▁", " ", "  ", "\n", "x",
         "漢字 and ß, ﬁ 1.5%…\t\x00\x1f\x85　end", "foo1bar _x_ it's (a).b ²³", "é" * 50, "😀 ok 👍🏽 x", "a " * 400, "x y z\n\n\nw  \n ",
         "https://a.b/c?d=e&f_g=%20h", "!!wow!!Yes.No,maybe;so", "²., ².a ½b ªc"]


def brute(texts):
    """Every column by plain loops over the libraries' own ids."""
    a_model = Tokenizer.from_file(A_PATH)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = {c: i for i, c in enumerate(_byte_letters())}
    each = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in ((i, b_model.id_to_piece(i)) for i in b)]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            each.append(None)
            continue
        spans = []
        for made in (a_bytes, b_bytes):
            at, out = 0, []
            for x in made:
                out.append((at, at + len(x)))
                at += len(x)
            spans.append(out)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        for end in ends:
            groups.append(tuple(",".join(str(i) for i, (s, e) in zip(ids, sp) if s >= start and e <= end)
                                for ids, sp in ((a, spans[0]), (b, spans[1]))))
            start = end
        links = [(i, j) for i, (s, e) in zip(a, spans[0]) for j, (u, v) in zip(b, spans[1]) if s < v and u < e]
        each.append((len(a), len(b), len(groups), links, ";".join("|".join(g) for g in groups)))
    counts = Counter(x for e in each if e for x in e[3])
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(n, top.get(j, 0))
    return [(e[0], e[1], e[2], len(e[3]), sum(counts[x] == top[x[1]] for x in e[3]), sum(counts[x] for x in e[3]),
             hashlib.sha256(e[4].encode()).hexdigest()) if e else (0, 0, 0, 0, 0, 0, "") for e in each]


def result(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = X.with_corpus_counts(X.align(docs, A_PATH, B_PATH), **more).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups"))
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("frequent", [X.FREQUENT, 50, 1])
def test_against_brute_force(spark, frequent):
    texts = [*TEXTS, *TEXTS[2:5], " ".join(words(300, 4)), " ".join(words(300, 5)) + ".", "The cat. The cat, the Cat!"]
    want = sorted(((i, *w) for i, w in enumerate(brute(texts))), key=str)
    assert result(spark, list(enumerate(texts)), frequent=frequent) == want


def test_segments_and_small_batches_change_nothing(spark, monkeypatch):
    texts = [*TEXTS, " ".join(words(500, 6)) + "\n" + "  ".join(words(100, 7)), "a▁b " * 300]
    whole = X.Aligner(A_PATH, B_PATH).align(texts)
    monkeypatch.setattr(X, "SEGMENT", 40)
    monkeypatch.setattr(X, "BATCH", 100)
    monkeypatch.setattr(X, "CACHE_STRETCHES", 30)
    parts = X.Aligner(A_PATH, B_PATH).align(texts)
    for x, y in zip(whole, parts, strict=True):
        assert (x is None) == (y is None)
        if x:
            assert all(x[k] == y[k] for k in ("n_a", "n_b", "n_groups", "n_links", "groups"))
            counted = Counter()
            for k, n in zip(y["keys"].tolist(), y["counts"].tolist(), strict=True):
                counted[k] += n
            assert counted == dict(zip(x["keys"].tolist(), x["counts"].tolist(), strict=True))
    assert all("".join(X.segments(t)) == " " + t for t in texts if t)


def test_table_texts_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows if len(r.text) < 1500]
    assert len(rows) > 40 and result(spark, rows) == sorted(((i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows]), strict=True)), key=str)


def test_awkward_rows(spark, awkward, no_docs, clashing):
    assert X.with_corpus_counts(X.align(no_docs, A_PATH, B_PATH)).count() == 0
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    want = sorted(((i, *w) for (i, _), w in zip(rows, brute([t if t is None or len(t) < 5000 else None for _, t in rows]), strict=True)), key=str)
    short = [(i, t if t is None or len(t) < 5000 else None) for i, t in rows]
    assert result(spark, short) == want
    out = X.with_corpus_counts(X.align(clashing, A_PATH, B_PATH)).collect()
    assert len(out) == len(rows) and max(r.n_a for r in out) > 30_000


def test_query_columns(spark):
    from smoglake.llm.catalog import QUERIES

    out = QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001")
    assert out.dtypes == [*[(c, "bigint") for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
                          ("groups_sha256", "string")]
    assert out.count() == 200
