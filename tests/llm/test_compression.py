import zlib

import pytest
import zstandard
from llm_texts import words

from smoglake.llm import compression as C
from smoglake.llm.catalog import QUERIES


def plain_size(text, dictionary):
    """Frame sizes by the library alone, block by block."""
    c = zstandard.ZstdCompressor(level=C.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False,
                                 write_dict_id=False)
    whole = text.encode()
    return sum(len(c.compress(whole[i:i + C.BLOCK])) for i in range(0, len(whole), C.BLOCK))


def test_whole_texts_are_compressed():
    good, bad = (C.build_dictionary([" ".join(words(400, s)).encode() for s in range(k, k + 200)]) for k in (0, 500))
    text = " ".join(words(400, 3)) + " " + " ".join(words(400, 4))
    assert len(C.blocks(text)) > 1 and b"".join(C.blocks(text)) == text.encode() and C.blocks(None) == C.blocks("") == []
    g, b = plain_size(text, good), plain_size(text, bad)
    got = C.size_difference(text, good, bad)
    assert abs(got - (b - g) / (b + g)) < 0.02 and got > 0.05
    assert C.size_difference(text, bad, good) == -got and C.size_difference("", good, bad) == C.size_difference(None, good, bad) == 0


def test_too_little_text_to_train_on():
    assert C.build_dictionary([]) == b"" and C.build_dictionary([b"some words"]) == b"some words"
    assert C.size_difference("some words and some more", b"", b"") == 0
    assert C.size_difference("some words are here", b"some words are here", b"") > 0


@pytest.fixture(scope="module")
def held(spark):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in QUERIES["op12_quality_classifier"](spark, sf).collect()}
    return out, [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if out[r.doc_id].held_out]


def test_held_out_accuracy(held):
    out, labels = held
    assert len(out) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    good = [out[r.doc_id].score for r in labels if r.quality == 1]
    bad = [out[r.doc_id].score for r in labels if r.quality == 0]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.97
    assert sum(s >= 0.3 for s in good) >= 0.98 * len(good) and sum(s < 0.3 for s in bad) >= 0.75 * len(bad)


def test_score_is_calibrated(held):
    out, labels = held
    scored = [(out[r.doc_id].score, r.quality) for r in labels]
    for low, high in ((0, 0.3), (0.3, 0.9), (0.9, 1.01)):
        part = [x for x in scored if low <= x[0] < high]
        if len(part) > 20:
            assert abs(sum(s for s, _ in part) - sum(q for _, q in part)) < 0.2 * len(part)


def test_awkward_rows(spark, awkward, no_docs, clashing):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (9, 0), (None, 1), (77, 1)], "doc_id long, quality int")
    assert C.score(no_docs, labels).count() == 0
    for docs in (awkward, clashing):
        out = C.score(docs, labels).collect()
        assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in C.score(awkward, labels.limit(0)).collect()} == {0.0}


def test_reruns_agree(spark):
    sf = "/root/testdata/sf0.001"
    once, again = (sorted(map(tuple, QUERIES["op12_quality_classifier"](spark, sf).collect())) for _ in range(2))
    assert once == again
