import zlib

from smoglake.llm import toxicity
from smoglake.llm.catalog import QUERIES


def test_entries_and_lexicon_weights():
    assert toxicity.entries("clown") == ["clown", "clo*", "clow*"]
    lexicon = {"clow*": 2.0, "clown": 3.0, "idiot": 1.0}
    heads = frozenset(e[:2] for e in lexicon)
    assert toxicity.lexicon_weights(["clown", "clowns", "fine", "idiot"], lexicon, heads) == {0: 3.0, 1: 2.0, 3: 1.0}


def test_features():
    lexicon = {"idiot": 2.0}
    got = dict(zip(toxicity.FEATURES, toxicity.features("You IDIOT! you id1ot", lexicon, frozenset(["id"])), strict=True))
    assert got["lexicon_hits"] == 1 and got["hits_near_person"] > 0 and got["shout_rate"] > 0
    assert got["swapped_hits"] > 0 and got["exclamation_rate"] > 0
    assert toxicity.features(None, lexicon, frozenset(["id"])) == [0.0] * len(toxicity.FEATURES)
    assert toxicity.features("", {}, frozenset()) == [0.0] * len(toxicity.FEATURES)


def test_query_finds_held_out_toxic_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, sf).collect()}
    assert len(out) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if out[r.doc_id].held_out]
    right = sum(out[r.doc_id].predicted == r.toxic for r in labels)
    assert right >= 0.9 * len(labels)


def test_awkward_rows(spark, awkward, no_docs, clashing):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (9, 0), (None, 1), (77, 1)], "doc_id long, toxic int")
    assert toxicity.score(no_docs, labels).count() == 0
    for docs in (awkward, clashing):
        out = toxicity.score(docs, labels).collect()
        assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    none = toxicity.score(awkward, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
