import zlib

from pyspark.sql import functions as F

from smoglake.llm import language
from smoglake.llm.catalog import QUERIES

EN = ["the house and the garden", "we went there and saw the old house", "the garden is green and the door is open"] * 4
DE = ["das haus und der garten", "wir gingen dort hin und sahen das alte haus", "der garten ist und die tür ist offen"] * 4


def model():
    from collections import Counter
    rows = [("en", t) for t in EN] + [("de", t) for t in DE]
    words, grams = Counter(), Counter()
    for lang, t in rows:
        for w in language.letter_words(t):
            words[lang, w] += 1
            grams.update((lang, g) for g in language.grams(w))
    return language.Model(["de", "en"], sorted((a, b, n) for (a, b), n in words.items()),
                          sorted((a, b, n) for (a, b), n in grams.items()), {"de": 12, "en": 12})


def test_known_words_and_backoff():
    m = model()
    assert m.predict("the old garden")[0] == "en" and m.predict("der alte garten")[0] == "de"
    assert "gingenhaus" not in m.words and m.predict("gingenhaus")[0] == "de"  # unseen: n-grams decide
    assert m.predict("thedoor")[0] == "en"
    lang, score = m.predict("the house")
    assert lang == "en" and 0.5 < score <= 1.0


def test_texts_without_letters():
    m = model()
    for text in (None, "", " \n", "123 456 !?", "²", "_"):
        assert m.predict(text) == ("und", 0.0)
    assert m.predict("x²")[0] != "und"


def test_grams_have_marked_edges():
    assert language.grams("ab", 2) == ["^", "a", "b", "$", "^a", "ab", "b$"]


def test_query_is_right_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(out) == len(docs)
    held = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(out[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in docs)
    assert sum(out[r.doc_id].lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_awkward_rows(awkward, no_docs, clashing):
    assert language.identify(no_docs).count() == 0
    for docs in (awkward, clashing):
        out = language.identify(docs).collect()
        assert len(out) == docs.count()
        assert {r.lang_pred for r in out if r.doc_id in (3, 4, 5)} == {"und"}
    unlabelled = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert language.identify(unlabelled).filter("lang_pred <> 'und'").count() == 0  # nothing to learn from
