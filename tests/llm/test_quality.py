import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from smoglake.llm import quality
from smoglake.llm.catalog import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dups, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside), lines


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\t#|é\x1c\xa0 ", max_size=60))
def test_counts_match_brute_force(text):
    assert quality.text_counts(text) == brute(text)


def test_null_text():
    assert quality.text_counts(None) == (0, 0, 0, 0, 0, 0)


def test_chi_square_quantiles():
    assert abs(quality.chi_square_quantile(0.975, 4) - 11.1433) < 1e-3
    assert abs(quality.chi_square_cdf(11.1433, 4) - 0.975) < 1e-5


def test_mcd_ignores_a_third_of_outliers():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (2000, 4)), rng.normal(12, 0.5, (900, 4))
    x = np.vstack([good, bad])
    centre, scatter = quality.mcd(np.ones(len(x)), x, x[:, :, None] * x[:, None, :], np.full(4, 1e-3))
    assert np.abs(centre).max() < 0.15
    assert np.abs(np.diag(scatter) - 1).max() < 0.25


def test_query_keeps_good_and_rejects_marked_up_documents(spark):
    import sys
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op7_quality_rules"](spark, sf).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas().set_index("doc_id")
    want = docs.text.map(brute)
    for i, c in enumerate(["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]):
        assert (out[c] == want.map(lambda r, i=i: r[i])).all()
    failed = want.map(lambda r: r[0] < 50 or 100 * r[4] > 50 * r[0])
    assert (out.base_failed == failed).all() and not out.kept[failed].any()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").quality
    assert out.kept.loc[labels.index][(labels == 1) & ~failed.loc[labels.index]].all()
    assert not out.kept.loc[labels.index][labels == 0].any()
    assert sys.float_info.max > out.distance.max()


def test_awkward_rows(awkward, no_docs, clashing):
    assert quality.keep_good(no_docs).count() == 0
    judged, q = quality.judge(awkward)
    assert judged.count() == awkward.count()
    kept = quality.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} <= {1, 2, 7, 8}


def test_planted_repetition_is_rejected_beside_clean_documents(spark):
    from llm_texts import words

    def lines(count, seed, size=10):
        made = words(count * size, seed)
        return [" ".join(made[i * size:(i + 1) * size]) for i in range(count)]

    clean = ["\n".join(lines(20, seed)) for seed in range(300)]
    short = [x + "\n" + "\n".join(lines(1, 900 + i, 60)) + "\n" + x for i, x in enumerate(lines(5, 5, 4))]  # a third of the lines
    planted = ["\n".join(lines(12, 1000) + lines(1, 1001) * 8), "\n".join(lines(10, 1002) + lines(1, 1003, 8) * 10),
               "\n".join(f"menu\n{x}\nmenu" for x in lines(10, 1004))]
    shares = [(c[3] / c[5], c[4] / c[0]) for c in map(quality.text_counts, planted)]
    assert all(0.3 <= dup <= 0.65 and rep <= 0.5 for dup, rep in shares)
    texts = clean + short + planted
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == set(range(len(clean) + len(short)))
