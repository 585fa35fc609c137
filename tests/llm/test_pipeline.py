from collections import Counter

import corpus_pipeline as pipeline
import pytest
from test_packing import check

from smoglake.llm import mixing, near_dedup, quality, secrets

SF = "/root/testdata/sf0.001"


def test_entry_registers_the_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {f"op{i}_" for i in range(1, 11)} <= {n[:n.index("_") + 1] for n in names if n.startswith("op")}
    assert all(k in names for k in entry.oracle_sql())


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.staged(stage(spark, docs, SF), "test-stage")
        out[name] = docs
    return out


def test_stages_against_brute_force(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    rows = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r.doc_id: r for r in stages["quality rules"].collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, r in rows.items():
        n, _, _, _, repeats, _ = quality.text_counts(r.text)
        if n < 50 or 100 * repeats > 50 * n:
            assert i not in good
        elif i in labels:
            assert (i in good) == bool(labels[i])
    codes = {i: near_dedup.text_shingles(r.text) for i, r in good.items()}
    parent = {i: i for i in good}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sorted(good):
        for b in sorted(good):
            if b < a and near_dedup.linked(codes[a], codes[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    single = stages["near dedup"].collect()
    assert sorted(r.doc_id for r in single) == sorted(i for i in good if root(i) == i)
    clean = {r.doc_id: r for r in stages["secret scans"].collect()}
    assert len(clean) == len(single)
    for r in single:
        assert clean[r.doc_id].text == secrets.redacted(r.text) and clean[r.doc_id].n_chars == len(clean[r.doc_id].text)
    mix = stages["source mix"].collect()
    table, p = mixing.mix(stages["secret scans"])
    assert Counter(r.doc_id for r in mix) == Counter({r.doc_id: r[p + "times"] for r in table.collect() if r[p + "times"]})
    for name in ("quality rules", "near dedup", "secret scans", "source mix"):
        assert stages[name].columns == columns
    pieces = stages["packing"].collect()
    assert check(pieces, [(r.doc_id, r.text) for r in mix]) <= 0.02 * sum(r.length for r in pieces)


def test_awkward_rows_pass_all_stages(spark, awkward, no_docs):
    for docs in (awkward, no_docs):
        for _, stage in pipeline.STAGES:
            docs = pipeline.staged(stage(spark, docs, SF), "test-stage")
        docs.count()
