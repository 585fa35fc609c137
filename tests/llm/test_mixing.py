import pytest
from pyspark.sql import functions as F

from smoglake.llm import mixing


def test_targets_share_everything_and_cap_at_three_times(spark):
    sizes = spark.createDataFrame([("0a", 100), ("0b", 900), ("0c", 10), ("0d", 50), ("1", 7)], "source string, size long")
    out = {r.source: r for r in mixing.source_targets(sizes).collect()}
    assert abs(sum(r.target for r in out.values()) - 1067) < 1e-6
    assert all(r.target <= 3 * r.source_size + 1e-9 for r in out.values())
    assert out["0a"].target == 300 and out["0c"].target == 30 and out["1"].target == 21
    assert out["0d"].target == 150  # weight 5 again


def test_taken_words_meet_their_targets_and_reruns_agree(spark):
    rows = [(i, " ".join(["w"] * (i % 37 + 1)), f"s{i % 5}" if i % 11 else None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out, p = mixing.mix(docs)
    table = out.toPandas()
    for _, part in table.groupby(p + "source"):
        assert abs(part[p + "taken"].sum() - part[p + "target"].iloc[0]) <= 37 / 2 + 1
        assert (part[p + "taken"] <= 3 * part[p + "size"]).all()
    again = mixing.mix(docs.repartition(7))[0].toPandas()
    assert table.set_index("doc_id")[p + "taken"].sort_index().equals(again.set_index("doc_id")[p + "taken"].sort_index())


def test_budgets_are_nested(spark):
    rows = spark.range(2000).select(F.lit("0a").alias("source"), F.lit(3).cast("long").alias("size"),
                                    mixing.document_hash("id").alias("hash"))
    targets = mixing.source_targets(rows, budgets=(0.2, 0.5, 0.9))
    cuts = [r.threshold for r in mixing.thresholds(rows, targets).orderBy("budget").collect()]
    assert cuts == sorted(cuts)
    for share, cut in zip((0.2, 0.5, 0.9), cuts, strict=True):
        assert abs(rows.filter(F.col("hash") < cut).count() * 3 - share * 6000) <= 2


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_against_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    want = con.sql(mixing.OP3_SQL).df().sort_values("doc_id").reset_index(drop=True)
    got = mixing.op3_source_mix(spark, f"/root/testdata/{sf}").toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got[want.columns].astype("float64").equals(want.astype("float64"))


def test_awkward_rows(awkward, no_docs, clashing):
    assert mixing.mixed(no_docs).count() == 0
    out = mixing.mixed(clashing)
    assert out.columns == clashing.columns
    rows, p = mixing.mix(awkward)
    table = rows.toPandas()
    assert len(table) == awkward.count() and table[p + "size"].notna().all()
    assert table[table.doc_id == 2][p + "taken"].nunique() == 1
