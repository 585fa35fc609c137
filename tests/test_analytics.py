import datetime as dt

from pyspark.sql import functions as F

from smoglake.functions.labels import hour_label, month_name, weekday_name, weekday_order
from smoglake.operators.reshape import (collect_unwind_normalize, min_max_normalize, normalize_by_join,
                                       pivot_matrix)
from smoglake.plans import analytics, documents


def _processed(spark, rows):
    """rows: (hour, day_of_week, co) -> processed-shaped frame."""
    data = [(co, 1.0, 2.0, 3.0, 4.0, dt.datetime(2024, 1, 7, h) if h is not None else None,
             2024 if h is not None else None, 1 if h is not None else None, 7 if h is not None else None,
             dw, h) for h, dw, co in rows]
    return spark.createDataFrame(
        data, "carbon_monoxide double, non_methane_hydrocarbon double, benzene double, "
              "nitrogen_oxides double, nitrogen_dioxide double, event_timestamp timestamp, year int, "
              "month int, day int, day_of_week int, hour_of_day int")


def test_labels(spark):
    df = spark.createDataFrame([(None,), (1,), (7,), (13,)], "c int")
    out = df.select(hour_label(F.col("c")).alias("h"), weekday_name(F.col("c")).alias("w"),
                    weekday_name(F.col("c"), legacy=True).alias("lw"), month_name(F.col("c")).alias("m")).collect()
    assert out[0].h is None and out[0].w is None
    assert out[1].h == "01:00" and out[1].w == "Sunday" and out[1].lw == "Monday" and out[1].m == "January"
    assert out[2].w == "Saturday" and out[2].lw == "Sunday"
    assert out[3].h == "13:00" and out[3].w is None
    order = spark.createDataFrame([("Monday",), ("Sunday",), ("x",)], "n string").select(
        weekday_order(F.col("n")).alias("o")).collect()
    assert [r.o for r in order] == [1, 7, 0]


def test_top5_tie_break_and_null_hour(spark):
    rows = [(h, 1, float(10 if h in (3, 1) else h % 5)) for h in range(24)] + [(None, None, 99.0)]
    top = analytics.hourly_top(documents.nest(_processed(spark, rows)), 5).collect()
    assert top[0].hour_of_day is None  # the null hour group has the highest average, label stays null
    assert [r.hour_of_day for r in top[1:3]] == ["01:00", "03:00"]  # tie -> smaller hour first
    long = analytics.hourly_top_long(analytics.hourly_top(documents.nest(_processed(spark, rows)), 5))
    assert long.columns == ["Hour of Day", "Metric", "Level"] and long.count() == 10


def test_daily_profile_null_day(spark):
    rows = [(1, 1, 2.0), (2, 1, 4.0), (3, 7, 1.0), (None, None, 5.0)]
    out = analytics.daily_profile(documents.nest(_processed(spark, rows))).collect()
    assert [r.Day for r in out] == [None, 1, 7]
    assert out[0].day_name is None and out[1].day_name == "Sunday" and out[1].avg_carbon_monoxide == 3.0


def test_zero_range_normalises_to_null(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 1.0), ("b", "x", 1.0), ("b", "y", 3.0)],
                               "g string, m string, v double")
    w = {(r.g, r.m): r.n for r in min_max_normalize(df, ["g"], "v", "n").collect()}
    c = {(r.g, r.m): r.n for r in collect_unwind_normalize(df, "g", "m", "v", "n").collect()}
    j = {(r.g, r.m): r.n for r in normalize_by_join(df, ["g"], "v", "n").collect()}
    assert w == c == j
    assert w[("a", "x")] is None and w[("b", "x")] == 0.0 and w[("b", "y")] == 1.0


def test_pivot_rejects_duplicates(spark):
    import pytest
    df = spark.createDataFrame([("a", "00:00", 1.0), ("a", "00:00", 2.0)], "p string, h string, v double")
    with pytest.raises(Exception, match="duplicate"):
        pivot_matrix(df, "p", "h", "v", ["00:00"]).collect()
    ok = pivot_matrix(df.limit(1), "p", "h", "v", ["00:00", "01:00"]).collect()
    assert ok[0]["00:00"] == 1.0 and ok[0]["01:00"] is None


def test_documents_roundtrip(spark, tmp_dir):
    p = _processed(spark, [(1, 1, 2.0), (None, None, 5.0)])
    documents.write_documents(documents.nest(p), tmp_dir)
    back = documents.flatten(documents.read_documents(spark, tmp_dir))
    assert sorted(back.collect(), key=str) == sorted(p.collect(), key=str)
    import glob
    text = "".join(open(f).read() for f in glob.glob(tmp_dir + "/*/*.json"))
    assert '"time_features":{}' in text  # all-null struct becomes {} (null fields omitted)


def test_empty_load_keeps_previous_documents(spark, tmp_dir):
    p = _processed(spark, [(1, 1, 2.0)])
    assert documents.write_documents(documents.nest(p), tmp_dir)
    assert not documents.write_documents(documents.nest(p.limit(0)), tmp_dir)
    assert documents.read_documents(spark, tmp_dir).count() == 1
    assert documents.write_documents(documents.nest(p.limit(0)), tmp_dir, replace_with_empty=True)
    assert documents.read_documents(spark, tmp_dir).count() == 0


def test_stack_expr_equals_to_long(spark):
    from smoglake.operators.reshape import stack_expr, to_long
    df = spark.createDataFrame([(1, 2.0, None), (2, 3.0, 4.0)], "k int, a double, b double")
    cols = {"A": "a", "B": "b"}
    via_sql = df.selectExpr("k", stack_expr(cols))
    via_api = to_long(df, ["k"], cols)
    key = lambda r: (r.k, r.pollutant)
    assert sorted(via_sql.collect(), key=key) == sorted(via_api.collect(), key=key)


def test_read_table_scans_parquet(spark, tmp_dir):
    from smoglake.sources.tables import read_table, write_table
    df = spark.range(5).withColumnRenamed("id", "x")
    back = write_table(df, f"{tmp_dir}/t")
    assert sorted(r.x for r in read_table(spark, f"{tmp_dir}/t").collect()) == list(range(5))
    assert back.count() == 5
