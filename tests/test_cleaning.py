import datetime as dt
import math

from pyspark.sql import functions as F

from smoglake.config import AIR_QUALITY
from smoglake.operators import cleaning as C
from smoglake.sources.json_codec import raw_schema

NAN = float("nan")


def _raw(spark, rows):
    """rows: (Date, Time, CO, NMHC, C6H6, NOx, NO2, aux) -> 15-column raw frame."""
    full = [(d, t, co, aux, nmhc, c6, aux, nox, aux, no2, aux, aux, aux, aux, aux)
            for d, t, co, nmhc, c6, nox, no2, aux in rows]
    return spark.createDataFrame(full, raw_schema())


def test_sentinel_null_nan(spark):
    df = spark.createDataFrame([(-200.0,), (None,), (NAN,), (3.0,)], "x double")
    out = [r.x for r in C.sentinel_to_null(df, ["x"], -200.0).collect()]
    assert out[0] is None and out[1] is None and math.isnan(out[2]) and out[3] == 3.0


def test_impute_mean_nan_and_all_missing(spark):
    df = spark.createDataFrame([(1.0, None), (NAN, None), (None, None), (3.0, None)], "a double, b double")
    out = C.impute_mean(df, ["a", "b"]).collect()
    assert [r.a for r in out] == [1.0, 2.0, 2.0, 3.0]  # NaN is missing, mean over 1 and 3
    assert [r.b for r in out] == [0.0] * 4  # all-null column -> 0.0


def test_dedup_before_projection(spark):
    rows = [("10/03/2004", "18.00.00", 1.0, 2.0, 3.0, 4.0, 5.0, 9.0),
            ("10/03/2004", "18.00.00", 1.0, 2.0, 3.0, 4.0, 5.0, 9.0),   # exact duplicate
            ("10/03/2004", "18.00.00", 1.0, 2.0, 3.0, 4.0, 5.0, 8.0)]   # differs in dropped column
    out = C.project_and_rename(_raw(spark, rows))
    assert out.count() == 2
    assert out.columns == ["date", "time", "carbon_monoxide", "non_methane_hydrocarbon", "benzene",
                           "nitrogen_oxides", "nitrogen_dioxide"]


def test_timestamp_and_features(spark):
    rows = [("07/01/2024", "13.00.00", 1.0, 1.0, 1.0, 1.0, 1.0, 0.0),   # a Sunday
            (None, None, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0),
            ("10/03/2004", None, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0),
            ("31/02/2004", "10.00.00", 1.0, 1.0, 1.0, 1.0, 1.0, 0.0)]
    out = C.clean_and_transform(_raw(spark, rows)).orderBy(F.col("event_timestamp").asc_nulls_last()).collect()
    assert out[0]["event_timestamp"] == dt.datetime(2024, 1, 7, 13, 0)
    assert (out[0]["year"], out[0]["month"], out[0]["day"], out[0]["day_of_week"], out[0]["hour_of_day"]) == \
        (2024, 1, 7, 1, 13)
    for r in out[1:]:
        assert r["event_timestamp"] is None and r["hour_of_day"] is None and r["day_of_week"] is None


def test_processed_has_no_nulls_and_order(spark):
    rows = [("10/03/2004", "18.00.00", -200.0, 2.0, -200.0, None, 5.0, 0.0),
            ("10/03/2004", "19.00.00", 4.0, -200.0, -200.0, 6.0, NAN, 0.0)]
    out = C.clean_and_transform(_raw(spark, rows))
    assert out.columns == C.processed_columns(AIR_QUALITY)
    sensors = AIR_QUALITY.sensor_columns
    got = out.select(*sensors).collect()
    assert all(v is not None and not math.isnan(v) for r in got for v in r)
    byco = {r.carbon_monoxide for r in got}
    assert byco == {4.0}  # the sentinel row takes the mean of the one real value
    assert {r.benzene for r in got} == {0.0}  # all missing -> 0.0


def test_record_id_unique_after_distinct(spark):
    rows = [("10/03/2004", "18.00.00", 1.0, 2.0, 3.0, 4.0, 5.0, float(i % 3)) for i in range(9)]
    out = C.clean_and_transform(_raw(spark, rows), AIR_QUALITY, "record_id")
    assert out.count() == 3 and out.select("record_id").distinct().count() == 3


def test_lineitem_config_runs(spark):
    from smoglake.config import lineitem_config
    cfg = lineitem_config()
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(*cfg.raw_columns)
    out = C.clean_and_transform(li, cfg)
    assert set(cfg.sensor_columns) <= set(out.columns) and "event_timestamp" in out.columns
    assert out.filter(F.col("day_of_week").isNull()).count() == 0


def test_partitioned_overwrite_twice_equals_once(spark, tmp_dir):
    from smoglake import catalog
    from smoglake.sources.tables import write_overwrite
    p = catalog.processed(spark, "/root/testdata/sf0.001").filter("year is not null")
    path = f"{tmp_dir}/processed"
    write_overwrite(p, path, partition_by=["year", "month"])
    once = sorted(spark.read.parquet(path).collect(), key=str)
    write_overwrite(p, path, partition_by=["year", "month"])
    again = spark.read.parquet(path)
    assert sorted(again.collect(), key=str) == once
    plan = again.filter("month = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_distinct_nan_and_signed_zero(spark):
    df = spark.createDataFrame([(NAN, 0.0), (NAN, -0.0), (None, 1.0), (None, 1.0)], "a double, b double")
    assert C.drop_duplicates(df).count() == 2


def test_staged_cleaning_equals_single_plan(spark, tmp_dir):
    from smoglake import catalog
    raw = catalog.raw(spark, "/root/testdata/sf0.001")
    inline = catalog.round_doubles(C.clean_and_transform(raw, AIR_QUALITY, "record_id"))
    staged = C.clean_and_transform(raw, AIR_QUALITY, "record_id", staging_path=f"{tmp_dir}/dedup")
    assert sorted(catalog.round_doubles(staged).collect(), key=str) == sorted(inline.collect(), key=str)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(PT08S3NOx" not in plan  # the distinct is not re-run
