from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from smoglake import catalog, jobs
from smoglake.config import AIR_QUALITY
from smoglake.operators import cleaning as C
from smoglake.operators import increment as I
from smoglake.plans import charts
from smoglake.sources import versions

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_loads_in_parts_equal_one(spark, tmp_dir):
    raw = catalog.raw(spark, SF)
    want = _rows(C.clean_and_transform(raw, id_col=I.ID).select(*C.processed_columns(), I.ID))
    for part in (raw.filter("T < 5"), raw.limit(0), raw.filter("T >= 3"), raw.filter("T < 5")):
        I.load(part, tmp_dir, buckets=4)
    assert _rows(I.read_processed(spark, tmp_dir).select(*C.processed_columns(), I.ID)) == want


def test_without_a_declared_scale(spark, tmp_dir):
    cfg, raw = replace(AIR_QUALITY, scale=None), catalog.raw(spark, SF)
    for part in (raw.filter("T < 5"), raw.filter("T >= 3")):
        I.load(part, tmp_dir, cfg, buckets=4)
    assert _rows(I.read_processed(spark, tmp_dir, cfg).select(*C.processed_columns())) == \
        _rows(C.clean_and_transform(raw, cfg).select(*C.processed_columns()))


def test_stored_rows_are_not_exchanged(spark, tmp_dir):
    raw = catalog.raw(spark, SF)
    I.load(raw.filter("T < 5"), tmp_dir, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        schema = I._row_schema(versions.latest(spark, tmp_dir).about["schema"])
        with I._bucketed(spark, tmp_dir, schema, 4) as name:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            own = C.project_and_rename(raw, AIR_QUALITY, I.ID)
            plan = I.unseen(own, spark.table(name))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    stored = plan[plan.rindex("Sort ["):]  # the join's second side
    assert "Exchange" not in stored and "Bucketed: true" in stored and "ReadSchema: struct<record_id:binary>" in stored
    assert plan.count("Exchange") == 2 and "hashpartitioning(record_id" in plan  # the distinct, and the rows into the store's buckets


def test_load_that_breaks_off_changes_nothing(spark, tmp_dir, monkeypatch):
    raw = catalog.raw(spark, SF)
    I.load(raw.filter("T < 5"), tmp_dir, buckets=4)
    before = _rows(I.read_processed(spark, tmp_dir))
    real = versions.publish
    monkeypatch.setattr(versions, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        I.load(raw, tmp_dir)
    monkeypatch.setattr(versions, "publish", real)
    assert _rows(I.read_processed(spark, tmp_dir)) == before
    I.load(raw, tmp_dir)
    assert _rows(I.read_processed(spark, tmp_dir).drop(I.ID)) == _rows(C.clean_and_transform(raw).select(
        *I.read_processed(spark, tmp_dir).drop(I.ID).columns))
    with pytest.raises(ValueError, match="other columns"):
        I.load(raw.withColumn("COGT", F.col("COGT").cast("string")), tmp_dir)


def test_job_reads_new_files_only(spark, tmp_dir):
    raw = catalog.raw(spark, SF)
    raw.filter("T < 5").write.parquet(f"{tmp_dir}/raw")
    run = lambda: jobs.process_increment(spark, f"{tmp_dir}/raw", f"{tmp_dir}/store", f"{tmp_dir}/ck")
    run()
    raw.filter("T >= 3").write.mode("append").parquet(f"{tmp_dir}/raw")
    out = run()
    assert _rows(out.select(*C.processed_columns())) == _rows(C.clean_and_transform(raw).select(*C.processed_columns()))
    n = versions.latest(spark, f"{tmp_dir}/store").number
    run()  # nothing new: no load
    assert versions.latest(spark, f"{tmp_dir}/store").number == n


def test_charts_replace_their_own_parts_and_prune(spark, tmp_dir):
    path = f"{tmp_dir}/charts"
    charts.write_charts(spark.createDataFrame([("CO", "00:00", 1.0), ("7", "00:00", 2.0)], "Pollutant string, HourOfDay string, v double"), path)
    charts.write_charts(spark.createDataFrame([("CO", "01:00", 3.0)], "Pollutant string, HourOfDay string, v double"), path)
    assert _rows(charts.read_chart(spark, path)) == [("00:00", 2.0, "7"), ("01:00", 3.0, "CO")]
    one = charts.read_chart(spark, path, "7")
    assert _rows(one) == [("00:00", 2.0)]
    assert "PartitionFilters: [isnotnull(Pollutant" in one._jdf.queryExecution().executedPlan().toString()
