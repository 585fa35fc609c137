"""Skew: a third of all rows are copies of one row (derived from the driver's
events table). The distinct's map-side partial aggregate must collapse the hot
group before the shuffle, which the executed plan's runtime statistics show."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from smoglake.operators.cleaning import clean_and_transform, drop_duplicates
from smoglake.sources.sensor_fixture import raw_sensor

SF = "/root/testdata/sf0.01"


def _hot_events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = F.col("event_id") % 3 == 0
    return ev.select(
        F.when(hot, F.lit(1)).otherwise(F.col("event_id")).cast("long").alias("event_id"),
        F.when(hot, F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("ts"),
        F.when(hot, F.lit(7)).otherwise(F.col("user_id")).cast("long").alias("user_id"),
        F.col("event_type"),
        F.when(hot, F.lit(12.5)).otherwise(F.col("value")).alias("value"),
        F.col("props"))


def _shuffle_rows(df) -> list[float]:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    final = buf.getvalue().split("== Initial Plan ==")[0]
    return [float(x) for x in re.findall(r"ShuffleQueryStage \(\d+\), Statistics\(sizeInBytes=[^,]+, rowCount=([0-9.E+]+)\)", final)]


def test_hot_duplicate_group_is_combined_before_the_shuffle(spark):
    raw = raw_sensor(_hot_events(spark))
    total = raw.count()
    hot_rows = raw.filter("Date = '02/01/2024' AND Time = '03.04.05'").count()
    assert hot_rows * 3 >= total * 0.9  # about a third of all rows are one row
    distinct = drop_duplicates(raw)
    n_distinct = distinct.count()
    shuffled = _shuffle_rows(drop_duplicates(raw))
    assert shuffled, "no shuffle statistics found"
    # Without map-side combining the shuffle would carry every input row. With
    # it, the hot group ships at most one row per map task (copies that sit in
    # different tasks, like the fixture's injected duplicates, still ship once
    # per task, so the bound is on the hot group, not on the distinct count).
    map_tasks = 16
    assert n_distinct <= shuffled[0] <= total - hot_rows + map_tasks


def test_hot_group_cleans_correctly(spark):
    p = clean_and_transform(raw_sensor(_hot_events(spark)))
    hot = p.filter("year = 2024 AND month = 1 AND day = 2 AND hour_of_day = 3 AND carbon_monoxide = 12.5")
    assert hot.count() == 1  # the copies collapse to one processed row
    assert p.filter("carbon_monoxide IS NULL OR benzene IS NULL").count() == 0


def test_single_hot_aggregate_key_ships_one_row_per_task(spark):
    """lineitem ship dates carry no time of day: every reading falls into one
    hour key. The profile's aggregate shuffle carries a handful of partial
    rows per map task, not the 4 readings per input row."""
    from smoglake import catalog
    df = catalog.lineitem_hourly_norm(spark, "/root/testdata/sf0.01")
    rows = _shuffle_rows(df)
    assert df.count() == 4
    lineitem_rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert min(rows) <= 4 * 16 < lineitem_rows  # 4 (pollutant, hour) keys x at most 16 map tasks
