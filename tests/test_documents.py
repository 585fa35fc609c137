import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from smoglake.plans import documents as D
from smoglake.sources import versions


def test_instants_and_wall_clock_values_keep_their_microseconds(spark, tmp_dir):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for i, session in enumerate(("UTC", "America/New_York", "Asia/Kolkata")):
            spark.conf.set("spark.sql.session.timeZone", session)
            rows = spark.createDataFrame([(1,)], "k int").select(
                "k", F.timestamp_micros(F.lit(1_699_163_999_123_456)).alias("instant"),
                F.lit("2023-11-05 01:30:00.000001").cast("timestamp_ntz").alias("wall"),
                F.array(F.lit("0001-01-01 00:00:00.5").cast("timestamp_ntz")).alias("many"))
            D.write_documents(rows, f"{tmp_dir}/{i}")
            back = D.read_documents(spark, f"{tmp_dir}/{i}")
            assert back.dtypes == rows.dtypes
            assert back.exceptAll(rows).count() == rows.exceptAll(back).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nest_of_an_instant_is_its_wall_clock_value(spark, tmp_dir):
    p = spark.createDataFrame([(dt.datetime(2024, 1, 7, 1, 0, 0, 123456),)], "event_timestamp timestamp")
    cols = ["carbon_monoxide", "benzene", "nitrogen_oxides", "nitrogen_dioxide", "non_methane_hydrocarbon"]
    p = p.withColumns({c: F.lit(1.0) for c in cols}).withColumns(
        {c: F.lit(1) for c in ("year", "month", "day", "day_of_week", "hour_of_day")})
    D.write_documents(D.nest(p), tmp_dir)
    assert D.read_documents(spark, tmp_dir).first().event_timestamp == dt.datetime(2024, 1, 7, 1, 0, 0, 123456)


def test_value_that_does_not_fit_raises_and_keeps_the_old_load(spark, tmp_dir):
    good = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS t, array(named_struct('d', DATE'2024-01-01')) AS a")
    D.write_documents(good, tmp_dir)
    for bad in ("SELECT TIMESTAMP_NTZ'+12024-01-01 00:00:00' AS t, array(named_struct('d', DATE'2024-01-01')) AS a",
                "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS t, array(named_struct('d', DATE'+12024-01-01')) AS a"):
        with pytest.raises(Exception, match="does not fit"):
            D.write_documents(spark.sql(bad), tmp_dir)
        assert D.read_documents(spark, tmp_dir).collect() == good.collect()
    with pytest.raises(TypeError):
        D.write_documents(spark.sql("SELECT map(1, 2) AS m"), tmp_dir)


def test_text_that_does_not_restore_its_type_raises(spark, tmp_dir):
    text = {"event_timestamp": "2024-01-07T01:00:00.000Z", "pollutants": {"benzene": 1.0}, "time_features": {}}
    with open(f"{tmp_dir}/x.json", "w") as f:
        f.write(json.dumps(text) + "\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        D.read_documents(spark, tmp_dir).collect()
    with open(f"{tmp_dir}/x.json", "w") as f:
        f.write(json.dumps({**text, "event_timestamp": "2024-01-07T01:00:00.000001"}) + "\n")
    assert D.read_documents(spark, tmp_dir).first().event_timestamp == dt.datetime(2024, 1, 7, 1, 0, 0, 1)


def test_failed_load_changes_nothing(spark, tmp_dir, monkeypatch):
    one, two = (spark.createDataFrame([(i,)], "x int") for i in (1, 2))
    D.write_documents(one, tmp_dir)
    real = versions.publish
    monkeypatch.setattr(D.versions, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        D.write_documents(two, tmp_dir)
    monkeypatch.setattr(D.versions, "publish", real)
    assert [r.x for r in D.read_documents(spark, tmp_dir).collect()] == [1]
    D.write_documents(two, tmp_dir)
    assert [r.x for r in D.read_documents(spark, tmp_dir).collect()] == [2]


def test_content_ids_tell_times_inside_structs_apart(spark):
    from smoglake.operators.keys import content_id

    df = spark.sql("""SELECT named_struct('t', timestamp_micros(u)) AS s, d FROM VALUES (1, 0.0D), (2, -0.0D), (2, 0.0D) AS x(u, d)""")
    ids = [bytes(r[0]) for r in df.select(content_id(df, ["s", "d"])).collect()]
    assert ids[0] != ids[1] == ids[2]
