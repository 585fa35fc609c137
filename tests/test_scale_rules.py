"""Nothing is lost or altered silently, and staged data goes to shared folders only."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from smoglake import session
from smoglake.config import lineitem_config
from smoglake.functions.numbers import exact_mean, round_half_up
from smoglake.operators import cleaning as C
from smoglake.operators.keys import content_id
from smoglake.operators.merge import merge_on_create, null_keys
from smoglake.operators.reshape import pivot_matrix


def test_rounding_leaves_large_values_alone(spark):
    values = [600000.0, 1e6, 12345678.25, 1e9, 0.0499185, 2.5e-7]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(round_half_up(F.col("v")).alias("v"))
    assert [r.v for r in df.collect()] == [600000.0, 1e6, 12345678.25, 1e9, 0.049919, 0.0]


def test_exact_mean_ignores_order_and_refuses_what_does_not_fit(spark):
    df = spark.range(3000).select((F.col("id") * 0.01 + 1e6).alias("v"))
    means = {df.repartition(n).agg(exact_mean(F.col("v"), 2).alias("m")).first().m for n in (1, 3, 7)}
    assert len(means) == 1 and abs(means.pop() - 1000014.995) < 1e-9
    with pytest.raises(PySparkException):
        spark.createDataFrame([(0.123,)], "v double").agg(exact_mean(F.col("v"), 2)).collect()


def test_merge_takes_new_properties_and_no_null_keys(spark):
    old = spark.createDataFrame([(1, "a")], "k int, name string")
    new = spark.createDataFrame([(1, "b", "m"), (2, "c", "s"), (None, "d", "x")], "k int, name string, unit string")
    out = {r.k: (r.name, r.unit) for r in merge_on_create(old, new, ["k"]).collect()}
    assert out == {1: ("a", None), 2: ("c", "s")}
    assert null_keys(new, ["k"]).first().null_keys == 1


def test_line_items_that_differ_in_one_column_both_stay(spark):
    row = (1, 5, 5, 1, 2.0, 3.0, 0.1, 0.2, "R", "F", dt.datetime(1995, 1, 1))
    schema = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
              "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    li = spark.createDataFrame([row, (2, *row[1:]), row], schema)
    assert C.clean_and_transform(li, lineitem_config()).count() == 2


def test_ids_tell_microseconds_nulls_and_neighbours_apart(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    df = spark.createDataFrame([("a", "b", t), ("a", "b", t.replace(microsecond=2)), ("ab", "", t), ("ab", None, t), ("n", "b", None)],
                               "x string, y string, t timestamp")
    ids = df.select(content_id(df, df.columns).alias("i"))
    assert ids.distinct().count() == 5 and {len(r.i) for r in ids.collect()} == {32}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Rome", "America/New_York"])
def test_readings_keep_their_wall_clock_in_every_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("31/03/2024", "02.30.00"), ("10/03/2024", "02.15.00"), (None, "01.00.00"), ("x", "y")], "d string, t string")
        out = df.select(C.event_time(F.col("d"), F.col("t"), "dd/MM/yyyy HH.mm.ss").alias("e")).withColumn("h", F.hour("e"))
        assert out.schema["e"].dataType.typeName() == "timestamp_ntz"
        assert [(str(r.e), r.h) for r in out.collect()] == [("2024-03-31 02:30:00", 2), ("2024-03-10 02:15:00", 2), ("None", None), ("None", None)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_pivot_refuses_values_without_a_column(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "z", 2.0)], "i string, c string, v double")
    with pytest.raises(PySparkException):
        pivot_matrix(df, "i", "c", "v", ["x"]).collect()


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
