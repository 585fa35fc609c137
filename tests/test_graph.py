from pyspark.sql import functions as F

from smoglake import catalog
from smoglake.operators.keys import with_row_ids
from smoglake.operators.merge import merge_on_create
from smoglake.plans import graph

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(df.collect(), key=lambda r: tuple(str(v) for v in r))


def test_graph_form_equals_fact_form(spark, tmp_dir):
    p = catalog.processed(spark, SF, "record_id")
    g = graph.build(p, id_col="record_id")
    graph.write_graph(g, tmp_dir)
    stored = graph.read_graph(spark, tmp_dir)
    assert _rows(catalog.round_doubles(graph.hourly_profile(stored))) == \
        _rows(catalog.round_doubles(graph.hourly_profile_fact(p)))
    assert _rows(catalog.round_doubles(graph.weekday_profile(stored))) == \
        _rows(catalog.round_doubles(graph.weekday_profile_fact(p)))
    assert _rows(catalog.round_doubles(graph.hourly_profile_fact(p, method="collect"))) == \
        _rows(catalog.round_doubles(graph.hourly_profile_fact(p)))


def test_write_twice_equals_once(spark, tmp_dir):
    g = graph.build(catalog.processed(spark, SF, "record_id"), id_col="record_id")
    graph.write_graph(g, tmp_dir)
    first = _rows(graph.read_graph(spark, tmp_dir).readings)
    graph.write_graph(g, tmp_dir)
    assert _rows(graph.read_graph(spark, tmp_dir).readings) == first


def test_reading_ids_unique_and_deterministic(spark):
    p = catalog.processed(spark, SF, "record_id")
    r1 = graph.readings(p).select("row_id", "pollutant")
    assert r1.count() == r1.distinct().count() == 5 * p.filter("event_timestamp is not null").count()
    assert _rows(r1) == _rows(graph.readings(p).select("row_id", "pollutant"))
    # fallback ids when the processed frame carries none
    r2 = graph.readings(catalog.processed(spark, SF), id_col=None).select("row_id", "pollutant")
    assert r2.count() == r2.distinct().count() == r1.count()


def test_with_row_ids_splits_hot_duplicates(spark):
    df = spark.range(0, 2500).select((F.col("id") % 2).alias("k"))  # two contents, 1250 copies each
    out = with_row_ids(df, "rid", chunk_rows=100)
    assert out.count() == 2500 and out.select("rid").distinct().count() == 2500
    assert _rows(out.groupBy("k").count()) == _rows(df.groupBy("k").count())
    again = with_row_ids(df.repartition(7), "rid", chunk_rows=100)
    assert _rows(again.select("rid")) == _rows(out.select("rid"))


def test_key_check_and_types(spark):
    g = graph.build(catalog.processed(spark, SF, "record_id"), id_col="record_id")
    kc = {r.label: r.violations for r in graph.graph_key_check(g).collect()}
    assert set(kc) == set(graph.NODE_KEYS) and all(v == 0 for v in kc.values())
    units = {r.name: r.unit for r in g.nodes["PollutionType"].collect()}
    assert units == {"CO": "µg/m³", "NMHC": "µg/m³", "Benzene": "µg/m³", "NOx": "ppm", "NO2": "µg/m³"}


def test_null_timestamp_rows_make_no_nodes(spark):
    p = catalog.processed(spark, SF, "record_id")
    assert p.filter("event_timestamp is null").count() > 0
    g = graph.build(p, id_col="record_id")
    assert g.nodes["HourOfDay"].filter("hour is null").count() == 0
    assert g.readings.filter("hour is null").count() == 0


def test_merge_on_create_twice_keeps_first(spark):
    existing = spark.createDataFrame([(1, "first")], "k int, name string")
    incoming = spark.createDataFrame([(1, "second"), (2, "b2"), (2, "a2")], "k int, name string")
    once = merge_on_create(existing, incoming, ["k"])
    twice = merge_on_create(once, incoming, ["k"])
    assert _rows(once) == _rows(twice)
    assert {r.k: r.name for r in once.collect()} == {1: "first", 2: "a2"}
    ordered = spark.createDataFrame([(2, "late", 5), (2, "early", 1)], "k int, name string, seq int")
    got = merge_on_create(existing, ordered, ["k"], order_col="seq")
    assert {r.k: r.name for r in got.collect()} == {1: "first", 2: "early"}


def test_each_normalised_profile_spans_zero_to_one(spark):
    p = catalog.processed(spark, SF)
    for prof in (graph.hourly_profile_fact(p), graph.weekday_profile_fact(p)):
        spans = prof.groupBy("Pollutant").agg(F.min("NormalizedValue").alias("lo"),
                                              F.max("NormalizedValue").alias("hi")).collect()
        assert len(spans) == 5 and all(r.lo == 0.0 and r.hi == 1.0 for r in spans)


def test_export_all_writes_every_table(spark, tmp_dir):
    import os
    stored = catalog.processed(spark, SF, "record_id")
    g = graph.store_graph(stored, tmp_dir, export_all=True)
    assert sorted(os.listdir(f"{tmp_dir}/nodes")) == sorted(graph.NODE_KEYS)
    assert sorted(os.listdir(f"{tmp_dir}/edges")) == sorted(graph.EDGE_TYPES)
    assert g.readings.count() == 5 * stored.filter("event_timestamp is not null").count()


def test_edge_views_match_the_readings_fact(spark, tmp_dir):
    g = graph.store_graph(catalog.processed(spark, SF, "record_id"), tmp_dir)
    hr, ro = g.has_reading(), g.reading_of()
    n = g.readings.count()
    assert hr.count() == ro.count() == n
    assert hr.join(ro, ["row_id", "pollutant"]).count() == n  # every reading has one hour and one type
    assert {r.name for r in ro.select("name").distinct().collect()} == {"CO", "NMHC", "Benzene", "NOx", "NO2"}


def _loaded(spark, root):
    g = graph.read_graph(spark, root)
    return _rows(graph.node_table(g)), _rows(graph.edge_table(g)), _rows(g.readings)


def test_loads_in_any_parts_and_repeated_equal_one(spark, tmp_dir):
    p = catalog.processed(spark, SF, "record_id")
    p.write.parquet(f"{tmp_dir}/p")
    p = spark.read.parquet(f"{tmp_dir}/p")
    graph.load_graph(p, f"{tmp_dir}/one")
    for part in (p.filter("day < 10"), p.filter("day >= 5"), p, p.filter("event_timestamp is null"), p.limit(0)):
        graph.load_graph(part, f"{tmp_dir}/many")
    assert _loaded(spark, f"{tmp_dir}/many") == _loaded(spark, f"{tmp_dir}/one")
    before = _loaded(spark, f"{tmp_dir}/many")
    graph.compact_graph(spark, f"{tmp_dir}/many")
    assert _loaded(spark, f"{tmp_dir}/many") == before
    graph.load_graph(p.filter("day < 10"), f"{tmp_dir}/many", replace=True)
    assert graph.read_graph(spark, f"{tmp_dir}/many").nodes["Day"].filter("day >= 10").count() == 0


def test_load_that_breaks_off_changes_nothing(spark, tmp_dir, monkeypatch):
    import pytest

    p = catalog.processed(spark, SF, "record_id")
    graph.load_graph(p.filter("day < 10"), tmp_dir)
    before = _loaded(spark, tmp_dir)
    real = graph.write_table
    for stop in (3, 9):
        calls = []

        def broken(df, path, *rest, stop=stop, calls=calls):
            calls.append(path)
            if len(calls) == stop:
                raise OSError("lost")
            return real(df, path, *rest)

        monkeypatch.setattr(graph, "write_table", broken)
        with pytest.raises(OSError):
            graph.load_graph(p, tmp_dir)
        assert _loaded(spark, tmp_dir) == before
    monkeypatch.setattr(graph, "write_table", real)
    graph.load_graph(p, tmp_dir)
    graph.load_graph(p, f"{tmp_dir}/whole")
    assert _loaded(spark, tmp_dir) == _loaded(spark, f"{tmp_dir}/whole")


def test_load_keeps_existing_properties_and_ids_of_copies(spark, tmp_dir):
    from smoglake.config import SensorConfig

    p = catalog.processed(spark, SF).filter("day = 3")  # without row ids: copies are numbered
    graph.load_graph(p, tmp_dir, id_col=None)
    g = graph.load_graph(p, tmp_dir, SensorConfig(legacy_weekday_labels=True), id_col=None)
    assert g.readings.count() == 5 * p.count()
    names = {r.code: r.name for r in g.nodes["DayOfWeek"].collect()}
    assert names == {r.code: r.name for r in graph.time_nodes(graph.calendar(p))["DayOfWeek"].collect()}
