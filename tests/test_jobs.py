"""End to end through the runnable stages, on the driver's events table."""

from smoglake import catalog, jobs
from smoglake.__main__ import _parser
from smoglake.plans import graph
from smoglake.sources.json_codec import encode_json
from smoglake.streaming import sensor_stream as S

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(df.collect(), key=lambda r: tuple(str(v) for v in r))


def test_stages_end_to_end(spark, tmp_dir):
    payloads, raw, proc = f"{tmp_dir}/payloads", f"{tmp_dir}/raw", f"{tmp_dir}/processed"
    encode_json(catalog.raw(spark, SF)).repartition(2).write.text(payloads)
    qs = jobs.ingest(spark, raw, f"{tmp_dir}/ck-ingest", payload_dir=payloads, available_now=True)
    for q in qs:
        q.awaitTermination()
    assert _rows(spark.read.parquet(raw)) == _rows(catalog.raw(spark, SF))

    p = jobs.process(spark, raw, proc)
    assert p.count() == catalog.processed(spark, SF).count()

    jobs.load_documents(spark, proc, f"{tmp_dir}/docs")
    dq = jobs.document_queries(spark, f"{tmp_dir}/docs", f"{tmp_dir}/dq")
    assert _rows(catalog.round_doubles(dq["daily_profile"])) == _rows(catalog.daily_profile(spark, SF))
    assert dq["hourly_top5"].count() == 5 and dq["hourly_top5_long"].count() == 10

    jobs.load_graph(spark, proc, f"{tmp_dir}/graph")
    gq = jobs.graph_queries(spark, f"{tmp_dir}/graph", f"{tmp_dir}/gq")
    assert _rows(catalog.round_doubles(gq["hourly_norm"])) == \
        _rows(catalog.round_doubles(graph.hourly_profile_fact(p)))
    assert gq["weekday_norm"].count() == 35 and gq["hourly_norm_matrix"].count() == 5

    qs = jobs.stream(spark, raw, f"{tmp_dir}/stream", f"{tmp_dir}/ck-stream", available_now=True, rounds=1)
    cleaned, avg = S.snapshot(spark, f"{tmp_dir}/stream")
    assert len(qs) == 1 and avg.count() == 5 and cleaned.count() == S.clean(catalog.raw(spark, SF)).count()


def test_cli_parses_every_stage():
    p = _parser()
    assert p.parse_args(["process", "--raw", "a", "--processed", "b"]).stage == "process"
    assert p.parse_args(["stream", "--raw", "a", "--out", "b", "--checkpoint", "c",
                         "--available-now"]).available_now
    assert p.parse_args(["ingest", "--raw", "a", "--checkpoint", "c", "--payload-dir", "d"]).payload_dir == "d"
