import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from smoglake import catalog
from smoglake.config import AIR_QUALITY, lineitem_config
from smoglake.sources.json_codec import encode_json, raw_schema
from smoglake.streaming import sensor_stream as S

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(df.collect(), key=lambda r: tuple(str(v) for v in r))


def _stage(spark, path, files):
    catalog.raw(spark, SF).repartition(files).write.mode("overwrite").parquet(path)


def test_stream_equals_batch_bit_by_bit_for_any_split(spark, tmp_dir):
    batch_clean = _rows(S.clean(catalog.raw(spark, SF)))
    batch_avg = _rows(S.running_average(S.long_form(S.clean(catalog.raw(spark, SF)))))
    src = f"{tmp_dir}/raw"
    _stage(spark, src, 7)
    for per_trigger in (1, 3, None):
        out = f"{tmp_dir}/out{per_trigger}"
        q = S.analytics(spark, src, out, f"{tmp_dir}/ck{per_trigger}", available_now=True, max_files_per_trigger=per_trigger)
        S.run_until_done([q])
        cleaned, avg = S.snapshot(spark, out)
        assert _rows(cleaned) == batch_clean and _rows(avg) == batch_avg


def test_any_doubles_stream_to_the_same_bits(spark, tmp_dir):
    """Without a declared scale the state is kept in exact parts: 1, 2 or 6 files per trigger give the same averages."""
    cfg = replace(AIR_QUALITY, scale=None)
    wild = catalog.raw(spark, SF).withColumns({c: F.when(F.col(c) == -200, F.col(c)).otherwise(F.col(c) * F.pow(F.lit(10.0), F.col("T") % 17 - 8))
                                               for c in cfg.raw_measures})
    wild.repartition(6).write.parquet(f"{tmp_dir}/raw")
    want = _rows(S.running_average(S.long_form(S.clean(wild, cfg), cfg), None))
    for files in (1, 2, 6):
        out = f"{tmp_dir}/out{files}"
        S.run_until_done([S.analytics(spark, f"{tmp_dir}/raw", out, f"{tmp_dir}/ck{files}", cfg, available_now=True,
                                      max_files_per_trigger=files)])
        assert _rows(S.snapshot(spark, out, cfg=cfg)[1]) == want
    sums = S.running_sums(S.long_form(S.clean(S.file_stream(spark, f"{tmp_dir}/raw", wild.schema, max_files_per_trigger=1), cfg), cfg), None)
    S.run_until_done([S.start_overwrite_table(sums, f"{tmp_dir}/t", f"{tmp_dir}/ckt", available_now=True, finish=S.averages)])
    assert _rows(S.read_result(spark, f"{tmp_dir}/t", "pollutant string, avg_reading double")) == want


def test_source_is_read_once_per_epoch(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    _stage(spark, src, 4)
    q = S.analytics(spark, src, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True, max_files_per_trigger=1)
    S.run_until_done([q])
    counts = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(counts) == 4 and sum(counts) == catalog.raw(spark, SF).count()


def test_restart_between_the_sinks_leaves_no_duplicate(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _stage(spark, src, 4)
    stream = S.clean(S.file_stream(spark, src, S.batch_schema(spark, src), max_files_per_trigger=1))
    good, fail = S.averages_sink(out), [2]

    def breaks_off(rows, before, epoch):
        if epoch in fail:
            fail.remove(epoch)
            raise OSError("lost")
        return {}

    def run(*sinks):
        S.run_until_done([S.start_fan_out(stream, out, ck, sinks, available_now=True)])

    with pytest.raises(Exception, match="lost"):
        run(good, breaks_off)
    assert S.versions.latest(spark, out).about["epoch"] == 1
    cleaned, avg = S.snapshot(spark, out)
    assert _rows(S.running_average(S.long_form(cleaned))) == _rows(avg)
    run(good, breaks_off)
    cleaned, avg = S.snapshot(spark, out)
    assert _rows(cleaned) == _rows(S.clean(catalog.raw(spark, SF)))
    assert _rows(avg) == _rows(S.running_average(S.long_form(S.clean(catalog.raw(spark, SF)))))
    with pytest.raises(Exception, match="another checkpoint"):
        S.run_until_done([S.start_fan_out(stream, out, f"{tmp_dir}/other", (good,), available_now=True)])
    spark.streams.resetTerminated()  # these failures were meant


def test_a_reader_never_fails_and_sees_one_epoch(spark, tmp_dir):
    import threading

    src, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    _stage(spark, src, 25)
    schemas = S.result_schemas(spark, S.batch_schema(spark, src))
    q = S.analytics(spark, src, out, f"{tmp_dir}/ck", available_now=True, max_files_per_trigger=1)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            cleaned, avg = S.snapshot(spark, out, schemas)
            own = {r.pollutant: r.avg_reading for r in S.running_average(S.long_form(cleaned)).collect()}
            seen.append((own, {r.pollutant: r.avg_reading for r in avg.collect()}))

    reader = threading.Thread(target=read)
    reader.start()
    S.run_until_done([q])
    stop.set()
    reader.join()
    assert len(seen) > 2 and all(own == published for own, published in seen)


def _averages(spark, path):
    return S.read_result(spark, path, "pollutant string, avg_reading double")


def test_files_per_micro_batch(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    _stage(spark, src, 4)
    for limit, batches in ((1, 4), (None, 1)):
        stream = S.clean(S.file_stream(spark, src, S.batch_schema(spark, src), max_files_per_trigger=limit))
        q = S.start_files(stream, f"{tmp_dir}/out{limit}", f"{tmp_dir}/ck{limit}", available_now=True)
        S.run_until_done([q])
        assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == batches


def test_timeout_raises_and_stops_all(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    _stage(spark, src, 1)
    stream = S.clean(S.file_stream(spark, src, S.batch_schema(spark, src)))
    qs = [S.start_files(stream, f"{tmp_dir}/o{i}", f"{tmp_dir}/ck{i}", processing_time="1 second") for i in range(2)]
    with pytest.raises(TimeoutError):
        S.run_until_done(qs, timeout_s=1.0)
    assert not any(q.isActive for q in qs)


def test_snapshots_before_during_and_after(spark, tmp_dir):
    src, out = f"{tmp_dir}/raw", f"{tmp_dir}/out"
    _stage(spark, src, 3)
    (top, avg), = S.snapshots(spark, out, rounds=1)
    assert top.count() == 0 and avg.count() == 0
    q = S.analytics(spark, src, out, f"{tmp_dir}/ck", max_files_per_trigger=1, processing_time="1 second")
    for top, avg in S.snapshots(spark, out, rounds=4, wait=lambda: time.sleep(0.3)):
        assert (top.count(), avg.count()) in ((0, 0), (10, 5))
    q.processAllAvailable()
    (top, avg), = S.snapshots(spark, out, rounds=1)
    S.stop_all([q])
    assert top.count() == 10 and _rows(avg) == _rows(S.running_average(S.long_form(S.clean(catalog.raw(spark, SF)))))


def test_any_configuration_streams(spark):
    cfg = lineitem_config()
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    out = S.running_average(S.long_form(S.clean(li, cfg), cfg))
    assert {r.pollutant for r in out.collect()} == {"quantity", "extendedprice", "discount", "tax"}


def test_ingest_payload_files(spark, tmp_dir):
    payloads = f"{tmp_dir}/payloads"
    encode_json(catalog.raw(spark, SF)).repartition(3).write.text(payloads)
    qs = S.ingest(S.payload_stream(spark, payloads), raw_schema(), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                  available_now=True)
    S.run_until_done(qs)
    assert _rows(spark.read.parquet(f"{tmp_dir}/out")) == _rows(catalog.raw(spark, SF))


def test_restart_from_checkpoint_is_exactly_once(spark, tmp_dir):
    """A stopped stream resumes from its checkpoint: files seen once, none twice."""
    raw = catalog.raw(spark, SF)
    src, out, ck, avg = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck", f"{tmp_dir}/avg"
    first, second = raw.randomSplit([0.5, 0.5], seed=7)
    first.repartition(2).write.parquet(f"{src}/a")
    schema = raw.schema

    def run():
        stream = S.clean(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                         .option("recursiveFileLookup", "true").parquet(src))
        q1 = S.start_files(stream, out, f"{ck}/c", available_now=True)
        q2 = S.start_overwrite_table(S.running_sums(S.long_form(stream)), avg, f"{ck}/a", available_now=True, finish=S.averages)
        S.run_until_done([q1, q2])

    run()
    second.repartition(3).write.parquet(f"{src}/b")
    run()  # same checkpoints: only the new files are processed
    want = catalog.round_doubles(S.clean(raw))
    assert _rows(catalog.round_doubles(spark.read.parquet(out))) == _rows(want)
    assert _rows(_averages(spark, avg)) == _rows(S.running_average(S.long_form(S.clean(raw))))


def test_ingest_with_console_reads_the_payloads_once(spark, tmp_dir, capfd):
    payloads = f"{tmp_dir}/payloads"
    encode_json(catalog.raw(spark, SF)).write.text(payloads)
    n = catalog.raw(spark, SF).count()
    q, = S.ingest(S.payload_stream(spark, payloads), raw_schema(), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                  available_now=True, console=True)
    S.run_until_done([q])
    assert sum(p["numInputRows"] for p in q.recentProgress) == n and "epoch 0" in capfd.readouterr().out
    encode_json(catalog.raw(spark, SF).limit(5)).write.mode("append").text(payloads)
    S.run_until_done(S.ingest(S.payload_stream(spark, payloads), raw_schema(), f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True))
    back = S.read_ingested(spark, f"{tmp_dir}/out")
    assert back.count() == n + 5 and back.columns == raw_schema().names


def test_state_partitions_sized_by_keys(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    _stage(spark, src, 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sums = S.running_sums(S.long_form(S.clean(S.file_stream(spark, src, S.batch_schema(spark, src)))))
    S.run_until_done([S.start_overwrite_table(sums, f"{tmp_dir}/a", f"{tmp_dir}/ck", available_now=True, state_partitions=5)])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # session untouched
    import glob
    offsets = open(sorted(glob.glob(f"{tmp_dir}/ck/offsets/*"))[0]).read()
    assert '"spark.sql.shuffle.partitions":"5"' in offsets  # state store layout kept by the checkpoint


def test_lifecycle_helpers(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    _stage(spark, src, 1)
    stream = S.clean(S.file_stream(spark, src, S.batch_schema(spark, src)))
    q = S.start_files(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck", processing_time="1 second")
    q.processAllAvailable()
    S.stop_all([q])
    assert not q.isActive
    q2 = S.start_files(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True)
    S.await_any(spark, 120)  # returns once the availableNow query ends
    q2.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/out").count() == S.clean(catalog.raw(spark, SF)).count()
