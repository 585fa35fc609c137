"""Structured Streaming stages (C2, C9: T1-T10, S4-S5, S8, K2-K5).

The transforms (:func:`clean`, :func:`long_form`, :func:`running_average`)
are plain DataFrame functions that work on batch and streaming frames alike,
so a batch run over the same files is the oracle of the stream.

Sinks: the reference keeps both results in driver-memory tables. Here a stream
with one result goes to a parquet file sink (append, exactly-once via its
metadata log) or, in complete mode, to a folder per micro-batch that a commit
publishes (:mod:`smoglake.sources.versions`). A stream with several results is one
query (:func:`start_fan_out`): it reads its source once per epoch, stores the
epoch's rows, derives the other results from them and publishes all by one
commit, so readers see results of the same epoch.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..config import AIR_QUALITY, SensorConfig
from ..functions.numbers import add_sums, mean_of_sums, part_sums
from ..operators.cleaning import event_time, rename_columns
from ..operators.quality import listwise_filter
from ..operators.reshape import to_long
from ..sources import versions
from ..sources.json_codec import decode_json, raw_schema

PROCESSING_TIME = "3 seconds"
VACUUM_EVERY = 100  # epochs between deletions of what no reader may need any more


# ------------------------------------------------------------- transforms --

def clean(df: DataFrame, cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    """Drop auxiliary sensors, add the timestamp (date/time strings are
    kept), drop rows with any missing pollutant (F1), rename (P9).

    No distinct and no imputation on the stream (quirk Q2).
    """
    out = df.drop(*cfg.dropped_columns)
    made = (F.col(cfg.timestamp_col).cast("timestamp_ntz") if cfg.timestamp_col is not None
            else event_time(F.col(cfg.date_col), F.col(cfg.time_col), cfg.timestamp_format))
    out = listwise_filter(out.withColumn(cfg.event_time, made), cfg.raw_measures, cfg.sentinel)
    return rename_columns(out, cfg.stream_renames)


def long_form(cleaned: DataFrame, cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    """(event_timestamp, pollutant, reading) with the stream labels."""
    return to_long(cleaned, [cfg.event_time], {m.label: m.stream for m in cfg.measures},
                   "pollutant", "reading")


def running_sums(long: DataFrame, scale: int | None = AIR_QUALITY.scale) -> DataFrame:
    """A8 + T6: what the mean reading per pollutant is made of: exact sums and counts.

    A handful of keys that never expire, on batch and streaming frames alike. With ``scale`` (decimal
    places of the readings) the sum is a decimal, else it is kept in exact parts, so the state
    does not depend on how the rows fall into micro-batches.
    """
    return part_sums(long, ["pollutant"], "reading", scale)


def averages(sums: DataFrame) -> DataFrame:
    """(pollutant, avg_reading) from :func:`running_sums`."""
    return mean_of_sums(sums, ["pollutant"], "avg_reading")


def running_average(long: DataFrame, scale: int | None = AIR_QUALITY.scale) -> DataFrame:
    """Mean reading per pollutant, the same bits in any order of the rows."""
    return averages(running_sums(long, scale))


def earliest(table: DataFrame, n: int = 10, ts_col: str = "event_timestamp") -> DataFrame:
    """The ``n`` earliest rows, ties broken on every column (nulls first,
    as Spark's ascending order puts them)."""
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in table.columns if c != ts_col]
    return table.orderBy(F.col(ts_col).asc_nulls_first(), *rest).limit(n)


# ---------------------------------------------------------------- sources --

def batch_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> StructType:
    """Pin the stream schema from a batch read of the same directory."""
    return spark.read.format(fmt).load(path).schema


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, path_glob: str | None = None) -> DataFrame:
    """File source over a directory (a single-file path is not accepted by
    Spark; select files with ``path_glob``). ``max_files_per_trigger`` is a
    rate limit (T3); by default a micro-batch takes all new files."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.load(path)


def payload_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files of JSON payloads as a stream with a ``value`` column (the
    file-based stand-in for a topic)."""
    return file_stream(spark, path, StructType([StructField("value", StringType())]), "text",
                       max_files_per_trigger)


# ------------------------------------------------------------------ sinks --

def _trigger(writer, available_now: bool, processing_time: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time or PROCESSING_TIME)


def start_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                available_now: bool = False, processing_time: str | None = None,
                name: str | None = None) -> StreamingQuery:
    """K2: append to a file table with a checkpoint (exactly-once)."""
    w = (df.writeStream.outputMode("append").format(fmt)
         .option("path", path).option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return _trigger(w, available_now, processing_time).start()


@contextmanager
def _start_conf(spark: SparkSession, key: str, value: str | None):
    """Set a conf only while a query starts: a streaming query snapshots the
    session conf at start, and its checkpoint keeps it on restarts."""
    if value is None:
        yield
        return
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def read_result(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The last published result of :func:`start_overwrite_table`; without rows if there is none yet."""
    version = versions.latest(spark, path)
    return spark.createDataFrame([], schema) if version is None else version.read(spark, "result", schema)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps with a checkpoint."""
    files, target = versions._files(spark, f"{checkpoint}/metadata")
    stream = files.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def start_overwrite_table(df: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                          processing_time: str | None = None,
                          state_partitions: int | None = None,
                          finish: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """K5 at scale: complete-mode result written as a whole table each micro-batch.

    Each epoch's result (after ``finish``, a batch step) goes to a folder of its own, which a commit
    then publishes; commits are only ever added, so a reader at any time finds a whole result. An epoch that runs again
    after a failure is not published twice. An empty result is published before the first epoch, unless an
    earlier run left one. Read it with :func:`read_result`.

    ``state_partitions`` sizes the stateful aggregate's shuffle and state
    store by its key count instead of the session's batch-sized
    ``spark.sql.shuffle.partitions`` (which could mean hundreds of thousands
    of tasks per micro-batch for a handful of keys).
    """
    spark = df.sparkSession
    if versions.latest(spark, path) is None:
        versions.publish(spark, path, {"result": []}, {"stream": "", "epoch": -1})

    def write(batch: DataFrame, epoch: int) -> None:
        stream, before = _stream_id(spark, checkpoint), versions.latest(spark, path)
        if before.about["stream"] == stream and before.about["epoch"] >= epoch:
            return
        folder = versions.fresh_folder("result")
        (finish(batch) if finish else batch).write.parquet(f"{path}/{folder}")
        versions.publish(spark, path, {"result": [folder]}, {"stream": stream, "epoch": epoch}, after=before)
        if epoch % VACUUM_EVERY == VACUUM_EVERY - 1:
            versions.vacuum(spark, path, "result")

    w = (df.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    with _start_conf(df.sparkSession, "spark.sql.shuffle.partitions",
                     str(state_partitions) if state_partitions else None):
        return _trigger(w, available_now, processing_time).start()


Sink = Callable[[DataFrame, "versions.Version | None", int], dict[str, list[str]]]


def start_fan_out(df: DataFrame, root: str, checkpoint: str, sinks: tuple[Sink, ...] = (), available_now: bool = False,
                  processing_time: str | None = None) -> StreamingQuery:
    """One stream, several results, one read of the source per epoch.

    An epoch's rows are stored once under ``root``; each sink then gets (the stored rows of the
    epoch, the version before, the epoch) and returns the tables it wrote, as folders under ``root``.
    One commit publishes the rows and all tables. An epoch that broke off
    anywhere, also between sinks, runs again from its start: its rows replace what it had stored, and nothing of
    it was visible. A root belongs to one checkpoint; another one raises.
    """
    spark = df.sparkSession

    def write(batch: DataFrame, epoch: int) -> None:
        stream, before = _stream_id(spark, checkpoint), versions.latest(spark, root)
        if before is not None and before.about["stream"] != stream:
            raise ValueError(f"{root} holds the rows of another checkpoint than {checkpoint}")
        if before is not None and before.about["epoch"] >= epoch:
            return
        here = f"{root}/rows/epoch={epoch}"
        batch.write.mode("overwrite").parquet(here)
        stored = spark.read.schema(batch.schema).parquet(here)
        tables = {}
        for sink in sinks:
            tables.update(sink(stored, before, epoch))
        versions.publish(spark, root, tables, {"stream": stream, "epoch": epoch}, after=before)
        if epoch % VACUUM_EVERY == VACUUM_EVERY - 1:
            versions.vacuum(spark, root, "table")

    return _trigger(df.writeStream.outputMode("append").foreachBatch(write)
                    .option("checkpointLocation", checkpoint), available_now, processing_time).start()


def read_rows(spark: SparkSession, root: str, schema: StructType, version: versions.Version | None = None) -> DataFrame:
    """The rows that :func:`start_fan_out` had published with ``version`` (the last one)."""
    version = version or versions.latest(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, StructField("epoch", LongType())])).parquet(f"{root}/rows")
    return rows.filter(F.col("epoch") <= version.about["epoch"]).drop("epoch")  # prunes the folders


def averages_sink(root: str, cfg: SensorConfig = AIR_QUALITY) -> Sink:
    """K5 as a sink of :func:`start_fan_out`: the running sums so far, as table ``sums``.

    The last version's sums (a row per pollutant, or per pollutant and exponent bin) plus those of the epoch's rows.
    """
    def sink(rows: DataFrame, before: versions.Version | None, epoch: int) -> dict[str, list[str]]:
        spark, sums = rows.sparkSession, running_sums(long_form(rows, cfg), cfg.scale)
        if before is not None:
            sums = add_sums(before.read(spark, "sums", sums.schema).unionByName(sums), ["pollutant"])
        folder = versions.fresh_folder("table")
        sums.coalesce(1).write.parquet(f"{root}/{folder}")
        return {"sums": [folder]}

    return sink


def console_sink(rows: DataFrame, before: versions.Version | None, epoch: int) -> dict[str, list[str]]:
    """K3 as a sink of :func:`start_fan_out`: shows the first rows of each epoch."""
    print(f"--- epoch {epoch} ---")
    rows.show(20, truncate=False)
    return {}


def start_console(df: DataFrame, available_now: bool = False,
                  processing_time: str | None = None) -> StreamingQuery:
    """K3: debug echo of a stream."""
    return _trigger(df.writeStream.outputMode("append").format("console"),
                    available_now, processing_time).start()


# ------------------------------------------------------------ composites --

def ingest(payloads: DataFrame, schema: StructType, out_path: str, checkpoint: str,
           available_now: bool = False, console: bool = False,
           processing_time: str | None = None) -> list[StreamingQuery]:
    """T1 + T2 + T7: payload stream -> decoded rows -> parquet (+ console).

    ``payloads`` is any streaming frame with a ``value`` column: a topic
    (:func:`smoglake.sources.kafka.kafka_source`) or :func:`payload_stream`. With
    ``console`` it is one query that reads the payloads once and shows each
    epoch's stored rows. Read either form with :func:`read_ingested`.
    """
    rows = decode_json(payloads, schema)
    if console or versions.latest(payloads.sparkSession, out_path) is not None:
        return [start_fan_out(rows, out_path, checkpoint, (console_sink,) if console else (), available_now, processing_time)]
    return [start_files(rows, out_path, checkpoint, available_now=available_now,
                        processing_time=processing_time)]


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """The raw table that :func:`ingest` fills, in either form, or any parquet table."""
    version = versions.latest(spark, path)
    if version is None:
        return spark.read.parquet(path)
    schema = spark.read.parquet(f"{path}/rows/epoch={version.about['epoch']}").schema
    return read_rows(spark, path, schema, version)


def run_until_done(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Block until every query ends (availableNow) and surface failures.

    ``timeout_s`` is for all together. If it passes, or a query fails, the
    others are stopped and an error is raised: a result that is not complete
    is never taken for one.
    """
    end = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        for q in queries:
            left = None if end is None else max(0.1, end - time.monotonic())
            if q.awaitTermination(left) is False:
                raise TimeoutError(f"stream {q.name or q.id} still ran after {timeout_s} s")
            if q.exception() is not None:
                raise RuntimeError(f"stream {q.name or q.id} failed: {q.exception()}")
    except BaseException:
        stop_all(queries)
        raise


def analytics(spark: SparkSession, raw_dir: str, out: str, checkpoint: str,
              cfg: SensorConfig = AIR_QUALITY, available_now: bool = False,
              max_files_per_trigger: int | None = None,
              processing_time: str | None = None, schema: StructType | None = None) -> StreamingQuery:
    """Raw file stream -> cleaned rows and running averages, one query that reads each file once.

    The stream schema is pinned from a batch read of ``raw_dir`` unless given. Read the results with :func:`snapshot`.
    """
    src = file_stream(spark, raw_dir, schema or batch_schema(spark, raw_dir), "parquet", max_files_per_trigger)
    return start_fan_out(clean(src, cfg), out, checkpoint, (averages_sink(out, cfg),), available_now, processing_time)


def result_schemas(spark: SparkSession, raw: StructType, cfg: SensorConfig = AIR_QUALITY) -> tuple[StructType, StructType]:
    """Schemas of the cleaned rows and of the running sums for raw rows of schema ``raw``."""
    cleaned = clean(spark.createDataFrame([], raw), cfg)
    return cleaned.schema, running_sums(long_form(cleaned, cfg), cfg.scale).schema


def read_sink(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows a file sink has committed so far; without rows before its first commit."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def snapshot(spark: SparkSession, out: str, schemas: tuple[StructType, StructType] | None = None,
             cfg: SensorConfig = AIR_QUALITY, version: versions.Version | None = None) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, averages) of one epoch of :func:`analytics`; without rows before its first one."""
    schemas = schemas or result_schemas(spark, raw_schema(cfg), cfg)
    version = version or versions.latest(spark, out)
    sums = spark.createDataFrame([], schemas[1]) if version is None else version.read(spark, "sums", schemas[1])
    return read_rows(spark, out, schemas[0], version), averages(sums)


def snapshots(spark: SparkSession, out: str, rounds: int = 10,
              wait: Callable[[], None] | None = None, n: int = 10,
              schemas: tuple[StructType, StructType] | None = None, cfg: SensorConfig = AIR_QUALITY):
    """Repeated snapshots of both results before, while and after the stream runs.

    Yields (earliest n cleaned rows, averages ordered by pollutant) of one epoch per round;
    ``wait`` is called between rounds (e.g. ``time.sleep(3)``).
    """
    schemas = schemas or result_schemas(spark, raw_schema(cfg), cfg)
    for i in range(rounds):
        cleaned, avg = snapshot(spark, out, schemas, cfg)
        yield earliest(cleaned, n, cfg.event_time), avg.orderBy("pollutant")
        if wait and i + 1 < rounds:
            wait()


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Block until any active query of the session ends (or fails)."""
    spark.streams.awaitAnyTermination(timeout_s)


def stop_all(queries: list[StreamingQuery]) -> None:
    """Stop the given queries (their checkpoints allow a later restart)."""
    for q in queries:
        q.stop()
