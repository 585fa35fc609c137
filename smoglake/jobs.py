"""The pipeline's runnable stages (C1-C10) over paths on shared storage.

Each job takes a session and paths, writes its outputs with Spark, and
returns the frames it produced. ``python -m smoglake <stage> ...`` runs one
stage with the cluster's session (see ``__main__``).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from .config import AIR_QUALITY, SensorConfig
from .operators import increment
from .operators.cleaning import clean_and_transform
from .plans import analytics, charts, documents, graph
from .plans.presentation import preview
from .session import drop_path, scratch_path
from .sources.delimited import read_sensor_csv
from .sources.json_codec import raw_schema
from .sources.kafka import kafka_source, publish
from .sources.tables import write_overwrite
from .streaming import sensor_stream as S


def publish_csv(spark: SparkSession, csv_path: str, brokers: str, topic: str) -> DataFrame:
    """Source CSV -> cleaned rows -> one JSON record per row on a topic."""
    rows = read_sensor_csv(spark, csv_path)
    publish(rows, brokers, topic)
    return rows


def ingest(spark: SparkSession, raw_path: str, checkpoint: str, brokers: str | None = None,
           topic: str | None = None, payload_dir: str | None = None, available_now: bool = False,
           console: bool = False, starting_offsets: str = "latest", cfg: SensorConfig = AIR_QUALITY,
           max_files_per_trigger: int | None = None) -> list:
    """Topic (or a folder of payload files) -> typed rows -> raw parquet."""
    if brokers and topic:
        payloads = kafka_source(spark, brokers, topic, starting_offsets)
    else:
        payloads = S.payload_stream(spark, payload_dir, max_files_per_trigger)
    return S.ingest(payloads, raw_schema(cfg), raw_path, checkpoint, available_now=available_now, console=console)


def process(spark: SparkSession, raw_path: str, processed_path: str, cfg: SensorConfig = AIR_QUALITY,
            partition_by: list[str] | None = None, id_col: str | None = "record_id") -> DataFrame:
    """Raw parquet -> processed parquet (overwrite); the deduplicated rows
    are staged once under the shared checkpoint folder."""
    staging = scratch_path(spark, "dedup")
    try:
        staged = clean_and_transform(S.read_ingested(spark, raw_path), cfg, id_col, staging_path=staging)
        write_overwrite(staged, processed_path, partition_by)
    finally:
        drop_path(spark, staging)
    return spark.read.parquet(processed_path)


def process_increment(spark: SparkSession, raw_path: str, store: str, checkpoint: str,
                      cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    """C3 over an append-only raw table: only files that no earlier run has seen are read (the stream's checkpoint knows
    them) and added to the store; returns the processed table of all loads."""
    stream = S.file_stream(spark, raw_path, S.batch_schema(spark, raw_path))
    query = (stream.writeStream.foreachBatch(lambda rows, epoch: increment.load(rows, store, cfg))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    S.run_until_done([query])
    return increment.read_processed(spark, store, cfg)


def load_documents(spark: SparkSession, processed_path: str, documents_path: str,
                   cfg: SensorConfig = AIR_QUALITY, replace_with_empty: bool = False) -> DataFrame:
    """Processed -> nested documents (full refresh; an empty input leaves the collection alone)."""
    documents.write_documents(documents.nest(spark.read.parquet(processed_path), cfg), documents_path,
                              replace_with_empty=replace_with_empty)
    return documents.read_documents(spark, documents_path, cfg)


def document_queries(spark: SparkSession, documents_path: str, out: str,
                     cfg: SensorConfig = AIR_QUALITY) -> dict[str, DataFrame]:
    """C6 + C10: daily profile, top-5 hours and its long chart form."""
    docs = documents.read_documents(spark, documents_path, cfg)
    top = analytics.hourly_top(docs, 5)
    results = {"daily_profile": analytics.daily_profile(docs, spark),
               "hourly_top5": top,
               "hourly_top5_long": analytics.hourly_top_long(top)}
    return _write_results(spark, results, out)


def load_graph(spark: SparkSession, processed_path: str, graph_path: str,
               cfg: SensorConfig = AIR_QUALITY, replace: bool = False) -> graph.Graph:
    """Processed -> every node, edge and reading table, merged into what earlier loads stored there."""
    return graph.load_graph(spark.read.parquet(processed_path), graph_path, cfg, replace=replace)


def graph_queries(spark: SparkSession, graph_path: str, out: str) -> dict[str, DataFrame]:
    """C8 + C10: hourly and weekday normalised profiles, their chart tables by pollutant, and the heat-map matrix."""
    from .operators.reshape import pivot_matrix
    g = graph.read_graph(spark, graph_path)
    hourly = graph.hourly_profile(g)
    weekday = graph.weekday_profile(g)
    for name, profile in (("hourly_charts", hourly), ("weekday_charts", weekday)):
        charts.write_charts(profile, f"{out}/{name}")
    results = {"hourly_norm": hourly,
               "weekday_norm": weekday,
               "hourly_norm_matrix": pivot_matrix(hourly, "Pollutant", "HourOfDay", "NormalizedValue",
                                                  [f"{h:02d}:00" for h in range(24)])}
    return _write_results(spark, results, out)


def stream(spark: SparkSession, raw_path: str, out: str, checkpoint: str, cfg: SensorConfig = AIR_QUALITY,
           available_now: bool = False, max_files_per_trigger: int | None = None,
           processing_time: str | None = None, rounds: int = 0, wait_s: float = 3.0) -> list:
    """Raw file stream -> cleaned rows and running averages under ``out``, with
    ``rounds`` live snapshots ``wait_s`` apart (T8)."""
    schema = S.batch_schema(spark, raw_path)
    query = S.analytics(spark, raw_path, out, checkpoint, cfg, available_now, max_files_per_trigger, processing_time, schema)
    if available_now:
        S.run_until_done([query])
    for top, avgs in S.snapshots(spark, out, rounds, wait=lambda: time.sleep(wait_s),
                                 schemas=S.result_schemas(spark, schema, cfg), cfg=cfg):
        preview(top, 10)
        preview(avgs, 10)
    return [query]


def _write_results(spark: SparkSession, results: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in results}
