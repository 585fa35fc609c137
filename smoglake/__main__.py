"""Command line: ``python -m smoglake <stage> [options]`` (or spark-submit).

Stages: publish, ingest, process, process-increment, load-documents, document-queries,
load-graph, graph-queries, stream. The session comes from the cluster
(``SparkSession.builder.getOrCreate()``); paths are on shared storage.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from . import jobs
from .plans.presentation import preview


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="smoglake")
    sub = p.add_subparsers(dest="stage", required=True)

    s = sub.add_parser("publish", help="CSV -> topic")
    s.add_argument("--csv", required=True)
    s.add_argument("--brokers", required=True)
    s.add_argument("--topic", required=True)

    s = sub.add_parser("ingest", help="topic or payload files -> raw parquet")
    s.add_argument("--raw", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--brokers")
    s.add_argument("--topic")
    s.add_argument("--payload-dir")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--console", action="store_true")
    s.add_argument("--max-files-per-trigger", type=int)

    s = sub.add_parser("process", help="raw -> processed")
    s.add_argument("--raw", required=True)
    s.add_argument("--processed", required=True)
    s.add_argument("--partition-by", default="")

    s = sub.add_parser("process-increment", help="files of raw that are new -> store of processed rows")
    s.add_argument("--raw", required=True)
    s.add_argument("--store", required=True)
    s.add_argument("--checkpoint", required=True)

    s = sub.add_parser("load-documents", help="processed -> documents")
    s.add_argument("--processed", required=True)
    s.add_argument("--documents", required=True)
    s.add_argument("--replace-with-empty", action="store_true")

    s = sub.add_parser("document-queries", help="documents -> daily / hourly results")
    s.add_argument("--documents", required=True)
    s.add_argument("--out", required=True)

    s = sub.add_parser("load-graph", help="processed -> graph tables")
    s.add_argument("--processed", required=True)
    s.add_argument("--graph", required=True)
    s.add_argument("--replace", action="store_true", help="start over instead of merging into earlier loads")

    s = sub.add_parser("graph-queries", help="graph -> normalised profiles")
    s.add_argument("--graph", required=True)
    s.add_argument("--out", required=True)

    s = sub.add_parser("stream", help="raw file stream -> cleaned rows and running averages")
    s.add_argument("--raw", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--processing-time", default="3 seconds")
    s.add_argument("--rounds", type=int, default=10)
    s.add_argument("--wait", type=float, default=3.0)
    return p


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"smoglake-{a.stage}").getOrCreate()
    if a.stage == "publish":
        jobs.publish_csv(spark, a.csv, a.brokers, a.topic)
    elif a.stage == "ingest":
        qs = jobs.ingest(spark, a.raw, a.checkpoint, a.brokers, a.topic, a.payload_dir,
                         a.available_now, a.console, a.starting_offsets,
                         max_files_per_trigger=a.max_files_per_trigger)
        if not a.available_now:
            spark.streams.awaitAnyTermination()
        for q in qs:
            q.awaitTermination()
    elif a.stage == "process":
        parts = [c for c in a.partition_by.split(",") if c]
        preview(jobs.process(spark, a.raw, a.processed, partition_by=parts or None))
    elif a.stage == "process-increment":
        preview(jobs.process_increment(spark, a.raw, a.store, a.checkpoint))
    elif a.stage == "load-documents":
        preview(jobs.load_documents(spark, a.processed, a.documents, replace_with_empty=a.replace_with_empty))
    elif a.stage == "document-queries":
        for name, df in jobs.document_queries(spark, a.documents, a.out).items():
            print(f"--- {name} ---")
            preview(df, df.count())  # one row per weekday or hour
    elif a.stage == "load-graph":
        jobs.load_graph(spark, a.processed, a.graph, replace=a.replace)
    elif a.stage == "graph-queries":
        for name, df in jobs.graph_queries(spark, a.graph, a.out).items():
            print(f"--- {name} ---")
            preview(df, df.count())  # one row per measure and hour or weekday
    elif a.stage == "stream":
        qs = jobs.stream(spark, a.raw, a.out, a.checkpoint, available_now=a.available_now,
                         max_files_per_trigger=a.max_files_per_trigger, processing_time=a.processing_time,
                         rounds=a.rounds, wait_s=a.wait)
        for q in qs:
            q.stop()


if __name__ == "__main__":
    main()
