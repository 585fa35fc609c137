"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5, median reported after one warm-up), BENCH_QUERIES
(comma list to restrict). Each query is executed in full through the
``noop`` sink, so timing covers the whole plan without collecting rows.

``queries`` (and ``value``, their sum) are cold: the stored processed table that
consumers share within a session is dropped before every run, so each run
builds it. ``stored`` has the same queries once it is there.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from smoglake.catalog import QUERIES, forget_stored  # noqa: E402
from smoglake.session import build_session  # noqa: E402

HEADLINE = [
    "processed",
    "daily_profile",
    "hourly_top5",
    "nested_documents",
    "graph_hourly_norm",
    "graph_weekday_norm_fact",
    "hourly_norm_pivot",
    "csv_normalize",
    "stream_ingest",
    "stream_pollutant_avg",
    "lineitem_processed",
    "lineitem_weekday_norm",
    "lineitem_hourly_norm",
]


def _run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(cpus, app="smoglake-bench", shuffle_partitions=cpus)
    times, stored = {}, {}

    def cold(name):
        forget_stored(spark)
        return _run(spark, name, sf_dir)

    for name in names:
        cold(name)  # warm-up (JIT, file listing caches)
        times[name] = round(statistics.median(cold(name) for _ in range(runs)), 3)
        stored[name] = round(statistics.median(_run(spark, name, sf_dir) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "stored": stored,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
