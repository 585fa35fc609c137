"""Incremental processing of an append-only raw table.

The store keeps the deduplicated, renamed and nulled rows of all loads, bucketed
by the 32-byte id of the raw row's content, and the exact sums that the means are made
of. A load deduplicates its own rows, drops those whose id is stored already
and adds the rest: only its rows are shuffled, into the store's buckets, and the stored
ids (one column) are scanned where they lie, without an exchange. Means change with
every load, so gaps are filled when the processed table is read, by a projection.

A load becomes visible by one commit (:mod:`smoglake.sources.versions`); one that
broke off leaves a partition that no version names. A repeated load adds nothing.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import AIR_QUALITY, SensorConfig
from ..functions.numbers import add_sums
from ..sources import versions
from . import cleaning as C

ID, LOAD = "record_id", "load"
BUCKETS = 64  # default of a new store; about one per 256 MB of rows expected


def _row_schema(schema: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(schema))


@contextmanager
def _bucketed(spark: SparkSession, root: str, schema: T.StructType, buckets: int):
    """The stored rows as a bucketed table under a name of its own; dropping an external table leaves its files."""
    name = f"smoglake_rows_{uuid.uuid4().hex[:16]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}, `{LOAD}` STRING) USING parquet PARTITIONED BY (`{LOAD}`) "
              f"CLUSTERED BY (`{ID}`) SORTED BY (`{ID}`) INTO {buckets} BUCKETS LOCATION '{root}/rows'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def unseen(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows whose id is not among the stored ones. ``stored`` is bucketed by the id: the rows are exchanged to its
    buckets, it is not."""
    return rows.join(stored.select(ID), ID, "left_anti")


def load(raw: DataFrame, root: str, cfg: SensorConfig = AIR_QUALITY, buckets: int = BUCKETS) -> versions.Version:
    """Add the raw rows that the store lacks; returns the new version. ``buckets`` counts for a new store only."""
    spark, root = raw.sparkSession, root.rstrip("/")
    before = versions.latest(spark, root)
    rows = C.sentinel_to_null(C.project_and_rename(raw, cfg, ID), cfg.sensor_columns, cfg.sentinel)
    buckets = before.about["buckets"] if before else buckets
    loads, this = (before.about["loads"] if before else []), f"l{uuid.uuid4().hex[:16]}"
    columns = [c for c in rows.columns if c != ID] + [ID]
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in columns])
    if before and [f.simpleString() for f in _row_schema(before.about["schema"])] != [f.simpleString() for f in schema]:
        raise ValueError(f"the rows have other columns than those stored in {root}")
    with _bucketed(spark, root, schema, buckets) as name:
        if before:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            rows = unseen(rows, spark.table(name).filter(F.col(LOAD).isin(loads)))
        else:
            rows = rows.repartition(buckets, ID)
        rows.select(*columns, F.lit(this).alias(LOAD)).write.mode("append").insertInto(name)
    added = _rows(spark, root, schema, [this])
    sums = C.column_sums(added, cfg.sensor_columns, cfg.scale)
    if before:
        sums = add_sums(before.read(spark, "sums", sums.schema).unionByName(sums), ["column"])
    folder = versions.fresh_folder("sums")
    sums.coalesce(1).write.parquet(f"{root}/{folder}")
    about = {"loads": [*loads, this], "buckets": buckets, "schema": schema.json()}
    return versions.publish(spark, root, {"sums": [folder]}, about, after=before)


def _rows(spark: SparkSession, root: str, schema: T.StructType, loads: list[str]) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    return spark.read.schema(whole).parquet(f"{root}/rows").filter(F.col(LOAD).isin(loads)).drop(LOAD)  # prunes the folders


def read_processed(spark: SparkSession, root: str, cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    """The processed table of all loads: stored rows, gaps filled with today's means, timestamp and features."""
    root = root.rstrip("/")
    version = versions.latest(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing was loaded to {root}")
    rows = _rows(spark, root, _row_schema(version.about["schema"]), version.about["loads"])
    filled = C.fill_means(rows, cfg.sensor_columns, C.means_of_columns(version.read(spark, "sums"), cfg.sensor_columns))
    return C.add_time_features(C.parse_event_time(filled, cfg), cfg.event_time)
