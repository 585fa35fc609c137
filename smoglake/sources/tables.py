"""Parquet tables: raw / processed scans and idempotent overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (filters and projections are pushed by Catalyst)."""
    return spark.read.parquet(path)


def write_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K6: replace the table; writing twice leaves the same content as once.

    Optional ``partition_by`` (e.g. year, month) enables partition pruning on
    later time-range reads.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def load_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's generated tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """K6 then S2: overwrite ``path`` and return a scan of it.

    The scan reuses the schema just written, so no footer-reading job is
    launched to infer it (file sources read every column as nullable).
    """
    write_overwrite(df, path, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)
