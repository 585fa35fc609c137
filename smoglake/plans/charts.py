"""Chart tables, one part per pollutant.

A profile is written in one pass, partitioned by pollutant; a refresh replaces the parts of the
pollutants that it has and leaves the others. A chart reads its pollutant's part only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BY = "Pollutant"


def write_charts(profile: DataFrame, path: str, by: str = BY) -> None:
    """Replace the parts of ``path`` that ``profile`` has rows of; one job, other parts stay."""
    profile.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def read_chart(spark: SparkSession, path: str, member: str | None = None, by: str = BY) -> DataFrame:
    """One member's chart table (F3; the scan lists and reads its folder only), or all of them."""
    table = spark.read.schema(_text_key(spark, path, by)).parquet(path)
    return table if member is None else table.filter(F.col(by) == member).drop(by)


def _text_key(spark: SparkSession, path: str, by: str):
    """The stored schema with the key as text (a member named like a number stays text)."""
    from pyspark.sql import types as T

    found = spark.read.parquet(path).schema
    return T.StructType([T.StructField(f.name, T.StringType() if f.name == by else f.dataType) for f in found.fields])
