"""Aggregation queries over the document form (C6, C10 data sets).

All grouping keys have tiny cardinality (7 weekdays, 24 hours), so each query
is a partial + final hash aggregate: every map task ships at most one row per
key, however skewed the key distribution. The weekday lookup is a 7-row
literal (a proven size bound) and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import hour_label, literal_table, weekday_lookup_rows


def daily_profile(docs: DataFrame, spark: SparkSession | None = None,
                  measures: tuple[str, ...] = ("carbon_monoxide", "benzene", "nitrogen_dioxide"),
                  day_field: str = "time_features.day_of_week") -> DataFrame:
    """A3 + J1 + O1: average per weekday code, null code kept as its own group.

    Output: Day, avg_<measure>..., day_name; sorted by Day with null first.
    """
    spark = spark or docs.sparkSession
    agg = docs.groupBy(F.col(day_field).alias("Day")).agg(
        *[F.avg(F.col(f"pollutants.{m}")).alias(f"avg_{m}") for m in measures])
    lookup = literal_table(spark, ["Day", "day_name"], weekday_lookup_rows())
    return (agg.join(F.broadcast(lookup), on="Day", how="left")
               .orderBy(F.col("Day").asc_nulls_first()))


def hourly_top(docs: DataFrame, k: int = 5, measure: str = "carbon_monoxide",
               hour_field: str = "time_features.hour_of_day") -> DataFrame:
    """A4 + O2 + P17 + P19 + X7: the k hours with the highest average.

    Ties on the average are broken by the smaller hour so the limit is
    deterministic; null averages sort last. Planned as TakeOrderedAndProject.
    """
    agg = docs.groupBy(F.col(hour_field).alias("hour")).agg(
        F.avg(F.col(f"pollutants.{measure}")).alias("avg"),
        F.max(F.col(f"pollutants.{measure}")).alias("peak"))
    top = agg.orderBy(F.col("avg").desc_nulls_last(), F.col("hour").asc_nulls_last()).limit(k)
    return top.select(hour_label(F.col("hour")).alias("hour_of_day"),
                      F.col("avg").alias(f"avg_{measure}"),
                      F.col("peak").alias(f"peak_{measure}"))


def hourly_top_long(top: DataFrame, measure: str = "carbon_monoxide",
                    labels: tuple[str, str, str] = ("Hour of Day", "Avg CO", "Peak CO")) -> DataFrame:
    """P20 + R5 + O8: chart labels, then melt to (hour, Metric, Level)."""
    hour, avg_label, peak_label = labels
    wide = top.select(F.col("hour_of_day").alias(hour),
                      F.col(f"avg_{measure}").alias(avg_label),
                      F.col(f"peak_{measure}").alias(peak_label))
    return (wide.unpivot([hour], [avg_label, peak_label], "Metric", "Level")
                .orderBy(F.col(f"`{hour}`"), "Metric"))
