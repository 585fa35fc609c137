"""Data-quality checks: null audit (F2, A10), key uniqueness (A11), filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def listwise_filter(df: DataFrame, columns: Sequence[str], sentinel: float | None) -> DataFrame:
    """keep rows whose every listed column differs from the sentinel.

    A null reading also drops the row (``null != x`` is not true), also where
    there is no sentinel. Simple comparisons, so Catalyst pushes them into the
    parquet scan.
    """
    cond = F.lit(True)
    for c in columns:
        cond = cond & (F.col(c).isNotNull() if sentinel is None else F.col(c) != F.lit(sentinel))
    return df.filter(cond)


def null_counts(df: DataFrame, columns: Sequence[str], stage: str) -> DataFrame:
    """F2 + A10 for one frame: (stage, column_name, null_count, row_count).

    One aggregate job computes every column's count; the result is unpivoted.
    """
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (agg.unpivot(["__rows"], list(columns), "column_name", "null_count")
               .select(F.lit(stage).alias("stage"), "column_name", "null_count",
                       F.col("__rows").alias("row_count")))


def null_audit(stages: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """null counts per column at several pipeline stages (after imputation: 0)."""
    frames = [null_counts(df, columns, name) for name, df in stages.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def key_violations(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """A11 for one node table: (label, nodes, violations).

    ``violations`` counts keys that occur more than once (a uniqueness
    constraint would reject them). Partial aggregation keeps skewed keys cheap.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("nodes"),
                       F.count_if(F.col("n") > 1).alias("violations")
                       ).select(F.lit(label).alias("label"), "nodes", "violations")


def key_check(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """A11 over several node tables: one row per label."""
    frames = [key_violations(df, keys, label) for label, (df, keys) in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """the distinct values of a column (e.g. pollutants of the long form)."""
    return df.select(column).distinct()


def value_subset(df: DataFrame, column: str, value) -> DataFrame:
    """the rows of one value of a column (e.g. one pollutant of the long form)."""
    return df.filter(F.col(column) == F.lit(value))
