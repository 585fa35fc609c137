"""Wide <-> long reshapes and per-group min-max normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str],
            name_col: str = "pollutant", value_col: str = "reading") -> DataFrame:
    """Unpivot ``{label: column}`` into (ids..., name_col, value_col).

    Equivalent to ``stack(n, 'label', col, ...)``; works on batch and stream
    frames and keeps null readings (one output row per input row and label).
    """
    labelled = df.select(*[F.col(c) for c in ids],
                         *[F.col(c).alias(label) for label, c in columns.items()])
    return labelled.unpivot(list(ids), list(columns), name_col, value_col)


def stack_expr(columns: Mapping[str, str], name_col: str = "pollutant",
               value_col: str = "reading") -> str:
    """The SQL ``stack`` generator form of :func:`to_long`."""
    pairs = ", ".join(f"'{label}', `{c}`" for label, c in columns.items())
    return f"stack({len(columns)}, {pairs}) as ({name_col}, {value_col})"


def min_max_normalize(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      out_col: str = "normalized") -> DataFrame:
    """A7 + P21: ``(x - min) / (max - min)`` with min/max over the group.

    Meant for already-aggregated input (one row per group member), where a
    group holds a bounded number of rows (24 hours, 7 weekdays). A zero
    range gives null rather than NaN or an ANSI error (decision Q8).
    """
    w = Window.partitionBy(*group_cols)
    lo, hi = F.min(value_col).over(w), F.max(value_col).over(w)
    return df.withColumn(out_col, F.try_divide(F.col(value_col) - lo, hi - lo))


def normalize_by_join(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      out_col: str = "normalized") -> DataFrame:
    """A7 without a window: per-group min/max aggregate joined back.

    Suited to inputs whose groups are large; the group table has one row per
    group and is joined on the group key.
    """
    stats = df.groupBy(*group_cols).agg(F.min(value_col).alias("__lo"), F.max(value_col).alias("__hi"))
    return (df.join(stats, list(group_cols))
              .withColumn(out_col, F.try_divide(F.col(value_col) - F.col("__lo"), F.col("__hi") - F.col("__lo")))
              .drop("__lo", "__hi"))


def collect_unwind_normalize(df: DataFrame, group_col: str, member_col: str, value_col: str,
                             out_col: str = "normalized") -> DataFrame:
    """R4 literal form: collect the group's (member, value) list with its
    min and max, then unwind the list again and normalise each entry.

    Same result as :func:`min_max_normalize`; kept to mirror the graph
    query's ``collect``/``UNWIND`` shape. Input is aggregated (bounded lists).
    """
    grouped = df.groupBy(group_col).agg(
        F.collect_list(F.struct(F.col(member_col).alias("m"), F.col(value_col).alias("v"))).alias("items"),
        F.min(value_col).alias("lo"), F.max(value_col).alias("hi"))
    unwound = grouped.select(group_col, "lo", "hi", F.inline("items"))
    return unwound.select(
        F.col(group_col), F.col("m").alias(member_col), F.col("v").alias(value_col),
        F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")).alias(out_col))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str],
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Pandas-style melt."""
    return df.unpivot(list(ids), list(values), var_name, value_name)


def pivot_matrix(df: DataFrame, index: str, columns: str, values: str,
                 column_values: Sequence, check_unique: bool = True) -> DataFrame:
    """One row per ``index``, one column per listed ``columns`` value.

    The column values are given explicitly, so no extra job discovers them.
    A value that is not listed raises, as does a duplicate (index, column)
    pair when ``check_unique`` (as a pandas pivot does).
    """
    v: Column = F.first(values)
    if check_unique:
        v = F.when(F.count(F.lit(1)) > 1,
                   F.raise_error(F.lit(f"duplicate {index}/{columns} pair in pivot")).cast("double")
                   ).otherwise(F.first(values))
    known = F.col(columns).isin(list(column_values)) | F.col(columns).isNull()
    checked = F.when(known, F.col(columns)).otherwise(
        F.raise_error(F.concat(F.lit("value without a column in pivot: "), F.col(columns).cast("string"))))
    return df.withColumn(columns, checked).groupBy(index).pivot(columns, list(column_values)).agg(v)
