"""Batch cleaning: raw sensor table -> processed table (C3 and its steps).

Each step is a public DataFrame -> DataFrame function, so the stepwise
inspection of the reference's notebook is a call per step. The whole chain
stays one Catalyst plan: one shuffle (the full-row distinct) plus one
single-row global aggregate for the means, read as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AIR_QUALITY, SensorConfig  # noqa: F401  (re-exported)
from ..functions.numbers import exact_mean, mean_of_sums, part_sums
from ..sources.tables import write_table
from .keys import content_id


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """A1: full-row distinct (nulls equal, NaNs equal, 0.0 = -0.0).

    Planned as a partial + final hash aggregate, so a hot duplicated row is
    collapsed on the map side before the shuffle.
    """
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop named columns; absent names are ignored."""
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by dictionary in one projection; absent names are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def sentinel_value(c: Column, sentinel: float) -> Column:
    """P10 column form: the sentinel becomes null; null and NaN pass unchanged."""
    return F.when(c != F.lit(sentinel), c)


def sentinel_to_null(df: DataFrame, columns: Iterable[str], sentinel: float | None) -> DataFrame:
    """P10 over a column list, one projection."""
    if sentinel is None:
        return df
    return df.withColumns({c: sentinel_value(F.col(c), sentinel) for c in columns})


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def _by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows of the named columns; NaN becomes null (decision Q9)."""
    named = F.array(*[F.struct(F.lit(c).alias("column"), nan_to_null(F.col(f"`{c}`").cast("double")).alias("value")) for c in columns])
    return df.select(F.explode(named).alias("x")).select("x.*")


def column_sums(df: DataFrame, columns: list[str], scale: int | None) -> DataFrame:
    """What every column's mean is made of, by column; sums of several loads can be added (:func:`add_sums`)."""
    return part_sums(_by_column(df, columns), ["column"], "value", scale)


def means_of_columns(sums: DataFrame, columns: list[str], prefix: str = "__mean_") -> DataFrame:
    """One row with every column's mean from :func:`column_sums`; 0.0 for a column without values."""
    by_column = mean_of_sums(sums, ["column"], "mean")
    return by_column.agg(*[F.coalesce(F.max(F.when(F.col("column") == c, F.col("mean"))), F.lit(0.0)).alias(prefix + c)
                           for c in columns])


def column_means(df: DataFrame, columns: list[str], prefix: str = "__mean_",
                 scale: int | None = None) -> DataFrame:
    """A2: one row with every column's mean.

    NaN counts as missing (decision Q9); an all-missing column gets 0.0. The
    mean does not depend on the order in which the cluster adds: with ``scale`` the sums are
    exact decimals, without it the exact binned sums of :mod:`smoglake.functions.numbers`.
    """
    if scale is None:
        return means_of_columns(column_sums(df, columns, None), columns, prefix)
    return df.agg(*[F.coalesce(exact_mean(nan_to_null(F.col(c)), scale), F.lit(0.0)).alias(prefix + c) for c in columns])


def fill_means(df: DataFrame, columns: list[str], means_row: DataFrame, prefix: str = "__mean_") -> DataFrame:
    """Fill null and NaN with the means of a one-row frame.

    The means are packed into a struct and attached to every row as a single scalar subquery: evaluated
    once per query, no driver round trip per column, no join and no unpartitioned window.
    """
    packed = "__means"
    row = means_row.select(F.struct(*[F.col(prefix + c).alias(c) for c in columns]))
    filled = {c: F.coalesce(nan_to_null(F.col(c)), F.col(packed).getField(c)) for c in columns}
    return df.withColumn(packed, row.scalar()).withColumns(filled).drop(packed)


def impute_mean(df: DataFrame, columns: list[str], scale: int | None = None) -> DataFrame:
    """A2 + P11: fill null and NaN with the column mean, in the same plan (one global aggregate, partial per task)."""
    return fill_means(df, columns, column_means(df, columns, scale=scale))


def event_time(date: Column, time: Column, fmt: str) -> Column:
    """P12 column form, zone-free; ``concat_ws`` skips nulls so a missing part -> null.

    The text is read as if at offset zero and the instant turned into the
    wall-clock value (TIMESTAMP_NTZ) by arithmetic, so neither the session's time
    zone nor a change of clocks touches the reading.
    """
    text = F.concat(F.concat_ws(" ", date, time), F.lit(" +00:00"))
    micros = F.unix_micros(F.try_to_timestamp(text, F.lit(fmt + " XXX")))
    seconds = (micros.cast("decimal(24,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def parse_event_time(df: DataFrame, cfg: SensorConfig = AIR_QUALITY, date_col: str | None = None,
                     time_col: str | None = None, drop_parts: bool = True) -> DataFrame:
    """Two string columns -> one timestamp, then drop the strings."""
    if cfg.timestamp_col is not None:
        out = df.withColumn(cfg.event_time, F.col(cfg.timestamp_col).cast("timestamp_ntz"))
        return out.drop(cfg.timestamp_col) if drop_parts and cfg.timestamp_col != cfg.event_time else out
    d = date_col or cfg.date_out
    t = time_col or cfg.time_out
    out = df.withColumn(cfg.event_time, event_time(F.col(d), F.col(t), cfg.timestamp_format))
    return out.drop(d, t) if drop_parts else out


def time_feature_columns(ts: Column) -> dict[str, Column]:
    """Year, month, day, day_of_week (1 = Sunday .. 7 = Saturday), hour_of_day."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "day_of_week": F.dayofweek(ts),
        "hour_of_day": F.hour(ts),
    }


def add_time_features(df: DataFrame, ts_col: str = "event_timestamp") -> DataFrame:
    return df.withColumns(time_feature_columns(F.col(ts_col)))


def project_and_rename(df: DataFrame, cfg: SensorConfig = AIR_QUALITY, id_col: str | None = None) -> DataFrame:
    """Steps 1-2 of C3: full-row distinct first (Q3), then drop and rename.

    With ``id_col``, each distinct raw row also gets a content id (unique
    because rows are distinct at that point); it survives the projection and
    identifies rows that become equal once columns are dropped.
    """
    distinct = drop_duplicates(df)
    extra = [c for c in df.columns if c not in cfg.raw_columns]  # part of what tells rows apart, not of the result
    if id_col:
        distinct = distinct.withColumn(id_col, content_id(df, df.columns))
    return rename_columns(drop_columns(distinct, [*cfg.dropped_columns, *extra]), cfg.renames)


def clean_and_transform(df: DataFrame, cfg: SensorConfig = AIR_QUALITY, id_col: str | None = None,
                        staging_path: str | None = None) -> DataFrame:
    """Distinct -> drop -> rename -> sentinel to null -> impute -> timestamp -> features.

    Order matters: the distinct runs on all columns of ``df`` before the projection,
    and the means are taken over deduplicated, non-missing values.

    Without ``staging_path`` this is one plan: the means branch reuses the
    distinct's shuffle files but repeats its reduce-side aggregation. With
    ``staging_path`` (a folder on shared storage) the deduplicated, nulled
    rows are written once; the means come from a columnar scan of just the
    sensor columns and the fill from a second scan. At large scale that
    halves the distinct's reduce work and cuts the lineage, so a lost
    executor never re-runs the distinct's shuffle.
    """
    renamed = project_and_rename(df, cfg, id_col)
    nulled = sentinel_to_null(renamed, cfg.sensor_columns, cfg.sentinel)
    if staging_path:
        nulled = write_table(nulled, staging_path)
    imputed = impute_mean(nulled, cfg.sensor_columns, cfg.scale)
    return add_time_features(parse_event_time(imputed, cfg), cfg.event_time)


def processed_columns(cfg: SensorConfig = AIR_QUALITY) -> list[str]:
    """Column order of the processed table (raw order, then time)."""
    sensors = [m.snake for m in cfg.measures]
    return sensors + [cfg.event_time, *cfg.time_features]
