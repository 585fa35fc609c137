"""Scalar label functions (X7-X11) as built-in Column expressions.

Lookups are literal arrays indexed with ``element_at`` (no join, no UDF);
a code outside the array, or null, gives null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LEGACY_WEEKDAY_NAMES, MONTH_NAMES, WEEKDAY_DISPLAY_ORDER, WEEKDAY_NAMES


def hour_label(hour: Column) -> Column:
    """``HH:00``; a null hour stays null (``format_string`` would give 'null:00')."""
    return F.when(hour.isNotNull(), F.format_string("%02d:00", hour))


def _lookup(code: Column, names: Sequence[str]) -> Column:
    arr = F.array(*[F.lit(n) for n in names])
    return F.when(code.between(1, len(names)), F.element_at(arr, code.cast("int")))


def month_name(month: Column) -> Column:
    """Month number 1..12 -> English name."""
    return _lookup(month, MONTH_NAMES)


def weekday_name(code: Column, legacy: bool = False) -> Column:
    """Dayofweek code 1..7 -> name.

    ``legacy=True`` reproduces the shipped graph loader's labels, which map
    code 1 (Sunday) to 'Monday' (quirk Q1).
    """
    return _lookup(code, LEGACY_WEEKDAY_NAMES if legacy else WEEKDAY_NAMES)


def weekday_order(name: Column) -> Column:
    """X11: weekday name -> display position 1..7 (Monday first); 0 if unknown."""
    return F.array_position(F.array(*[F.lit(n) for n in WEEKDAY_DISPLAY_ORDER]), name).cast("int")


def weekday_lookup_rows(legacy: bool = False) -> list[tuple[int, str]]:
    """The literal (code, name) rows of the weekday lookup table."""
    names = LEGACY_WEEKDAY_NAMES if legacy else WEEKDAY_NAMES
    return [(i + 1, n) for i, n in enumerate(names)]


def literal_table(spark, columns: Sequence[str], rows: Sequence[tuple]):
    """A small constant table built JVM-side (``inline`` of a literal
    array, planned as a local relation), with no Python-side RDD."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
