"""Display of small results (K11) and the empty-input guard.

Data for charts is written as tables by the jobs; nothing is pulled to the
driver here but the few rows that are printed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 5, truncate: bool = False) -> None:
    """Print the first ``n`` rows (never ``show(count())`` on a big frame)."""
    df.show(n, truncate=truncate)


def is_empty(df: DataFrame) -> bool:
    """empty-input guard without counting the whole frame."""
    return df.isEmpty()
