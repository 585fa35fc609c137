"""Merge-upsert of keyed node tables (J6: MERGE ... ON CREATE SET)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_col: str | None = None) -> DataFrame:
    """One row per key: the one with the smallest ``order_col`` (or the smallest
    property tuple when no order is given), so the choice is deterministic.

    Implemented as ``min_by``/``min`` aggregates, which combine map-side: a hot
    key is reduced before the shuffle instead of being gathered in one task.
    """
    props = [c for c in df.columns if c not in keys]
    if not props:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c) for c in props])
    pick = F.min_by(packed, F.col(order_col)) if order_col else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("__p")).select(*keys, "__p.*")
    return out.drop(order_col) if order_col and order_col in out.columns else out


def new_on_create(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order_col: str | None = None) -> DataFrame:
    """What :func:`merge_on_create` adds: the first incoming row per whole key that ``existing`` lacks."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    fresh = first_per_key(incoming.filter(whole), keys, order_col)
    return fresh.join(existing.select(*keys), list(keys), "left_anti")


def merge_on_create(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                    order_col: str | None = None) -> DataFrame:
    """Insert keys that are absent; an existing key keeps its properties.

    Within ``incoming`` the first row per key (by ``order_col``) creates the
    node. Result: existing UNION (first incoming per key ANTI JOIN existing),
    with the properties of both (null where a side lacks one). A row with a
    null in its key is never inserted (a null key matches nothing, so it would
    come in again with every load); :func:`null_keys` counts such rows.
    """
    new = new_on_create(existing, incoming, keys, order_col)
    if order_col and order_col in existing.columns:
        existing = existing.drop(order_col)
    return existing.unionByName(new, allowMissingColumns=True)


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows have a null in their key (``null_keys``) of how many (``row_count``)."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.agg(F.count_if(missing).alias("null_keys"), F.count(F.lit(1)).alias("row_count"))
