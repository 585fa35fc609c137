"""Deterministic row identities (for reading nodes and other surrogate keys).

``monotonically_increasing_id`` depends on partitioning and is not stable
across recomputation, so ids here come from row content.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.json_codec import TIME_FORMATS


def _tagged(c: Column, kind: T.DataType) -> Column:
    """Text that differs whenever two values of the column differ, nulls included."""
    if isinstance(kind, T.TimestampType):
        text = F.unix_micros(c).cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(c)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        text = (c + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are equal
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(c), TIME_FORMATS)
    else:
        text = c.cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("n"))


def content_id(df: DataFrame, columns: Sequence[str]) -> Column:
    """32-byte SHA-256 over the named columns' values, each with its length, nulls marked.

    Rows that differ in any listed column get different ids (timestamps count
    to the microsecond), e.g. right after a full-row distinct, where it costs
    no extra shuffle.
    """
    parts = [_tagged(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def with_row_ids(df: DataFrame, id_col: str = "row_id", chunk_rows: int = 100_000) -> DataFrame:
    """A unique, deterministic id for every row, duplicates included.

    Identical rows are interchangeable, so the i-th copy of a content gets
    ``sha2(content_hash # i)``. Copies are counted with a map-side-combined
    aggregate; a content repeated very often is split into chunks of
    ``chunk_rows`` that are spread over tasks before the copies are
    regenerated, so no task emits an unbounded group.
    """
    cols = df.columns
    counted = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
                 .withColumn("__h", content_id(df, cols)))
    last_chunk = F.floor((F.col("__n") - 1) / F.lit(chunk_rows)).cast("long")
    chunks = counted.withColumn("__c", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    spread = chunks.repartition("__h", "__c")
    lo = F.col("__c") * chunk_rows + 1
    hi = F.least(F.col("__n"), (F.col("__c") + 1) * chunk_rows)
    copies = spread.withColumn("__k", F.explode(F.sequence(lo, hi)))
    return copies.select(*cols, F.unhex(F.sha2(F.concat(F.col("__h"), F.col("__k").cast("string").cast("binary")), 256))
                         .alias(id_col))
