"""Shared helpers: word pattern, hold-out rule, batch maps and staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .tokens import encoder

#: Rows of an Arrow batch that ``map_columns`` turns into Python objects at a time.
ROWS_AT_ONCE = 512
#: Bytes of an Arrow batch sent to a worker inside ``small_batches``, and the setting that limits them.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

#: A word: a maximal run of anything but space, tab, newline, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """The words as UTF-8: ``bytes.split`` parts at the same six characters as ``WORD``."""
    return text.encode().split() if text else []


def id_remainder(id_col: str, mod: int) -> Column:
    """crc32(id as text) mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


def load_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: what follows scans files, so a lost executor never
    re-runs what made them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of about ``BATCH_BYTES`` for maps of long texts that are run inside.

    Without that a batch holds 10,000 rows, whatever their length, once as a
    growing buffer of the executor and once in the worker. A limit that the
    session sets itself is kept.
    """
    if spark.conf.get(BATCH_LIMIT, None) is not None:
        yield
        return
    spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_LIMIT)


def map_columns(df: DataFrame, inputs: list[str], outputs: list[T.StructField],
                fn: Callable[..., list], carry: list[str] | None = None, tokens: bool = False) -> DataFrame:
    """``carry`` columns of ``df`` plus ``outputs`` = ``fn(*input lists)`` per at most ``ROWS_AT_ONCE`` rows of an Arrow batch.

    ``fn`` gets one Python list per input column and returns one list (or
    numpy array) per output field. Columns travel under positional names, so
    names that clash with the outputs do no harm inside the batch; the
    result has ``carry`` followed by the output names. Rows are never
    regrouped, so the map needs no shuffle. A worker serves one stage after the
    other: maps that do not encode ``tokens`` first drop its cache of them.
    """
    carry = list(df.columns if carry is None else carry)
    fields = [df.schema[c] for c in carry]
    sent = df.select([F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(carry)]
                     + [F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([T.StructField(f"k{i}", f.dataType, True) for i, f in enumerate(fields)]
                          + [T.StructField(f"y{i}", f.dataType, True) for i, f in enumerate(outputs)])
    n_keep, n_in = len(carry), len(inputs)
    kinds = [f.dataType for f in outputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        if not tokens:
            encoder.cache_clear()
        arrow = [to_arrow_type(k) for k in kinds]
        for b in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
            made = fn(*[b.column(n_keep + i).to_pylist() for i in range(n_in)])
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(n_keep)] + [pa.array(v, t) for v, t in zip(made, arrow, strict=True)],
                names=[f"k{i}" for i in range(n_keep)] + [f"y{i}" for i in range(len(arrow))])

    return sent.mapInArrow(run, schema).toDF(*carry, *[f.name for f in outputs])


def ranked(df: DataFrame, order: list[str], out: str, name: str) -> DataFrame:
    """``df`` plus ``out``: each row's place from 0 in the order of ``order`` over the whole frame.

    Rows are dealt by range, sorted and numbered inside each partition and
    written; then the partitions' counts (a row per partition) are summed up
    and added. No task sees more than its range; Spark merges neighbouring
    ranges of few bytes, so that few rows make few files. ``order`` should tell rows
    apart; rows that tie get places in no fixed order.
    """
    place = F.monotonically_increasing_id()
    rows = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumns({"_part": F.spark_partition_id(), "_place": place.bitwiseAND((1 << 33) - 1)}), name)
    counts = rows.groupBy("_part").count()
    before = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    return rows.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + F.col("_place")).drop(
        "_part", "_place", "_before")


def hash_sample(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of their id (all rows if there are no more).

    For fitting models only. One count of the id column sets the share.
    """
    n = df.select(id_col).count()
    share = min(1.0, rows / n) if n else 1.0
    spot = F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.lit(1 << 30))
    return df.filter(spot < int(share * (1 << 30)) + (share == 1.0))


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows.

    Beyond that it is returned as it is and the join shuffles. Give it a
    written table, so that counting does not run its plan a second time.
    """
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


LONG, DOUBLE, STRING, INT, BOOL, BINARY = (T.LongType(), T.DoubleType(), T.StringType(),
                                           T.IntegerType(), T.BooleanType(), T.BinaryType())
