"""Sums and roundings that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _exact(c: Column, scale: int) -> Column:
    """The value as a decimal; one that does not fit the scale (beyond the noise of its own last bits) raises."""
    exact = c.cast(f"decimal(28,{scale})")
    off = F.abs(c - exact.cast("double")) > F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs(c))
    return F.when(off, F.raise_error(F.concat(F.lit(f"more than {scale} decimal places: "), c.cast("string")))
                  .cast(f"decimal(28,{scale})")).otherwise(exact)


def exact_sums(c: Column, scale: int) -> list[Column]:
    """Aggregates ``total`` (decimal) and ``n`` of a column of at most ``scale`` decimal places."""
    return [F.sum(_exact(c, scale)).alias("total"), F.count(c).alias("n")]


def exact_mean(c: Column, scale: int) -> Column:
    """Mean of a column of at most ``scale`` decimal places, from an exact decimal sum.

    Any order of the rows gives the same double. A value that does not fit
    the scale raises instead of being cut.
    """
    return F.try_divide(F.sum(_exact(c, scale)).cast("double"), F.count(c).cast("double"))


# Sums of any doubles. A double of exponent e goes to bin floor(e / 32) as an integer multiple of the bin's
# unit 2^(32 bin - 54), in two parts of 43 bits; such integers add up exactly in any order.
BIN_BITS, SPARE_BITS, LOW_BITS = 32, 54, 43
POSITIVE, NEGATIVE = 40, 41  # bins of the infinities


def _times_power(c: Column, exponent: Column) -> Column:
    """c * 2^exponent in two steps, so that neither factor leaves the range of doubles."""
    half = F.floor(exponent / 2).cast("double")
    return c * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def _bin(c: Column) -> Column:
    size = F.abs(c)
    return (F.when(c == F.lit(float("inf")), POSITIVE).when(c == F.lit(float("-inf")), NEGATIVE)
            .when(c == 0.0, 0).otherwise(F.floor(F.log2(size) / BIN_BITS)).cast("int"))


def binned_sums(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, bin, high, low, n): the exact sum of ``value`` per key, in parts; NaN and null count as missing.

    One aggregate that combines map-side: at most 67 rows per key and task are shuffled. Works
    on streams too; :func:`combined` adds the parts of several such sums, :func:`means` makes doubles of them.
    """
    x = F.nanvl(F.col(value), F.lit(None).cast("double"))
    finite = F.abs(x) < F.lit(float("inf"))
    scaled = F.when(finite, _times_power(x, F.lit(SPARE_BITS) - F.col("bin") * BIN_BITS)).when(x.isNotNull(), 2.0 ** LOW_BITS * F.signum(x))
    high = F.floor(scaled / 2.0 ** LOW_BITS)
    low = (scaled - high.cast("double") * 2.0 ** LOW_BITS).cast("bigint")
    parts = df.withColumn("bin", _bin(x)).select(*keys, "bin", high.cast("decimal(20,0)").alias("high"),
                                                 low.cast("decimal(20,0)").alias("low"))
    return parts.groupBy(*keys, "bin").agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.count("high").alias("n"))


def combined(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Several :func:`binned_sums` put together (``union``) added up."""
    return sums.groupBy(*keys, "bin").agg(*[F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in ("high", "low", "n")])


def means(sums: DataFrame, keys: list[str], out: str) -> DataFrame:
    """(keys, out): the mean per key from :func:`binned_sums`, null without values.

    The bins (67 at most) are added from the largest down, each rounded once: the same bits in
    any order and partitioning of the rows, and what cancels inside a bin is gone.
    """
    carry = F.floor(F.col("low") / F.lit(2 ** LOW_BITS).cast("decimal(14,0)"))
    whole = (F.col("high") + carry).cast("double") * 2.0 ** LOW_BITS
    rest = (F.col("low") - carry * F.lit(2 ** LOW_BITS).cast("decimal(14,0)")).cast("double")
    part = F.struct((-F.col("bin")).alias("order"), _times_power(whole + rest, F.col("bin") * BIN_BITS - SPARE_BITS).alias("v"))
    filled = F.sort_array(F.collect_list(F.when(F.col("n") > 0, part)))
    total = F.aggregate(filled, F.lit(0.0), lambda acc, p: acc + p["v"])
    return sums.groupBy(*keys).agg(F.try_divide(total, F.sum("n").cast("double")).alias(out))


def part_sums(df: DataFrame, keys: list[str], value: str, scale: int | None) -> DataFrame:
    """What the mean of ``value`` per key is made of: a decimal sum with ``scale``, else :func:`binned_sums`."""
    if scale is None:
        return binned_sums(df, keys, value)
    return df.groupBy(*keys).agg(*exact_sums(F.col(value), scale))


def add_sums(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Several :func:`part_sums` in one frame, added up."""
    if "bin" in sums.columns:
        return combined(sums, keys)
    return sums.groupBy(*keys).agg(*[F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in ("total", "n")])


def mean_of_sums(sums: DataFrame, keys: list[str], out: str) -> DataFrame:
    """(keys, out) from :func:`part_sums`."""
    if "bin" in sums.columns:
        return means(sums, keys, out)
    return sums.select(*keys, F.try_divide(F.col("total").cast("double"), F.col("n").cast("double")).alias(out))


def round_half_up(c: Column, places: int = 6) -> Column:
    """Half-up rounding of the decimal value (12 places), for averages shown in results."""
    return F.round(c.cast("decimal(38,12)"), places).cast("double")


def round_averages(df: DataFrame, columns: list[str] | None = None, places: int = 6) -> DataFrame:
    """``df`` with the named columns (default: every double) rounded half-up."""
    chosen = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: round_half_up(F.col(f"`{c}`"), places) for c in chosen}) if chosen else df
