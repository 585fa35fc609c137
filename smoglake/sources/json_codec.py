"""Row <-> JSON payload codec (P5, P6, X12): projections, no per-row Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

from ..config import AIR_QUALITY, SensorConfig


def raw_schema(cfg: SensorConfig = AIR_QUALITY) -> StructType:
    """The fixed raw-record schema, typed by the configuration: strings, timestamps, doubles otherwise."""
    def kind(c):
        return StringType() if c in cfg.string_columns else (
            TimestampNTZType() if c in cfg.timestamp_columns else DoubleType())

    return StructType([StructField(c, kind(c), True) for c in cfg.raw_columns])


#: Timestamps keep their microseconds both ways.
TIME_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def encode_json(df: DataFrame, column: str = "value", keep_nulls: bool = True) -> DataFrame:
    """P5: one JSON object per row in ``column``; null fields written as ``null``."""
    opts = {**TIME_FORMATS, **({"ignoreNullFields": "false"} if keep_nulls else {})}
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts).alias(column))


def decode_payload(payload: Column, schema: StructType) -> Column:
    """P6 column form: bytes/text -> struct, permissive (garbage -> all-null)."""
    return F.from_json(payload.cast("string"), schema, {"mode": "PERMISSIVE", **TIME_FORMATS})


def decode_json(df: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Decode a payload column and flatten it (``data.*``)."""
    return df.select(decode_payload(F.col(column), schema).alias("data")).select("data.*")
