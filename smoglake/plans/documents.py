"""Document form of the processed table.

Replaces the collect-then-insert loader: the nested frame is written by the
executors as JSON lines (null fields omitted, as ``toJSON``) and read back with
the schema it was written with. Each type has one text form that restores it
(:data:`smoglake.sources.json_codec.TIME_FORMATS` for both kinds of timestamp,
to the microsecond); a value that the form cannot hold raises when it is
written, and text that does not restore a value raises when it is read. A document
store's Spark connector is a drop-in format name for
``write_documents``/``read_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType, TimestampNTZType

from ..config import AIR_QUALITY, SensorConfig
from ..sources import versions
from ..sources.json_codec import TIME_FORMATS

def document_schema(cfg: SensorConfig = AIR_QUALITY) -> StructType:
    return StructType([
        StructField(cfg.event_time, TimestampNTZType(), True),
        StructField("pollutants", StructType(
            [StructField(c, DoubleType(), True) for c in cfg.document_order]), True),
        StructField("time_features", StructType(
            [StructField(c, IntegerType(), True) for c in cfg.time_features]), True),
    ])


def nest(processed: DataFrame, cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    """Flat processed columns -> (event_timestamp, pollutants{}, time_features{}).

    The timestamp gets the schema's type: an instant becomes its wall-clock value in the session's time zone.
    """
    return processed.select(
        F.col(cfg.event_time).cast(TimestampNTZType()).alias(cfg.event_time),
        F.struct(*[F.col(c) for c in cfg.document_order]).alias("pollutants"),
        F.struct(*[F.col(c) for c in cfg.time_features]).alias("time_features"),
    )


def flatten(docs: DataFrame, cfg: SensorConfig = AIR_QUALITY) -> DataFrame:
    """Dotted paths back to flat columns in processed order."""
    sensors = [m.snake for m in cfg.measures]
    return docs.select(
        *[F.col(f"pollutants.{c}").alias(c) for c in sensors],
        F.col(cfg.event_time),
        *[F.col(f"time_features.{c}").alias(c) for c in cfg.time_features],
    )


def _holds(value: Column, kind: T.DataType) -> Column | None:
    """Whether the JSON form of the type holds the value; None if it holds all. The text has four digits for the year."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.year(value).between(1, 9999) | value.isNull()
    if isinstance(kind, T.StructType):
        parts = [p for f in kind.fields if (p := _holds(value.getField(f.name), f.dataType)) is not None]
        return _all(parts)
    if isinstance(kind, T.ArrayType):
        return None if _holds(value, kind.elementType) is None else F.coalesce(
            F.forall(value, lambda x: _holds(x, kind.elementType)), F.lit(True))
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise TypeError(f"documents have text keys: {kind.simpleString()}")
        return _holds(F.map_values(value), T.ArrayType(kind.valueType))
    if isinstance(kind, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        raise TypeError(f"no text form for {kind.simpleString()}")
    return None


def _all(parts: list[Column]) -> Column | None:
    out = None
    for p in parts:
        out = p if out is None else out & p
    return out


def checked(docs: DataFrame) -> DataFrame:
    """``docs``; a value that its JSON text would not restore raises. One projection."""
    out = {}
    for f in docs.schema.fields:
        fits = _holds(F.col(f"`{f.name}`"), f.dataType)
        if fits is not None:
            told = F.concat(F.lit(f"{f.name} does not fit its text form: "), F.col(f"`{f.name}`").cast("string"))
            out[f.name] = F.when(fits, F.col(f"`{f.name}`")).otherwise(F.raise_error(told).cast(f.dataType))
    return docs.withColumns(out) if out else docs


def write_documents(docs: DataFrame, path: str, fmt: str = "json", options: dict | None = None,
                    replace_with_empty: bool = False) -> bool:
    """K7 + P15: full refresh of the collection.

    JSON documents go to a new folder under ``path``, which replaces the old load by one commit
    (:mod:`smoglake.sources.versions`): readers see either load whole, and a load that fails
    changes nothing. Other formats (a store's connector) are saved as they are.

    An input without rows leaves the previous collection as it is (F5); a
    caller that wants it emptied says ``replace_with_empty``. The probe asks
    for one row, so give it a stored table and not an expensive plan.
    Returns whether anything was written.
    """
    if not replace_with_empty and docs.isEmpty():
        return False
    if fmt != "json":
        docs.write.mode("overwrite").format(fmt).options(**(options or {})).save(path)
        return True
    spark = docs.sparkSession
    before, folder = versions.latest(spark, path), versions.fresh_folder("documents")
    checked(docs).write.format(fmt).options(**{**TIME_FORMATS, **(options or {})}).save(f"{path}/{folder}")
    versions.publish(spark, path, {"documents": [folder]}, {"schema": docs.schema.json()}, after=before)
    return True


def read_documents(spark: SparkSession, path: str, cfg: SensorConfig = AIR_QUALITY,
                   fmt: str = "json") -> DataFrame:
    """Scan a document collection with the schema it was written with.

    A folder that :func:`write_documents` did not publish (an export of another tool) is read with
    the configuration's schema. Text that does not restore its field's type raises.
    """
    if fmt != "json":
        return spark.read.format(fmt).schema(document_schema(cfg)).load(path)
    import json

    found = versions.latest(spark, path)
    reader = spark.read.options(mode="FAILFAST", **TIME_FORMATS)
    if found is None:
        return reader.schema(document_schema(cfg)).json(path)
    return reader.schema(T.StructType.fromJson(json.loads(found.about["schema"]))).json(found.paths("documents"))
