"""Kafka topic source and sink (S4, K1, K2 on a topic).

The Kafka connector jar is not on this image's classpath, so these builders
are exercised only up to plan construction; ``stream_ingest`` feeds the same
decode step from a file stream of payloads instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .json_codec import decode_json, encode_json


def kafka_source(spark: SparkSession, brokers: str, topic: str,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Subscribe to a topic. ``startingOffsets`` only matters on first start."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", brokers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def decoded_topic(spark: SparkSession, brokers: str, topic: str, schema: StructType,
                  starting_offsets: str = "latest") -> DataFrame:
    """C2 read side: topic -> typed rows."""
    return decode_json(kafka_source(spark, brokers, topic, starting_offsets), schema)


def publish(df: DataFrame, brokers: str, topic: str) -> None:
    """K1 (batch): every row as one JSON record, written by the executors.

    Replaces the reference's collect-and-sleep producer loop; pacing, when
    wanted, belongs to the consumer (``maxOffsetsPerTrigger``).
    """
    (encode_json(df).write.format("kafka")
     .option("kafka.bootstrap.servers", brokers).option("topic", topic).save())
