"""Streaming sources and the event-time settings of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from playlens.sources.decode import accepted, decode_events
from playlens.sources.schema import FLAT_EVENT

# Out-of-orderness of the stream, and extra lateness a 5-minute
# window accepts. Spark has one bound per stream, so windows use their sum.
DISORDER = "30 seconds"
WINDOW_LATENESS = "90 seconds"

RAW_RECORD = T.StructType([T.StructField("value", T.StringType()),
                           T.StructField("timestamp", T.TimestampType())])


def kafka_records(spark: SparkSession, servers: str, topic: str, group: str,
                  options: dict[str, str] | None = None) -> DataFrame:
    """Raw records of a topic from the beginning; needs the Kafka package."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic,
                "startingOffsets": "earliest", "groupIdPrefix": group, **(options or {})}
    return spark.readStream.format("kafka").options(**settings).load()


def file_records(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Raw records from a folder of Parquet files with Kafka's value and timestamp."""
    reader = spark.readStream.schema(RAW_RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def file_events(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Flat events from a folder of Parquet files."""
    reader = spark.readStream.schema(FLAT_EVENT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def decoded_stream(records: DataFrame, fmt: str = "json", avro_schema: str | None = None
                   ) -> DataFrame:
    """Good events of a raw stream."""
    return accepted(decode_events(records, fmt, avro_schema))


def watermarked(events: DataFrame, delay: str = DISORDER) -> DataFrame:
    return events.withWatermark("event_timestamp", delay)
