"""Stored layouts: the day-partitioned history and key-bucketed views."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.operators.views import history_events
from playlens.plans import files
from playlens.sources.schema import FLAT_EVENT, HISTORY_COLUMNS, HISTORY_DERIVED

_PARQUET = {"compression": "zstd"}


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], mode: str = "append",
                      ) -> None:
    """Writes files of even size whatever the share of a partition value.

    `rebalance` lets adaptive execution split a large partition value over many
    tasks and join small ones, toward the advisory partition size.
    """
    (df.hint("rebalance", *[F.col(c) for c in partition_by])
       .write.mode(mode).options(**_PARQUET, partitionOverwriteMode="dynamic")
       .partitionBy(*partition_by).parquet(path))


# History folders: a day, then the batch that wrote the rows. Appends outside a stream share one
# batch number; a stream's batches have their own, from 0 on, merged folders one below that of appends.
HISTORY_FOLDERS = ["event_date", "batch_id"]
APPENDED = -1


def write_history(events: DataFrame, path: str, mode: str = "append",
                  batch_id: int = APPENDED) -> None:
    """Adds events to the history. With mode `overwrite` a batch replaces its own folders only."""
    rows = history_events(events).withColumn("batch_id", F.lit(batch_id))
    write_partitioned(rows, path, HISTORY_FOLDERS, mode)


def history_schema() -> T.StructType:
    known = {field.name: field for field in FLAT_EVENT.fields}
    derived = {"event_date": T.StructField("event_date", T.DateType()),
               "event_hour": T.StructField("event_hour", T.IntegerType())}
    return T.StructType([known.get(name) or derived[name]
                         for name in (*HISTORY_COLUMNS, *HISTORY_DERIVED)])


def read_history(spark: SparkSession, path: str, days: list[str] | None = None,
                 batches: list[int] | None = None) -> DataFrame:
    """The history; files written before a column was added give null for it.

    With `days` only the folders of these days are listed and read; days without one are empty. With
    `batches`, too, only these batches of theirs.
    """
    reader = spark.read.schema(history_schema())
    if days is None:
        return reader.parquet(path).drop("batch_id")
    folders = [f"{path}/event_date={day}" for day in days
               if files.exists(spark, f"{path}/event_date={day}")]
    if batches is not None:
        folders = [f"{folder}/batch_id={n}" for folder in folders for n in batches]
    if not folders:
        return spark.createDataFrame([], history_schema())
    return reader.option("basePath", path).parquet(*folders).drop("batch_id")


def history_days(spark: SparkSession, path: str) -> list[str]:
    """The days that have a folder, in order; rows without a date are in none of them."""
    named = [name.split("=", 1)[1] for name in files.children(spark, path)
             if name.startswith("event_date=")]
    return sorted(day for day in named if re.fullmatch(r"\d{4}-\d{2}-\d{2}", day))


def newest_day(spark: SparkSession, path: str) -> str | None:
    """The last day folder of a history, from folder names alone."""
    return max(history_days(spark, path), default=None)


def recent_history(spark: SparkSession, path: str, days: int = 1) -> DataFrame:
    """The newest days of a history; no other folder is read."""
    present = history_days(spark, path)
    oldest = str(datetime.date.fromisoformat(present[-1]) - datetime.timedelta(days=days - 1)) \
        if present else ""
    return read_history(spark, path, [day for day in present if day >= oldest])


def events_from_history(history: DataFrame) -> DataFrame:
    """Flat events again, payload measures read back from the payload text.

    For replaying a history through the operators that need them.
    """
    payload = F.from_json("payload_json", _payload_fields())
    parsed = history.select("*", F.explode(F.array(payload)).alias("p"))

    def when(types: tuple[str, ...], value: Column) -> Column:
        return F.when(F.col("event_type").isin(*types), value)

    stalls = ("REBUFFER_START", "REBUFFER_END")
    measures = {
        "seek_from_ms": F.col("p.fromPosition"), "seek_to_ms": F.col("p.toPosition"),
        "old_quality": F.col("p.oldQuality"), "new_quality": F.col("p.newQuality"),
        "new_bitrate": F.col("p.newBitrate"), "automatic": F.col("p.automatic"),
        "current_bitrate": F.col("p.currentBitrate"),
        "bandwidth_estimate": when(stalls, F.col("p.bandwidthEstimate")),
        "total_watch_time_ms": F.col("p.totalWatchTime"),
        "completion_percentage": F.col("p.completionPercentage"),
        "end_reason": when(("PLAYBACK_END",), F.col("p.reason")),
    }
    have = set(history.columns)
    return parsed.select(*[F.col(f.name) if f.name in have
                           else measures[f.name].cast(f.dataType).alias(f.name)
                           for f in FLAT_EVENT.fields])


def _payload_fields() -> T.StructType:
    """Union of the payload records' fields that the flat event carries."""
    long, text = T.LongType(), T.StringType()
    return T.StructType([T.StructField(name, kind) for name, kind in (
        ("fromPosition", long), ("toPosition", long), ("oldQuality", text),
        ("newQuality", text), ("newBitrate", long), ("automatic", T.BooleanType()),
        ("currentBitrate", long), ("bandwidthEstimate", long), ("totalWatchTime", long),
        ("completionPercentage", T.DoubleType()), ("reason", text))])


def key_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_keyed_view(view: DataFrame, path: str, key: str, order: list[str], buckets: int,
                     partitions: int | None = None) -> None:
    """Stores a view for key lookups: bucket folders, files sorted by key and order.

    Ranges are cut over (bucket, key, order), so the rows of a hot key fall into
    several files, each covering a stretch of the key's order.
    """
    placed = view.withColumn("bucket", key_bucket(F.col(key), buckets))
    ranges = ["bucket", key, *order]
    spread = (placed.repartitionByRange(partitions, *ranges) if partitions
              else placed.repartitionByRange(*ranges))
    (spread.sortWithinPartitions(*ranges).write.mode("overwrite")
           .options(**_PARQUET, partitionOverwriteMode="static")
           .partitionBy("bucket").parquet(path))


def read_key(spark: SparkSession, path: str, key: str, value: str, buckets: int) -> DataFrame:
    """The rows of one key: one bucket folder, and in it the matching row groups."""
    return (spark.read.parquet(path)
            .filter((F.col("bucket") == key_bucket(F.lit(value), buckets))
                    & (F.col(key) == value))
            .drop("bucket"))


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: list[str],
                 location: str) -> None:
    """Creates an external Parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{location}'")


def register_partitions(spark: SparkSession, name: str) -> None:
    """The catalog's partitions of a table become those of its folders."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
