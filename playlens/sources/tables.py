"""Playback events and dimensions derived from the generic input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.sources.decode import flatten_events, nest_events

# Declared, so that no job runs just to infer them.
_EVENTS = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,"
           " props STRING")
_PART = "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT"
_CUSTOMER = "c_custkey BIGINT, c_mktsegment STRING"

# How a row of the generic `events` table reads as a playback event. Shares of
# the event types and the field formulas are fixed values of the test model.
_PLAYBACK_COLUMNS = """
  CAST(id AS STRING) AS event_id, source_type,
  CASE WHEN r < 30 THEN 'PROGRESS' WHEN r < 45 THEN 'PLAY_START' WHEN r < 55 THEN 'PAUSE'
       WHEN r < 65 THEN 'RESUME' WHEN r < 75 THEN 'SEEK' WHEN r < 85 THEN 'QUALITY_CHANGE'
       WHEN r < 90 THEN 'REBUFFER_START' WHEN r < 95 THEN 'REBUFFER_END'
       ELSE 'PLAYBACK_END' END AS event_type,
  event_timestamp, concat('user-', u) AS user_id,
  CASE WHEN u % 4 = 0 THEN NULL ELSE concat('profile-', u % 3) END AS profile_id,
  concat('device-', u) AS device_id,
  concat('s-', u, '-', date_format(event_timestamp, 'yyyyMMdd')) AS session_id,
  concat('content-', k % 40) AS content_id,
  CASE k % 4 WHEN 0 THEN 'movie' WHEN 1 THEN 'episode' WHEN 2 THEN 'documentary'
       ELSE NULL END AS content_type,
  CASE WHEN k % 10 = 0 THEN NULL ELSE concat('Title ', k % 40) END AS title,
  position_ms, duration_ms,
  CASE u % 7 WHEN 0 THEN 'IOS' WHEN 1 THEN 'ANDROID' WHEN 2 THEN 'WEB' WHEN 3 THEN 'SMART_TV'
       WHEN 4 THEN 'GAMING_CONSOLE' WHEN 5 THEN 'SET_TOP_BOX' ELSE NULL END AS device_type,
  CASE u % 7 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Web' WHEN 3 THEN 'Tizen'
       WHEN 4 THEN 'PlayStation OS' WHEN 5 THEN 'Roku OS' ELSE NULL END AS os_name,
  CASE WHEN u % 7 = 6 THEN NULL ELSE concat(u % 10, '.', u % 9) END AS os_version,
  CASE WHEN u % 7 = 6 THEN NULL WHEN u % 5 = 0 THEN 'US' WHEN u % 5 = 1 THEN 'GB'
       WHEN u % 5 = 2 THEN 'DE' WHEN u % 5 = 3 THEN 'FR' ELSE NULL END AS country,
  CASE WHEN u % 7 = 6 THEN NULL WHEN u % 3 = 0 THEN 'CA' ELSE 'NY' END AS region,
  CASE WHEN r >= 65 AND r < 75 THEN position_ms END AS seek_from_ms,
  CASE WHEN r >= 65 AND r < 75 THEN (id * 6007) % 3600000 END AS seek_to_ms,
  CASE WHEN r >= 75 AND r < 85 THEN element_at(qualities, CAST(id % 6 AS INT) + 1)
       END AS old_quality,
  CASE WHEN r >= 75 AND r < 85 THEN element_at(qualities, CAST((k + 1) % 6 AS INT) + 1)
       END AS new_quality,
  CASE WHEN r >= 75 AND r < 85 THEN 1000 + (id * 29) % 20000 END AS new_bitrate,
  CASE WHEN r >= 75 AND r < 85 THEN id % 2 = 0 END AS automatic,
  CASE WHEN r < 30 THEN 1000 + (id * 31) % 15000 END AS current_bitrate,
  CASE WHEN r >= 75 AND r < 85 THEN 1000 + (id * 29) % 20000
       WHEN r < 30 THEN 1000 + (id * 31) % 15000 END AS bitrate_kbps,
  CASE WHEN r >= 85 AND r < 95 THEN 1000 + (id * 53) % 20000 END AS bandwidth_estimate,
  CASE WHEN r >= 90 AND r < 95 AND id % 11 <> 0 THEN (id * 37) % 10000
       END AS rebuffer_duration_ms,
  CASE WHEN r >= 95 THEN (id * 7919) % 3600000 END AS total_watch_time_ms,
  CASE WHEN r >= 95 AND duration_ms > 0 THEN position_ms * 100.0D / duration_ms
       END AS completion_percentage,
  CASE WHEN r >= 95 THEN element_at(array('COMPLETED', 'USER_STOPPED', 'USER_EXIT', 'ERROR',
       'NETWORK_ERROR', 'APP_TERMINATED'), CAST(id % 6 AS INT) + 1) END AS end_reason
"""


def playback_events(spark: SparkSession, sf_dir: str, settled: bool = False) -> DataFrame:
    """Flat playback events over the whole `events` table.

    Times are instants in UTC: the table's zone-less column is read as UTC.
    `settled` computes position and duration once per row, for queries that
    filter on them: a generator keeps the filter from repeating their formulas.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id AS id", "CAST(ts AS TIMESTAMP) AS event_timestamp", "user_id AS u",
        "CAST(round(value * 100) AS BIGINT) AS v",
        # one number of a flat JSON object: the pattern is ten times cheaper than a parse
        r"""TRY_CAST(regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS BIGINT) AS k""",
        "event_id % 100 AS r", "event_type AS source_type")
    timed = base.withColumn("duration_ms", F.expr(
        "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 89 = 0 THEN 0"
        " ELSE 3600000 + (k % 40) * 60000 END"))
    placed = timed.withColumn("position_ms", F.expr(
        "CASE WHEN id % 101 = 0 THEN NULL ELSE (v * 7919) %"
        " (CASE WHEN duration_ms > 0 THEN duration_ms ELSE 3600000 END) END"))
    if settled:
        placed = placed.withColumn("t", F.explode(F.array(F.struct(
            "duration_ms", "position_ms")))).withColumns(
            {"duration_ms": F.col("t.duration_ms"), "position_ms": F.col("t.position_ms")})
    named = placed.withColumn("qualities", F.expr(
        "array('AUTO', 'SD_480P', 'HD_720P', 'HD_1080P', 'UHD_4K', 'UHD_8K')"))
    return spark.sql(f"SELECT {_PLAYBACK_COLUMNS} FROM {{named}}", named=named)


def with_payload_json(events: DataFrame) -> DataFrame:
    """Adds the payload text to flat events that come without one."""
    nested = nest_events(events)
    return flatten_events(nested)


def content_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per content id, from the whole `part` table."""
    part = spark.read.schema(_PART).parquet(f"{sf_dir}/part.parquet")
    return (part.groupBy(F.concat(F.lit("content-"), F.col("p_partkey") % 40).alias("content_id"))
                .agg(F.min("p_name").alias("catalog_title"),
                     F.min("p_type").alias("genre"),
                     F.max(F.col("p_size").cast("bigint") * 60000).alias("catalog_duration_ms")))


def content_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue over time, from the whole `part` table: a version per title and day of change."""
    part = spark.read.schema(_PART).parquet(f"{sf_dir}/part.parquet")
    days = F.col("p_partkey") % 28
    start = F.date_add(F.lit("2024-01-01").cast("date"), days.cast("int")).cast("timestamp")
    length = F.col("p_size").cast("bigint") * 60000
    return part.groupBy(F.concat(F.lit("content-"), F.col("p_partkey") % 40).alias("content_id"),
                        start.alias("valid_from")).agg(
        F.min("p_name").alias("catalog_title"), F.min("p_type").alias("genre"),
        F.max(length).alias("catalog_duration_ms"),
        (F.max(length) - F.call_function("div", F.min(length), F.lit(20))).alias("credits_ms"))


def device_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per device id, from the whole `customer` table."""
    customer = spark.read.schema(_CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    return customer.select(
        F.concat(F.lit("device-"), F.col("c_custkey")).alias("device_id"),
        F.col("c_mktsegment").alias("device_model"))
