"""Roll-up jobs: one hour, a range, daily after hourly."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators import quality, rollup
from playlens.plans import files
from playlens.plans.layout import read_history
from playlens.plans.replace import days_between, replace_scope

TARGETS = ("hourly", "daily", "all")
HOURLY_PARTITIONS = ["event_date", "event_hour"]
DAILY_PARTITIONS = ["event_date"]


def previous_hour(now: datetime.datetime) -> tuple[str, int]:
    """Date and hour a run at `now` (UTC) should process."""
    before = now - datetime.timedelta(hours=1)
    return str(before.date()), before.hour


def read_days(spark: SparkSession, path: str, start: str, end: str) -> DataFrame | None:
    """The rows of a day-partitioned table in [start, end]; only these days' folders are listed."""
    folders = [folder for day in days_between(start, end)
               if files.exists(spark, folder := f"{path}/event_date={day}")]
    return spark.read.option("basePath", path).parquet(*folders) if folders else None


def has_rows(spark: SparkSession, path: str, start: str, end: str) -> bool:
    """Whether a day-partitioned table exists and holds a row in [start, end]."""
    found = read_days(spark, path, start, end)
    return found is not None and not found.isEmpty()


def backfill_frames(history: DataFrame, start: str, end: str, target: str = "all"
                    ) -> dict[str, DataFrame]:
    """The roll-ups a backfill of [start, end] recomputes, daily built on hourly."""
    if target not in TARGETS:
        raise ValueError(f"target must be one of {TARGETS}")
    hourly = rollup.hourly_content_stats(history, start=start, end=end)
    frames = {"hourly": hourly, "daily": rollup.daily_content_stats(hourly)}
    return frames if target == "all" else {target: frames[target]}


def _processed(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp())


def run_hour(spark: SparkSession, history_path: str, out_path: str, date: str, hour: int = 0,
             table: str | None = None) -> int:
    """Recomputes one hour of the hourly table; 0 and no change without events.

    With `table` the catalog has a table of that name at the output."""
    if not has_rows(spark, history_path, date, date):
        return 0
    history = read_history(spark, history_path, [date])
    of_hour = history.filter((F.col("event_date") == F.lit(date).cast("date"))
                             & (F.col("event_hour") == hour))
    if of_hour.isEmpty():
        return 0
    stats = rollup.hourly_content_stats(history, date=date, hour=hour)
    return replace_scope(spark, _processed(stats), out_path, HOURLY_PARTITIONS,
                         [f"event_date={date}/event_hour={hour}"], table)


def backfill(spark: SparkSession, history_path: str, hourly_path: str, daily_path: str,
             start: str, end: str, target: str = "all", tables: dict[str, str] | None = None
             ) -> dict[str, int]:
    """Recomputes a date range; returns rows written per table.

    `tables` names the catalog's tables for `hourly` and `daily`, if they are to be there. The daily table is built from the stored hourly one, after it.
    """
    if target not in TARGETS:
        raise ValueError(f"target must be one of {TARGETS}")
    scope = [f"event_date={day}" for day in days_between(start, end)]
    written = {}
    if target in ("hourly", "all"):
        written["hourly"] = 0
        if has_rows(spark, history_path, start, end):
            stats = rollup.hourly_content_stats(
                read_history(spark, history_path, days_between(start, end)), start=start, end=end)
            written["hourly"] = replace_scope(spark, _processed(stats), hourly_path,
                                              HOURLY_PARTITIONS, scope,
                                              (tables or {}).get("hourly"))
    if target in ("daily", "all"):
        written["daily"] = 0
        hourly = read_days(spark, hourly_path, start, end)
        if hourly is not None and not hourly.isEmpty():
            written["daily"] = replace_scope(
                spark, _processed(rollup.daily_content_stats(hourly)), daily_path,
                DAILY_PARTITIONS, scope, (tables or {}).get("daily"))
    return written


def rebuild_and_swap(spark: SparkSession, history_path: str, new_path: str, view_name: str,
                     start: str, end: str) -> bool:
    """Rebuilds the hourly table beside the live one and moves a view to it in one statement.

    The view is one of the session catalog, which other sessions see. It moves only when every title
    and day of the new table adds up to the events of the history.
    """
    history = read_history(spark, history_path, days_between(start, end))
    stats = rollup.hourly_content_stats(history)
    replace_scope(spark, _processed(stats), new_path, HOURLY_PARTITIONS,
                  [f"event_date={day}" for day in days_between(start, end)])
    rebuilt = spark.read.parquet(new_path)
    keys = ["content_id", "event_date"]
    counted = rebuilt.groupBy(*keys).agg(F.sum("total_events").alias("rows_rebuilt"))
    expected = history.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_expected"))
    wrong = expected.join(counted, keys, "full_outer").filter(
        ~F.col("rows_expected").eqNullSafe(F.col("rows_rebuilt")))
    if not wrong.isEmpty():
        return False
    spark.sql(f"CREATE OR REPLACE VIEW {view_name} AS SELECT * FROM parquet.`{new_path}`")
    return True


def reconciles(hot: DataFrame, cold: DataFrame, keys: list[str]) -> bool:
    """Whether two stores hold the same number of rows for every key."""
    return quality.reconcile(hot, cold, keys).filter(F.col("status") != "match").isEmpty()
