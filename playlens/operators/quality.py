"""Data checks on an event set; each is one pass of conditional counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import expr as X
from playlens.sources.schema import DEVICE_TYPES, END_REASONS, EVENT_TYPES, VIDEO_QUALITIES

REQUIRED = ("event_id", "event_type", "event_timestamp", "user_id", "device_id", "session_id",
            "content_id")


def deduplicated(events: DataFrame) -> DataFrame:
    """One row per event id; on a stream, within the watermark."""
    if events.isStreaming:
        return events.dropDuplicatesWithinWatermark(["event_id"])
    return events.dropDuplicates(["event_id"])


def noisy_devices(events: DataFrame, limit: int, window: str = "1 minute",
                  slide: str | None = None) -> DataFrame:
    """Devices that sent more than `limit` events within a window, which may slide."""
    sent = events.groupBy("device_id", F.window("event_timestamp", window, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("events"))
    return sent.filter(F.col("events") > limit).select(
        "device_id", F.col("w.start").alias("window_start"), "events")


def rules() -> dict[str, Column]:
    """Rule name to the condition of a violation."""
    def not_in(column: str, allowed: tuple[str, ...]) -> Column:
        return F.col(column).isNotNull() & ~F.col(column).isin(*allowed)

    position, duration = F.col("position_ms"), F.col("duration_ms")
    found = {f"{name} present": F.col(name).isNull() for name in REQUIRED}
    found.update({
        "event_type known": not_in("event_type", EVENT_TYPES),
        "device_type known": not_in("device_type", DEVICE_TYPES),
        "quality known": not_in("old_quality", VIDEO_QUALITIES)
        | not_in("new_quality", VIDEO_QUALITIES),
        "end_reason known": not_in("end_reason", END_REASONS),
        "position in range": F.coalesce((position < 0) | (position > duration), F.lit(False)),
    })
    return found


def required_fields(events: DataFrame) -> DataFrame:
    """Rows checked and rows that break each rule."""
    checks = rules()
    names = list(checks)
    row = events.agg(F.count(F.lit(1)).alias("rows_checked"),
                     *[F.count_if(broken).alias(name) for name, broken in checks.items()])
    return row.unpivot(["rows_checked"], names, "rule", "violations")


def freshness(events: DataFrame, as_of: str, max_lag_minutes: float = 30.0) -> DataFrame:
    """Age of the newest event; no events at all is stale too."""
    newest = events.agg(F.max("event_timestamp").alias("latest_event"))
    lag = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("latest_event")) / 6e7
    return newest.withColumn("lag_minutes", lag).withColumn(
        "is_stale", F.coalesce(F.col("lag_minutes") > max_lag_minutes, F.lit(True)))


def hourly_volume(events: DataFrame) -> DataFrame:
    """Events per hour from the first to the last hour, empty hours as zero."""
    counted = events.groupBy(F.date_trunc("hour", "event_timestamp").alias("hour_start")).agg(
        F.count(F.lit(1)).alias("events"))
    edges = counted.agg(F.min("hour_start").alias("first"), F.max("hour_start").alias("last"))
    hours = edges.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))).alias("hour_start"))
    return hours.join(counted, "hour_start", "left").select(
        "hour_start", F.coalesce("events", F.lit(0).cast("bigint")).alias("events"))


def volume(events: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """Hours whose count strays from the mean of the 24 hours before.

    The window sees one row per hour of the history.
    """
    before = Window.partitionBy().orderBy("hour_start").rowsBetween(-24, -1)
    compared = hourly_volume(events).withColumn("expected", F.avg("events").over(before))
    strays = F.abs(F.col("events") - F.col("expected")) > tolerance * F.col("expected")
    return compared.withColumn("within_tolerance", ~F.coalesce(strays, F.lit(False)))


def null_rates(events: DataFrame) -> DataFrame:
    """Share of nulls of every column, in one pass."""
    names = events.columns
    row = events.agg(*[F.avg(F.col(name).isNull().cast("int")).alias(name) for name in names])
    return row.unpivot([], names, "column_name", "null_rate")


def scorecard(events: DataFrame) -> DataFrame:
    """Completeness of the required fields, accuracy over the rules, steady hours."""
    checks = required_fields(events)
    is_presence = F.col("rule").endswith(" present")
    passed = F.col("rows_checked") - F.col("violations")
    rated = checks.agg(
        (F.sum(F.when(is_presence, passed)) * 100.0
         / F.sum(F.when(is_presence, F.col("rows_checked")))).alias("completeness_percent"),
        (F.sum(passed) * 100.0 / F.sum("rows_checked")).alias("accuracy_percent"))
    steady = volume(events).agg(
        (F.avg(F.col("within_tolerance").cast("int")) * 100.0).alias("steady_hours_percent"))
    # two one-row results, each used as a scalar
    return rated.withColumn("steady_hours_percent", steady.scalar())


def reconcile(hot: DataFrame, cold: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key in two stores and whether they agree."""
    counted_hot = hot.groupBy(*keys).agg(F.count(F.lit(1)).alias("hot_rows"))
    counted_cold = cold.groupBy(*keys).agg(F.count(F.lit(1)).alias("cold_rows"))
    both = counted_hot.join(counted_cold, keys, "full_outer")
    status = (F.when(F.col("hot_rows").isNull(), "only_cold")
               .when(F.col("cold_rows").isNull(), "only_hot")
               .when(F.col("hot_rows") == F.col("cold_rows"), "match")
               .otherwise("differs"))
    return both.withColumn("status", status)
