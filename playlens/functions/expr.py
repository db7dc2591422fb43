"""Scalar expressions shared by the operators; all stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlens.sources.schema import COMPLETED_PERCENT, ERROR_REASONS


def is_type(*names: str) -> Column:
    column = F.col("event_type")
    return column == names[0] if len(names) == 1 else column.isin(*names)


def count_of(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def total(value: Column | str, name: str) -> Column:
    """Sum that is 0, not null, when nothing was summed."""
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint")).alias(name)


def safe_ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Division that gives `default` where the denominator is not positive."""
    fallback = F.lit(default).cast("double")
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(fallback)


def int_div(numerator: Column, denominator: int | Column) -> Column:
    """Integer quotient, truncated."""
    divisor = F.lit(denominator) if isinstance(denominator, int) else denominator
    return F.call_function("div", numerator, divisor)


def device_or_unknown() -> Column:
    return F.coalesce("device_type", F.lit("UNKNOWN"))


def device_class() -> Column:
    device = F.col("device_type")
    return (F.when(device.isin("IOS", "ANDROID"), "mobile")
             .when(device == "WEB", "desktop")
             .when(device.isin("SMART_TV", "SET_TOP_BOX", "GAMING_CONSOLE"), "tv")
             .otherwise("other"))


def completion_percent() -> Column:
    """Payload value on PLAYBACK_END when there is one, else position / duration."""
    computed = F.when(F.col("duration_ms") > 0,
                      F.col("position_ms") * F.lit(100.0) / F.col("duration_ms"))
    return (F.when(is_type("PLAYBACK_END"), F.coalesce("completion_percentage", computed))
             .otherwise(computed))


def event_date(ts: str = "event_timestamp") -> Column:
    return F.to_date(ts)


def event_hour(ts: str = "event_timestamp") -> Column:
    return F.hour(ts)


def is_error_end() -> Column:
    return is_type("PLAYBACK_END") & F.coalesce(F.col("end_reason").isin(*ERROR_REASONS),
                                                F.lit(False))


def is_completed_end() -> Column:
    return is_type("PLAYBACK_END") & F.coalesce(
        F.col("completion_percentage") >= COMPLETED_PERCENT, F.lit(False))


def minutes_seconds(ms: Column) -> Column:
    """`m:ss`; minutes run on past 60."""
    seconds = int_div(ms, 1000)
    return F.format_string("%d:%02d", int_div(seconds, 60), seconds % 60)


def remaining_ms() -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.col("duration") - F.col("last_position"))


def time_left(ms: Column) -> Column:
    """`1h 5m left` from one hour up, else `5m left`."""
    seconds = int_div(ms, 1000)
    hours = F.format_string("%dh %dm left", int_div(seconds, 3600),
                            int_div(seconds % 3600, 60))
    return F.when(seconds >= 3600, hours).otherwise(
        F.format_string("%dm left", int_div(seconds, 60)))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
