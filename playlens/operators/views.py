"""Hot views: one projection of the event stream per access pattern.

Every view takes flat events, batch or streaming. Views whose key contains the
event id are plain projections; duplicates are dropped before them (see
`quality.deduplicated`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions import expr as X
from playlens.operators.ordered import latest_per_key
from playlens.sources.schema import (CONTINUE_MAX_PERCENT, CONTINUE_MIN_PERCENT,
                                     HISTORY_COLUMNS, HISTORY_DERIVED)

PROGRESS_TYPES = ("PLAY_START", "PROGRESS", "PAUSE", "SEEK", "PLAYBACK_END")
CONTINUE_TYPES = ("PROGRESS", "PAUSE", "PLAYBACK_END")
QUALITY_TYPES = ("QUALITY_CHANGE", "REBUFFER_START", "REBUFFER_END")


def _time() -> Column:
    return F.col("event_timestamp").alias("timestamp")


def _position() -> Column:
    return F.col("position_ms").alias("position")


def _duration() -> Column:
    return F.col("duration_ms").alias("duration")


def events_by_user(events: DataFrame) -> DataFrame:
    return events.select("user_id", _time(), "event_id", "event_type", "session_id", "content_id",
                         "title", _position(), _duration(),
                         X.device_or_unknown().alias("device_type"))


def events_by_session(events: DataFrame) -> DataFrame:
    return events.select("session_id", _time(), "event_id", "event_type", "user_id", "content_id",
                         "title", _position(), _duration(), "payload_json")


def events_by_content(events: DataFrame) -> DataFrame:
    return events.select("content_id", _time(), "user_id", "event_id", "event_type", "session_id",
                         _position(), X.device_or_unknown().alias("device_type"), "country")


def accepts_progress():
    return (X.is_type(*PROGRESS_TYPES) & F.col("position_ms").isNotNull()
            & (F.col("duration_ms") > 0))


def progress_log(events: DataFrame) -> DataFrame:
    """Every row that would update a resume position."""
    watch_time = F.when(X.is_type("PLAYBACK_END"),
                        F.coalesce("total_watch_time_ms", F.lit(0).cast("bigint")))
    return events.filter(accepts_progress()).select(
        "user_id", "content_id", "title", F.col("position_ms").alias("last_position"), _duration(),
        X.completion_percent().alias("completion_percentage"),
        F.col("event_timestamp").alias("last_watched"),
        watch_time.otherwise(F.lit(0).cast("bigint")).alias("total_watch_time"),
        "session_id", X.device_or_unknown().alias("device_type"), "country", "event_id")


def user_content_progress(events: DataFrame) -> DataFrame:
    """Resume position: the latest qualifying event per user and title."""
    return latest_per_key(progress_log(events), ["user_id", "content_id"],
                          ["last_watched", "event_id"]).drop("event_id")


def _continue_rows(events: DataFrame) -> DataFrame:
    return events.filter(
        X.is_type(*CONTINUE_TYPES) & F.col("position_ms").isNotNull()
        & F.col("duration_ms").isNotNull() & (F.col("duration_ms") != 0)
    ).select("user_id", F.col("event_timestamp").alias("last_watched"), "content_id", "title",
             F.col("position_ms").alias("last_position"), _duration(),
             X.completion_percent().alias("completion_percentage"), "event_id")


def _unfinished():
    return ((F.col("completion_percentage") >= CONTINUE_MIN_PERCENT)
            & (F.col("completion_percentage") < CONTINUE_MAX_PERCENT))


def accepts_continue_watching():
    percent = X.completion_percent()
    return (X.is_type(*CONTINUE_TYPES) & F.col("position_ms").isNotNull()
            & F.col("duration_ms").isNotNull() & (F.col("duration_ms") != 0)
            & (percent >= CONTINUE_MIN_PERCENT) & (percent < CONTINUE_MAX_PERCENT))


def continue_watching_log(events: DataFrame) -> DataFrame:
    """Unfinished views, one row per (user, time, title)."""
    return latest_per_key(_continue_rows(events).filter(_unfinished()),
                          ["user_id", "last_watched", "content_id"], ["event_id"]
                          ).drop("event_id")


def continue_watching_latest(events: DataFrame) -> DataFrame:
    """The list a user expects: latest state per title, finished titles gone."""
    latest = latest_per_key(_continue_rows(events), ["user_id", "content_id"],
                            ["last_watched", "event_id"])
    return latest.filter(_unfinished()).drop("event_id")


def accepts_quality():
    return X.is_type(*QUALITY_TYPES)


def quality_events(events: DataFrame) -> DataFrame:
    is_change = X.is_type("QUALITY_CHANGE")
    return events.filter(accepts_quality()).select(
        "content_id", X.event_date().alias("event_date"), _time(), "event_id", "event_type",
        "user_id", "session_id", X.device_or_unknown().alias("device_type"), "country",
        F.when(is_change, F.col("old_quality")).alias("old_quality"),
        F.when(is_change, F.col("new_quality")).alias("new_quality"),
        F.when(is_change, F.col("new_bitrate")).otherwise(F.col("bandwidth_estimate"))
         .alias("bitrate"),
        F.when(~is_change, F.col("rebuffer_duration_ms")).alias("rebuffer_duration"))


def history_events(events: DataFrame) -> DataFrame:
    """The history row: 18 stored columns plus the four derived ones."""
    return (events.withColumn("event_date", X.event_date())
                  .withColumn("event_hour", X.event_hour())
                  .select(*HISTORY_COLUMNS, *HISTORY_DERIVED))


def route_counts(events: DataFrame) -> DataFrame:
    """How many rows each of the six views takes, in one pass."""
    everything = F.lit(True)
    accepted = {
        "events_by_user": everything,
        "events_by_session": everything,
        "events_by_content": everything,
        "user_content_progress": accepts_progress(),
        "continue_watching": accepts_continue_watching(),
        "playback_quality_events": accepts_quality(),
    }
    counts = events.agg(*[F.count_if(rule).alias(name) for name, rule in accepted.items()])
    return counts.unpivot([], list(accepted), "table_name", "accepted_rows")


def progress_display(progress: DataFrame) -> DataFrame:
    return progress.select(
        "user_id", "content_id",
        X.minutes_seconds(F.col("last_position")).alias("position_text"),
        X.minutes_seconds(F.col("duration")).alias("duration_text"),
        X.remaining_ms().alias("remaining_ms"))


def continue_watching_display(rows: DataFrame) -> DataFrame:
    return rows.select(
        "user_id", "last_watched", "content_id", "title",
        X.minutes_seconds(F.col("last_position")).alias("position_text"),
        X.time_left(X.remaining_ms()).alias("remaining_text"))
