"""Keyed reads: what the read API answers, as filters on a view.

Each takes a view and one key. On a view stored by `plans.layout` the filter
reaches the key's bucket folder and row groups only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.operators.ordered import first_rows_per_key, latest_per_key, rows_since
from playlens.sources.schema import DEFAULT_CONTINUE_LIMIT, DEFAULT_EVENT_LIMIT


def continue_watching(view: DataFrame, user: str, limit: int = DEFAULT_CONTINUE_LIMIT
                      ) -> DataFrame:
    return (view.filter(F.col("user_id") == user)
                .orderBy(F.desc("last_watched"), "content_id").limit(limit))


def progress(view: DataFrame, user: str, content: str) -> DataFrame:
    """At most one row; empty when the user never started the title."""
    return view.filter((F.col("user_id") == user) & (F.col("content_id") == content))


def all_progress(view: DataFrame, user: str) -> DataFrame:
    return view.filter(F.col("user_id") == user).orderBy("content_id")


def user_events(view: DataFrame, user: str, limit: int = DEFAULT_EVENT_LIMIT) -> DataFrame:
    return (view.filter(F.col("user_id") == user)
                .orderBy(F.desc("timestamp"), "event_id").limit(limit))


def session_events(view: DataFrame, session: str) -> DataFrame:
    return view.filter(F.col("session_id") == session).orderBy("timestamp", "event_id")


def content_events(view: DataFrame, content: str, limit: int = DEFAULT_EVENT_LIMIT) -> DataFrame:
    return (view.filter(F.col("content_id") == content)
                .orderBy(F.desc("timestamp"), "user_id", "event_id").limit(limit))


def content_metrics(view: DataFrame, content: str, limit: int = DEFAULT_EVENT_LIMIT
                    ) -> DataFrame:
    return (view.filter(F.col("content_id") == content)
                .orderBy(F.desc("window_start")).limit(limit))


def quality_events(view: DataFrame, content: str, date: str) -> DataFrame:
    return view.filter(
        (F.col("content_id") == content) & (F.col("event_date") == F.lit(date).cast("date"))
    ).orderBy(F.desc("timestamp"), "event_id")


def user_sessions(view: DataFrame, user: str, limit: int = DEFAULT_EVENT_LIMIT) -> DataFrame:
    return (view.filter(F.col("user_id") == user)
                .orderBy(F.desc("session_start"), "session_id").limit(limit))


def continue_watching_top(view: DataFrame, n: int = DEFAULT_CONTINUE_LIMIT) -> DataFrame:
    """The list of every user at once."""
    return first_rows_per_key(view, ["user_id"], [F.desc("last_watched"), F.asc("content_id")], n)


def user_timeline_top(view: DataFrame, n: int = DEFAULT_EVENT_LIMIT) -> DataFrame:
    return first_rows_per_key(view, ["user_id"], [F.desc("timestamp"), F.asc("event_id")], n)


def smart_resume(progress_view: DataFrame) -> DataFrame:
    """Where playback should resume.

    Fixed values: finished from 90 %, a view under two minutes starts over,
    otherwise ten seconds are given back and the prompt is shown.
    """
    finished = F.col("completion_percentage") >= 90.0
    too_short = F.col("last_position") < 120_000
    start_over = F.coalesce(finished, F.lit(False)) | too_short
    zero = F.lit(0).cast("bigint")
    return progress_view.select(
        "user_id", "content_id", "last_position", "completion_percentage",
        F.coalesce(finished, F.lit(False)).alias("is_completed"),
        F.when(start_over, zero).otherwise(F.col("last_position") - 10_000)
         .alias("resume_position"),
        (~start_over).alias("show_prompt"))


def active_sessions(events: DataFrame, as_of: str, hours: int = 4) -> DataFrame:
    """Users whose newest event is at most `hours` old and not an end of playback.

    Only the recent rows are read: an older event cannot be the newest one of a
    user who has a recent one.
    """
    now = F.lit(as_of).cast("timestamp")
    recent = rows_since(events, now - F.expr(f"INTERVAL {int(hours)} HOURS")).filter(
        F.col("event_timestamp") <= now)
    rows = recent.select("user_id", "session_id", "content_id", "event_type", "position_ms",
                         F.col("event_timestamp").alias("last_event_at"), "event_id")
    newest = latest_per_key(rows, ["user_id"], ["last_event_at", "event_id"])
    return newest.filter(F.col("event_type") != "PLAYBACK_END").drop("event_id")
