"""Viewing sessions: events of a user with no gap longer than the limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import expr as X
from playlens.operators.ordered import interval_micros, time_span, with_previous

COUNTERS = ("total_events", "total_watch_time_ms", "completion_sum", "completion_count",
             "play_start_count", "pause_count", "seek_count", "error_count", "rebuffer_count",
             "total_rebuffer_duration_ms")


def _measures() -> list:
    end, rebuffer_end = X.is_type("PLAYBACK_END"), X.is_type("REBUFFER_END")
    completion = F.when(end, F.col("completion_percentage"))
    return [
        F.count(F.lit(1)).alias("total_events"),
        X.total(F.when(end, F.col("total_watch_time_ms")), "total_watch_time_ms"),
        F.coalesce(F.sum(completion), F.lit(0.0)).alias("completion_sum"),
        F.count(completion).alias("completion_count"),
        X.count_of(X.is_type("PLAY_START"), "play_start_count"),
        X.count_of(X.is_type("PAUSE"), "pause_count"),
        X.count_of(X.is_type("SEEK"), "seek_count"),
        X.count_of(X.is_error_end(), "error_count"),
        X.count_of(rebuffer_end, "rebuffer_count"),
        X.total(F.when(rebuffer_end, F.col("rebuffer_duration_ms")),
                "total_rebuffer_duration_ms"),
    ]


def user_sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a finished set of events.

    Two events in the same span of `gap` length can never be in different
    sessions, so events are first summed per (user, span, title, device) by a
    hash aggregate with map-side combine. Only the spans of a user, at most one
    per gap length of history, meet in one window; event rows never do.
    """
    summed = events.groupBy(
        "user_id", time_span("event_timestamp", gap).alias("span"), "content_id", "device_type"
    ).agg(F.min("event_timestamp").alias("first_at"), F.max("event_timestamp").alias("last_at"),
          *_measures())

    spans = summed.groupBy("user_id", "span").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    by_time = Window.partitionBy("user_id").orderBy("span")
    silence = (F.unix_micros("first_at") - F.unix_micros(F.lag("last_at").over(by_time)))
    opens = silence.isNull() | (silence > interval_micros(gap))
    starts = (spans.withColumn("opened_at", F.when(opens, F.col("first_at")))
                   .select("user_id", "span",
                           F.last("opened_at", ignorenulls=True).over(by_time)
                            .alias("session_start")))

    per_title = summed.join(starts, ["user_id", "span"]).groupBy(
        "user_id", "session_start", "content_id"
    ).agg(F.max("last_at").alias("last_at"),
          F.min(F.struct("first_at", "device_type")).alias("opening"),
          *[F.sum(name).alias(name) for name in COUNTERS])
    per_session = per_title.groupBy("user_id", "session_start").agg(
        F.max("last_at").alias("session_end"),
        F.min("opening").alias("opening"),
        F.count("content_id").alias("content_count"),
        *[F.sum(name).alias(name) for name in COUNTERS])
    return shape(per_session.withColumn("device_type", F.col("opening.device_type")))


def user_sessions_stream(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """The same sessions from a watermarked stream, emitted once they close.

    Needs append mode. State per open session is one row and the set of titles
    seen in it.
    """
    opening = F.min(F.struct(F.col("event_timestamp").alias("at"), "device_type"))
    per_session = events.groupBy(
        "user_id", F.session_window("event_timestamp", gap).alias("session")
    ).agg(F.max("event_timestamp").alias("session_end"),
          F.min("event_timestamp").alias("session_start"),
          opening.alias("opening"),
          F.size(F.collect_set("content_id")).cast("bigint").alias("content_count"),
          *_measures())
    return shape(per_session.withColumn("device_type", F.col("opening.device_type")))


def session_id_of(user: str, start: str):
    return F.concat_ws("-", F.col(user), F.unix_millis(start).cast("string"))


def shape(sessions: DataFrame) -> DataFrame:
    average = F.when(F.col("completion_count") > 0,
                     F.col("completion_sum") / F.col("completion_count")).otherwise(0.0)
    return sessions.select(
        "user_id", "session_start", session_id_of("user_id", "session_start").alias("session_id"),
        "device_type",
        (F.unix_millis("session_end") - F.unix_millis("session_start"))
        .alias("session_duration_ms"),
        "content_count", "total_events", "total_watch_time_ms",
        average.alias("avg_completion_percentage"),
        "play_start_count", "pause_count", "seek_count", "error_count", "rebuffer_count",
        "total_rebuffer_duration_ms")


def session_starts_by_lag(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Session starts found event by event; a second way to the same borders."""
    rows = events.select("user_id", "event_timestamp", "event_id")
    chained = with_previous(rows, ["user_id"], "event_timestamp", "event_id",
                            ["event_timestamp"])
    silence = F.unix_micros("event_timestamp") - F.unix_micros("prev.event_timestamp")
    opens = F.col("prev").isNull() | (silence > interval_micros(gap))
    return chained.filter(opens).select(
        "user_id", F.col("event_timestamp").alias("session_start"),
        session_id_of("user_id", "event_timestamp").alias("session_id"))
