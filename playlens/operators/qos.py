"""Quality of service: rebuffering, start-up, stability, errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions import expr as X
from playlens.operators.ordered import global_ranks, rows_since, with_previous


def _measures() -> list[Column]:
    return [
        X.total(F.when(X.is_type("REBUFFER_END"), F.col("rebuffer_duration_ms")), "rebuffer_ms"),
        X.total(F.when(X.is_type("PLAYBACK_END"), F.col("total_watch_time_ms")), "play_ms"),
        X.count_of(X.is_type("REBUFFER_END"), "rebuffer_count"),
        F.avg("bitrate_kbps").alias("avg_bitrate_kbps"),
    ]


def _rebuffer_ratio() -> Column:
    return X.safe_ratio(F.col("rebuffer_ms"), F.col("play_ms"), None)


def qos_by(events: DataFrame, *keys: Column | str) -> DataFrame:
    """Rebuffer time over play time; null where nothing was played."""
    return events.groupBy(*keys).agg(*_measures()).withColumn(
        "rebuffer_ratio", _rebuffer_ratio())


def qos_by_content(events: DataFrame) -> DataFrame:
    return qos_by(events, "content_id")


def qos_by_device(events: DataFrame) -> DataFrame:
    return qos_by(events, X.device_or_unknown().alias("device_type"))


def qos_by_region(events: DataFrame) -> DataFrame:
    return qos_by(events, "country", "region")


def qos_realtime(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """The latest window: one row per title and one, marked ALL, for everything.

    The newest event time is a scalar subquery, so the main scan reads only the
    rows of that window. Give it `layout.recent_history` on a large history: then
    the subquery, too, reads the newest day only.
    """
    newest = events.agg(F.max("event_timestamp").alias("at"))
    start = newest.select(F.window("at", window)["start"].alias("start")).scalar()
    current = rows_since(events, start)
    return (current.rollup("content_id")
                   .agg(*_measures(), F.countDistinct("user_id").alias("viewers"),
                        F.grouping("content_id").alias("is_total"))
                   .select(F.when(F.col("is_total") == 1, "ALL").otherwise(F.col("content_id"))
                            .alias("content_id"),
                           "viewers", "rebuffer_ms", "play_ms", "rebuffer_count",
                           "avg_bitrate_kbps", _rebuffer_ratio().alias("rebuffer_ratio")))


def time_to_first_frame(events: DataFrame) -> DataFrame:
    """First PROGRESS after the first PLAY_START, per session and title.

    Events of one moment are ordered by id. Two aggregates: the first start of every key, then the
    first PROGRESS behind it.
    """
    keys = ["session_id", "content_id"]
    order = F.struct("event_timestamp", "event_id")
    starts = events.filter(X.is_type("PLAY_START")).groupBy(*keys).agg(
        F.min(order).alias("start"))
    shown = events.filter(X.is_type("PROGRESS")).select(*keys, order.alias("at"))
    begun = starts.select(*[F.col(key).alias(f"start_{key}") for key in keys], "start")
    after = shown.join(begun, [F.col(key).eqNullSafe(F.col(f"start_{key}")) for key in keys]
                       + [F.col("at") > F.col("start")])
    return after.groupBy(*keys).agg(
        F.min("start.event_timestamp").alias("started_at"),
        F.min("at.event_timestamp").alias("first_frame_at")).withColumn(
        "first_frame_ms", F.unix_millis("first_frame_at") - F.unix_millis("started_at"))


def pause_durations(events: DataFrame) -> DataFrame:
    """Length of each pause: a RESUME that directly follows a PAUSE of its session."""
    rows = events.filter(X.is_type("PAUSE", "RESUME")).select(
        "session_id", "user_id", "event_timestamp", "event_id", "event_type")
    chained = with_previous(rows, ["session_id"], "event_timestamp", "event_id",
                            ["event_type", "event_timestamp"])
    return chained.filter(
        X.is_type("RESUME") & (F.col("prev.event_type") == "PAUSE")
    ).select("session_id", "user_id", F.col("event_id").alias("resume_event_id"),
             F.col("prev.event_timestamp").alias("paused_at"),
             F.col("event_timestamp").alias("resumed_at"),
             (F.unix_millis("event_timestamp") - F.unix_millis("prev.event_timestamp"))
             .alias("pause_ms"))


def quality_stability(events: DataFrame) -> DataFrame:
    """Quality changes per hour watched and the share made by the player itself."""
    change = X.is_type("QUALITY_CHANGE")
    per_title = events.groupBy("content_id").agg(
        X.count_of(change, "quality_changes"),
        X.count_of(change & F.coalesce("automatic", F.lit(False)), "automatic_changes"),
        X.total(F.when(X.is_type("PLAYBACK_END"), F.col("total_watch_time_ms")), "play_ms"))
    return per_title.select(
        "*",
        X.safe_ratio(F.col("quality_changes") * 3600000.0, F.col("play_ms"), None)
         .alias("changes_per_hour"),
        X.safe_ratio(F.col("automatic_changes"), F.col("quality_changes"), None)
         .alias("automatic_share"))


def error_rates(events: DataFrame) -> DataFrame:
    """Error ends and sessions that had one, per country."""
    per_session = events.groupBy("country", "session_id").agg(
        X.count_of(X.is_type("PLAYBACK_END"), "ends"),
        X.count_of(X.is_error_end(), "error_ends"))
    per_country = per_session.groupBy("country").agg(
        F.sum("ends").alias("play_ends"), F.sum("error_ends").alias("error_ends"),
        F.count("session_id").alias("sessions"),
        X.count_of(F.col("error_ends") > 0, "failed_sessions"))
    return per_country.select(
        "*", X.safe_ratio(F.col("error_ends"), F.col("play_ends"), None).alias("error_rate"),
        X.safe_ratio(F.col("sessions") - F.col("failed_sessions"), F.col("sessions"), None)
         .alias("session_success_rate"))


def content_health(events: DataFrame) -> DataFrame:
    """Titles ranked by rebuffering, errors and completion; 1 is the worst."""
    per_title = events.groupBy(F.coalesce("content_id", F.lit("")).alias("title"),
                               F.col("content_id").isNull().alias("untitled")).agg(
        *_measures(), X.count_of(X.is_type("PLAYBACK_END"), "ends"),
        X.count_of(X.is_error_end(), "error_ends"),
        X.count_of(X.is_completed_end(), "completed"))
    rates = per_title.select(
        "title", "untitled",
        X.safe_ratio(F.col("rebuffer_ms"), F.col("play_ms")).alias("rebuffer_ratio"),
        X.safe_ratio(F.col("error_ends"), F.col("ends")).alias("error_rate"),
        X.safe_ratio(F.col("completed"), F.col("ends")).alias("completion_rate"))
    ranked = global_ranks(rates, ["title", "untitled"], {
        "rebuffer_ratio": True, "error_rate": True, "completion_rate": False})
    names = {"rebuffer_ratio_rank": "rebuffer_rank", "error_rate_rank": "error_rank",
             "completion_rate_rank": "completion_rank"}
    summed = ranked.withColumnsRenamed(names).withColumn(
        "rank_sum", sum((F.col(n) for n in list(names.values())[1:]), F.col("rebuffer_rank")))
    return global_ranks(summed, ["title", "untitled"], {"rank_sum": False}).select(
        F.when(~F.col("untitled"), F.col("title")).alias("content_id"), "rebuffer_ratio",
        "error_rate", "completion_rate", *names.values(), "rank_sum",
        F.col("rank_sum_rank").alias("health_rank"))
