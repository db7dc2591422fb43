"""Event statistics and engagement reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import expr as X


def event_overview(events: DataFrame) -> DataFrame:
    """Totals and distinct counts over everything.

    Rows are reduced per (user, session, title) first; the three distinct counts
    then work on those.
    """
    reduced = events.groupBy("user_id", "session_id", "content_id").agg(
        F.count(F.lit(1)).alias("events"), F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"))
    return reduced.agg(
        F.sum("events").alias("total_events"),
        F.countDistinct("user_id").alias("unique_users"),
        F.countDistinct("session_id").alias("unique_sessions"),
        F.countDistinct("content_id").alias("unique_content"),
        F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))


def event_type_share(events: DataFrame) -> DataFrame:
    """Events per type with the percentage of all; the window sees one row per type."""
    counted = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    everything = F.sum("event_count").over(Window.partitionBy())
    share = F.round(F.col("event_count") * 100.0 / everything, 2)
    return counted.withColumn("percentage", share).orderBy(F.desc("event_count"), "event_type")


def device_analytics(events: DataFrame) -> DataFrame:
    return events.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"),
        F.round(F.avg("bitrate_kbps"), 0).alias("avg_bitrate")
    ).orderBy(F.desc("events"), "device_type")


def hourly_traffic(events: DataFrame) -> DataFrame:
    return events.groupBy(X.event_hour().alias("event_hour")).agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("unique_users")
    ).orderBy("event_hour")


def top_content(events: DataFrame, n: int = 10) -> DataFrame:
    return events.groupBy("content_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        X.count_of(X.is_type("PLAY_START"), "play_starts"),
        F.countDistinct("user_id").alias("unique_viewers"),
        F.round(F.avg("bitrate_kbps"), 0).alias("avg_bitrate")
    ).orderBy(F.desc("play_starts"), "content_id").limit(n)


def rebuffer_top(events: DataFrame, n: int = 10) -> DataFrame:
    stalls = events.filter(X.is_type("REBUFFER_START", "REBUFFER_END"))
    return stalls.groupBy("content_id").agg(
        F.count(F.lit(1)).alias("rebuffer_events"),
        F.avg("rebuffer_duration_ms").alias("avg_rebuffer_ms"),
        F.max("rebuffer_duration_ms").alias("max_rebuffer_ms")
    ).filter(F.col("rebuffer_events") > 0).orderBy(
        F.desc("rebuffer_events"), "content_id").limit(n)


def event_counters(events: DataFrame) -> DataFrame:
    """Processing counters; both rebuffer types share one counter."""
    counters = {
        "events_processed": F.count(F.lit(1)),
        "play_starts": F.count_if(X.is_type("PLAY_START")),
        "playback_ends": F.count_if(X.is_type("PLAYBACK_END")),
        "pauses": F.count_if(X.is_type("PAUSE")),
        "seeks": F.count_if(X.is_type("SEEK")),
        "rebuffers": F.count_if(X.is_type("REBUFFER_START", "REBUFFER_END")),
        "quality_changes": F.count_if(X.is_type("QUALITY_CHANGE")),
        "errors": F.count_if(X.is_error_end()),
    }
    row = events.agg(*[value.alias(name) for name, value in counters.items()])
    return row.unpivot([], list(counters), "counter", "value")


def business_totals(events: DataFrame) -> DataFrame:
    """Totals for the business board; seconds are cut per event, then summed."""
    seconds = F.call_function("div", F.col("total_watch_time_ms"), F.lit(1000))
    return events.agg(
        X.count_of(X.is_type("PLAY_START"), "playbacks_started"),
        X.count_of(X.is_completed_end(), "playbacks_completed"),
        X.total(F.when(X.is_type("PLAYBACK_END"), seconds), "watch_time_seconds"),
        X.total(F.when(X.is_type("REBUFFER_END"), F.col("rebuffer_duration_ms")),
                "rebuffer_duration_ms"))


def percentiles_of(df: DataFrame, measures: dict[str, Column],
                   points: tuple[int, ...] = (50, 95, 99)) -> DataFrame:
    """Exact percentiles of several integer measures: the smallest value that at
    least the given percentage of the rows does not exceed.

    Rows are counted per distinct value first, so the running count that locates
    a percentile goes over distinct values, not over rows.
    """
    names = list(measures)
    tall = (df.select(*[value.cast("bigint").alias(name) for name, value in measures.items()])
              .unpivot([], names, "measure", "value").filter(F.col("value").isNotNull()))
    counted = tall.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("measure").orderBy("value")
    whole = Window.partitionBy("measure")
    ranked = (counted.withColumn("seen", F.sum("n").over(upto))
                     .withColumn("all", F.sum("n").over(whole)))
    at = [F.min(F.when(F.col("seen") * 100 >= F.col("all") * percent, F.col("value")))
           .alias(f"p{percent:02d}") for percent in points]
    return ranked.groupBy("measure").agg(
        F.sum("n").alias("samples"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean_value"), *at)


SKETCH_SIZE = 400  # k of the quantile sketches: a rank is off by about 0.5 % at most


def distribution_sketches(events: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """A mergeable quantile sketch per day, title and measure; null values are left out."""
    tall = events.select(X.event_date().alias("event_date"), "content_id", F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), value.cast("bigint").alias("value"))
        for name, value in measures.items()])).alias("m")).select(
        "event_date", "content_id", "m.*").filter(F.col("value").isNotNull())
    return tall.groupBy("event_date", "content_id", "measure").agg(
        F.kll_sketch_agg_bigint("value", F.lit(SKETCH_SIZE)).alias("sketch"))


def bitrate_sketches(events: DataFrame) -> DataFrame:
    """Sketches of the measures of `bitrate_distribution`."""
    return distribution_sketches(events, {
        "bitrate_kbps": F.col("bitrate_kbps"), "progress_bitrate_kbps": F.col("current_bitrate"),
        "switched_bitrate_kbps": F.col("new_bitrate")})


def merged_distribution(sketches: DataFrame, keys: list[str] | None = None,
                        points: tuple[int, ...] = (5, 25, 50, 75, 95)) -> DataFrame:
    """Approximate percentiles of any range of stored sketches, per measure and `keys`.

    `percentiles_of` has the exact ones.
    """
    merged = sketches.groupBy("measure", *(keys or [])).agg(
        F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return merged.select(
        "measure", *(keys or []), F.kll_sketch_get_n_bigint("sketch").alias("samples"),
        *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(p / 100)).alias(f"approx_p{p:02d}")
          for p in points])


def session_distribution(sessions: DataFrame) -> DataFrame:
    def whole(column: str, unit: int) -> Column:
        return F.call_function("div", F.col(column), F.lit(unit))

    return percentiles_of(sessions, {
        "duration_seconds": whole("session_duration_ms", 1000),
        "events": F.col("total_events"),
        "contents": F.col("content_count"),
        "watch_seconds": whole("total_watch_time_ms", 1000),
    })


def window_distribution(metrics: DataFrame) -> DataFrame:
    views = F.col("view_count")
    rate = F.when(views > 0, F.call_function("div", F.col("completed_views") * 100,
                                             F.greatest(views, F.lit(1))))
    return percentiles_of(metrics, {
        "views": views,
        "unique_viewers": F.col("unique_viewers"),
        "watch_minutes": F.call_function("div", F.col("total_watch_time_ms"), F.lit(60000)),
        "completion_rate_percent": rate,
    })


def completion_distribution(events: DataFrame) -> DataFrame:
    """Completion at the end of playback, cut to whole percent."""
    percent = F.when(X.is_type("PLAYBACK_END"), F.col("completion_percentage").cast("bigint"))
    return percentiles_of(events.filter(X.is_type("PLAYBACK_END")),
                          {"completion_percent": percent})


def bitrate_distribution(events: DataFrame) -> DataFrame:
    quality = F.col("bitrate_kbps")
    return percentiles_of(events.filter(quality.isNotNull()), {
        "bitrate_kbps": quality,
        "progress_bitrate_kbps": F.col("current_bitrate"),
        "switched_bitrate_kbps": F.col("new_bitrate"),
    }, (5, 25, 50, 75, 95))


def _completion(events: DataFrame, key: Column | str) -> DataFrame:
    ends, completed = X.is_type("PLAYBACK_END"), X.is_completed_end()
    counted = events.groupBy(key).agg(
        X.count_of(X.is_type("PLAY_START"), "play_starts"),
        X.count_of(ends, "play_ends"), X.count_of(completed, "completed"),
        F.avg(F.when(ends, F.col("completion_percentage"))).alias("avg_completion_percentage"))
    return counted.withColumn(
        "completion_rate", X.safe_ratio(F.col("completed"), F.col("play_ends"), None))


def completion_by_device(events: DataFrame) -> DataFrame:
    return _completion(events, X.device_or_unknown().alias("device_type"))


def completion_by_content(events: DataFrame) -> DataFrame:
    return _completion(events, "content_id")


def device_behaviour(events: DataFrame) -> DataFrame:
    """How viewing differs between mobile, desktop and TV."""
    per_class = events.groupBy(X.device_class().alias("device_class")).agg(
        X.count_of(X.is_type("PLAY_START"), "views"),
        X.count_of(X.is_type("PAUSE"), "pauses"),
        X.count_of(X.is_type("SEEK"), "seeks"),
        X.total(F.when(X.is_type("PLAYBACK_END"), F.col("total_watch_time_ms")),
                "watch_time_ms"),
        F.countDistinct("user_id").alias("viewers"))
    views = F.col("views")
    return per_class.select(
        "*", X.safe_ratio(F.col("pauses"), views).alias("pauses_per_view"),
        X.safe_ratio(F.col("seeks"), views).alias("seeks_per_view"),
        X.safe_ratio(F.col("watch_time_ms") / 60000.0, views).alias("watch_minutes_per_view"))


def engagement_by_hour(events: DataFrame) -> DataFrame:
    """Views, viewers and watch time per hour of day, with the rank by watch time."""
    hourly = events.groupBy(X.event_hour().alias("event_hour")).agg(
        X.count_of(X.is_type("PLAY_START"), "views"),
        F.countDistinct("user_id").alias("viewers"),
        X.total(F.when(X.is_type("PLAYBACK_END"), F.col("total_watch_time_ms")),
                "watch_time_ms"))
    # 24 rows at most
    return hourly.withColumn("engagement_rank", F.rank().over(
        Window.partitionBy().orderBy(F.desc("watch_time_ms"))))


def title_viewers_day(events: DataFrame) -> DataFrame:
    """Who watched a title in a day: distinct viewers per title and date."""
    return events.groupBy("content_id", X.event_date().alias("event_date")).agg(
        F.countDistinct("user_id").alias("viewers"),
        X.count_of(X.is_type("PLAY_START"), "views"))


def seek_patterns(events: DataFrame) -> DataFrame:
    """Forward and backward skips per title and their mean length."""
    distance = F.col("seek_to_ms") - F.col("seek_from_ms")
    seeks = events.filter(X.is_type("SEEK"))
    return seeks.groupBy("content_id").agg(
        F.count(F.lit(1)).alias("seeks"),
        X.count_of(distance > 0, "forward_seeks"),
        X.count_of(distance < 0, "backward_seeks"),
        F.avg(F.when(distance > 0, distance)).alias("avg_forward_ms"),
        F.avg(F.when(distance < 0, -distance)).alias("avg_backward_ms"))


PERIODS = ("day", "week", "month", "quarter")


def period_report(events: DataFrame) -> DataFrame:
    """Daily, weekly, monthly and quarterly summaries, viewers counted exactly.

    Events are summed per (day, user) once; only those sums are repeated for the
    four periods.
    """
    daily = events.groupBy(X.event_date().alias("event_date"), "user_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        X.count_of(X.is_type("PLAY_START"), "play_starts"),
        X.count_of(X.is_completed_end(), "completed_views"),
        X.total(F.when(X.is_type("PLAYBACK_END"), F.col("total_watch_time_ms")),
                "watch_time_ms"),
        X.total(F.when(X.is_type("REBUFFER_END"), F.col("rebuffer_duration_ms")),
                "rebuffer_ms"))
    tagged = daily.withColumn("slot", F.explode(F.array(*[
        F.struct(F.lit(period).alias("period"),
                 F.to_date(F.date_trunc(period, "event_date")).alias("period_start"))
        for period in PERIODS])))
    return tagged.groupBy(F.col("slot.period").alias("period"),
                          F.col("slot.period_start").alias("period_start")).agg(
        F.sum("total_events").alias("total_events"),
        F.countDistinct("user_id").alias("unique_users"),
        F.sum("play_starts").alias("play_starts"),
        F.sum("completed_views").alias("completed_views"),
        F.sum("watch_time_ms").alias("watch_time_ms"),
        F.sum("rebuffer_ms").alias("rebuffer_ms"))


def user_features(events: DataFrame, as_of: str) -> DataFrame:
    """Per-user features for models: recency, frequency, time, habits."""
    per_day = events.groupBy("user_id", "content_id", "session_id", "device_type",
                             X.event_date().alias("event_date")).agg(
        F.max("event_timestamp").alias("last_event"),
        F.count(F.lit(1)).alias("total_events"),
        X.count_of(X.is_type("PLAY_START"), "play_starts"),
        X.count_of(X.is_completed_end(), "completed_views"),
        X.count_of(X.is_type("PLAYBACK_END"), "play_ends"),
        X.total(F.when(X.is_type("PLAYBACK_END"), F.col("total_watch_time_ms")),
                "watch_time_ms"),
        X.count_of(X.is_type("REBUFFER_START"), "rebuffers"))
    per_user = per_day.groupBy("user_id").agg(
        F.max("last_event").alias("last_event"),
        F.countDistinct("event_date").alias("active_days"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("content_id").alias("contents"),
        F.countDistinct("device_type").alias("device_types"),
        *[F.sum(name).alias(name) for name in
          ("total_events", "play_starts", "completed_views", "play_ends", "watch_time_ms",
           "rebuffers")])
    recency = F.datediff(F.lit(as_of).cast("date"), F.to_date("last_event"))
    return per_user.select(
        "user_id", recency.alias("recency_days"), "active_days", "sessions", "contents",
        "device_types", "total_events", "play_starts", "completed_views", "watch_time_ms",
        "rebuffers",
        X.safe_ratio(F.col("completed_views"), F.col("play_ends")).alias("completion_rate"))


def user_content_matrix(events: DataFrame) -> DataFrame:
    """Interactions of each user with each title."""
    return events.groupBy("user_id", "content_id").agg(
        F.count(F.lit(1)).alias("interactions"),
        X.count_of(X.is_type("PLAY_START"), "views"),
        X.total(F.when(X.is_type("PLAYBACK_END"), F.col("total_watch_time_ms")),
                "watch_time_ms"),
        F.max(F.when(X.is_type("PLAYBACK_END"), F.col("completion_percentage")))
         .alias("best_completion"),
        F.max("event_timestamp").alias("last_interaction"))
