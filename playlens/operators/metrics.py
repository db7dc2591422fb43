"""Five-minute content metrics and what is built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions import expr as X

_COUNTERS = ("view_count", "completed_views", "total_watch_time_ms", "rebuffer_count",
             "total_rebuffer_duration_ms", "error_count", "pause_count", "seek_count",
             "quality_change_count", "mobile_views", "desktop_views", "tv_views",
             "other_device_views")


def _measures() -> list:
    start, end = X.is_type("PLAY_START"), X.is_type("PLAYBACK_END")
    device = X.device_class()
    return [
        X.count_of(start, "view_count"),
        X.count_of(X.is_completed_end(), "completed_views"),
        X.total(F.when(end, F.col("total_watch_time_ms")), "total_watch_time_ms"),
        X.count_of(X.is_type("REBUFFER_END"), "rebuffer_count"),
        X.total(F.when(X.is_type("REBUFFER_END"), F.col("rebuffer_duration_ms")),
                "total_rebuffer_duration_ms"),
        X.count_of(X.is_error_end(), "error_count"),
        X.count_of(X.is_type("PAUSE"), "pause_count"),
        X.count_of(X.is_type("SEEK"), "seek_count"),
        X.count_of(X.is_type("QUALITY_CHANGE"), "quality_change_count"),
        X.count_of(start & (device == "mobile"), "mobile_views"),
        X.count_of(start & (device == "desktop"), "desktop_views"),
        X.count_of(start & (device == "tv"), "tv_views"),
        X.count_of(start & (device == "other"), "other_device_views"),
    ]


def content_metrics(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Metrics per title and tumbling window; batch, or a stream in append mode.

    Two aggregates: first per (title, window, viewer), then per (title, window).
    Viewers are counted exactly without a set in memory or in state, and a title
    that draws a third of all events is spread over its viewers.
    """
    per_viewer = events.groupBy("content_id", F.window("event_timestamp", window).alias("window"),
                                "user_id").agg(*_measures())
    per_window = per_viewer.groupBy("content_id", "window").agg(
        F.count("user_id").alias("unique_viewers"),
        *[F.sum(name).alias(name) for name in _COUNTERS])
    return _shape(per_window)


def content_metrics_early(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Running values of open windows, for a stream in update mode; exact at any size.

    Update mode allows one aggregate only, so viewers are counted by a row of their own for the
    first event of each (title, window, viewer). A stream keeps those keys until the watermark
    passes their window, spread over the viewers of a title; it reads its source twice.
    """
    windowed = events.withColumn("window", F.window("event_timestamp", window))
    viewers = (windowed.filter(F.col("user_id").isNotNull())
               .select("content_id", "window", "user_id")
               .dropDuplicates(["content_id", "window", "user_id"])
               .withColumn("unique_viewers", F.lit(1)))
    rows = windowed.drop("user_id").unionByName(viewers.drop("user_id"),
                                                allowMissingColumns=True)
    return _shape(rows.groupBy("content_id", "window").agg(
        X.total(F.col("unique_viewers"), "unique_viewers"), *_measures()))


def content_metrics_sketched(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """As `content_metrics_early`, with state of bounded size per title and window.

    `approx_viewers` is a sketch: exact for few viewers, with a standard error under 1 % for many.
    """
    per_window = events.groupBy(
        "content_id", F.window("event_timestamp", window).alias("window")
    ).agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 14)).alias("unique_viewers"),
          *_measures())
    return _shape(per_window).withColumnRenamed("unique_viewers", "approx_viewers")


def _shape(per_window: DataFrame) -> DataFrame:
    views, watch = F.col("view_count"), F.col("total_watch_time_ms")
    average = F.when(views > 0, F.call_function("div", watch, F.greatest(views, F.lit(1))))
    return per_window.select(
        "content_id", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), "view_count", "unique_viewers",
        "completed_views", "total_watch_time_ms",
        average.otherwise(F.lit(0).cast("bigint")).alias("avg_watch_time_ms"),
        *_COUNTERS[3:])


def viewers_rollup(events: DataFrame, fine: str = "5 minutes", coarse: str = "1 hour"
                   ) -> DataFrame:
    """Exact viewers per hour, from the union of the 5-minute viewer sets."""
    fine_sets = events.select("content_id", F.window("event_timestamp", fine).alias("w"),
                              "user_id").distinct()
    return (fine_sets.groupBy("content_id", F.window("w.start", coarse).alias("hour"))
                     .agg(F.countDistinct("user_id").alias("unique_viewers"))
                     .select("content_id", F.col("hour.start").alias("hour_start"),
                             "unique_viewers"))


def viewer_sketches(events: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Mergeable viewer sketches per title and window, for storing."""
    return (events.groupBy("content_id", F.window("event_timestamp", window).alias("w"))
                  .agg(F.hll_sketch_agg("user_id", 14).alias("viewers"))
                  .select("content_id", F.col("w.start").alias("window_start"), "viewers"))


def merge_viewer_sketches(sketches: DataFrame, window: str = "1 hour") -> DataFrame:
    """Approximate viewers of a longer window, without going back to the events."""
    return (sketches.groupBy("content_id", F.window("window_start", window).alias("w"))
                    .agg(F.hll_sketch_estimate(F.hll_union_agg("viewers")).alias("viewers"))
                    .select("content_id", F.col("w.start").alias("window_start"),
                            F.col("viewers").alias("approx_viewers")))


def device_class_counts(events: DataFrame) -> DataFrame:
    return events.groupBy(X.device_class().alias("device_class")).agg(
        F.count(F.lit(1)).alias("events"),
        X.count_of(X.is_type("PLAY_START"), "views"))


def window_rebuffer_ratio(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "content_id", "window_start",
        X.safe_ratio(F.col("total_rebuffer_duration_ms"), F.col("total_watch_time_ms"), None)
         .alias("rebuffer_ratio"))


def qos_anomalies(metrics: DataFrame, history: int = 12, sigmas: float = 3.0) -> DataFrame:
    """Windows whose rebuffer ratio leaves the band of the title's last windows.

    Runs over the aggregate: a title has at most one row per window, so the
    partition of the busiest title is no larger than the number of windows.
    """
    before = (Window.partitionBy("content_id").orderBy("window_start")
                    .rowsBetween(-history, -1))
    ratio = F.col("rebuffer_ratio")
    banded = (window_rebuffer_ratio(metrics).filter(ratio.isNotNull())
              .withColumn("mean_before", F.avg(ratio).over(before))
              .withColumn("std_before", F.stddev_samp(ratio).over(before))
              .withColumn("windows_before", F.count(ratio).over(before)))
    outside = F.abs(ratio - F.col("mean_before")) > sigmas * F.col("std_before")
    return banded.withColumn("is_anomaly", F.coalesce(outside, F.lit(False)))
