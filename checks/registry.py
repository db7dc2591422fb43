"""Every batch operator as a query over the generic input tables.

Results are made comparable between engines: timestamps lose their zone, doubles
are rounded, and columns whose text differs between engines (payload JSON) are
replaced by a presence flag.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators import (contents, enrich, lookups, metrics, qos, quality, reports, rollup,
                                sessions, views)
from playlens.plans import current, rollup_jobs
from playlens.plans.layout import events_from_history
from playlens.session import checkpoint_root
from playlens.sources import decode
from playlens.sources.schema import RETENTION_DAYS
from playlens.sources.tables import (content_dimension, content_versions, device_dimension,
                                     playback_events, with_payload_json)
from playlens.streaming.sinks import HOT_VIEWS

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-31 00:00:00"
USER, CONTENT, SESSION, DAY = "user-1", "content-1", "s-1-20240105", "2024-01-05"

# Large means keep fewer decimals: a double has no more correct ones.
DIGITS = dict.fromkeys(("avg_bitrate_kbps", "avg_forward_ms", "avg_backward_ms",
                        "avg_rebuffer_ms", "mean_value"), 6)

QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for name, kind in df.dtypes:
        if kind == "timestamp":
            columns.append(F.col(name).cast("timestamp_ntz").alias(name))
        elif kind == "double":
            columns.append(F.round(name, DIGITS.get(name, 9)).alias(name))
        elif name == "payload_json":
            columns.append(F.col(name).isNotNull().alias("has_payload"))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def on_events(name: str, build: Callable[[DataFrame], DataFrame], settled: bool = False) -> None:
    """Registers a query that needs the playback events only."""
    QUERIES[name] = lambda spark, sf_dir: comparable(
        build(playback_events(spark, sf_dir, settled)))


def register(name: str):
    def keep(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
        return build
    return keep


# --- sources -----------------------------------------------------------------

def wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as broker records, some of them damaged on the way.

    Which rows are damaged depends on the source table's own event type and
    value, and every kind of damage the decoder tells apart occurs.
    """
    last = F.substring("event_id", -2, 2)
    events = playback_events(spark, sf_dir).select(
        "*", last.alias("last"), F.timestamp_millis(F.unix_millis("event_timestamp"))
        .alias("timestamp"))
    damaged = (events
               .withColumn("user_id", F.when(F.col("last") != "17", F.col("user_id")))
               .withColumn("event_type", F.when(F.col("last") == "27", "REWIND")
                           .otherwise(F.col("event_type")))
               .withColumn("event_timestamp", F.when(F.col("last") != "37",
                                                     F.col("event_timestamp"))))
    damaged = damaged.withColumns({
        "device_type": F.when((F.col("last") == "47") & F.col("device_type").isNotNull(), "TOASTER")
        .otherwise(F.col("device_type")),
        "new_quality": F.when(F.col("last") == "77", "SHARP").otherwise(F.col("new_quality")),
        "end_reason": F.when(F.col("last") == "98", "BOGUS").otherwise(F.col("end_reason")),
        "seek_to_ms": F.when(F.col("last") != "67", F.col("seek_to_ms")),
        "buffer_length": F.lit(20_000), "old_bitrate": F.lit(3000),
        "current_quality": F.lit("HD_720P")})
    length = F.when(F.col("last") == "07", 40).otherwise(2_147_483_647)
    return decode.nest_events(damaged, "last", "timestamp").select(
        F.substring(F.to_json("event"), F.lit(1), length).alias("value"), "timestamp")


@register("decode_events")
def _(spark, sf_dir):
    return decode.accepted(decode.decode_events(wire_records(spark, sf_dir)))


@register("quarantine")
def _(spark, sf_dir):
    bad = decode.quarantined(decode.decode_events(wire_records(spark, sf_dir)))
    return bad.groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("rows"), F.min("received_at").alias("first_received"),
        F.max("received_at").alias("last_received"))


@register("hot_cold_join")
def _(spark, sf_dir):
    events = playback_events(spark, sf_dir, settled=True)
    return enrich.hot_cold_join(views.user_content_progress(events), events)


# --- hot views and history -----------------------------------------------------

on_events("events_by_user", views.events_by_user)
on_events("events_by_session",
          lambda e: views.events_by_session(with_payload_json(e)))
on_events("events_by_content", views.events_by_content)
on_events("user_content_progress", views.user_content_progress, settled=True)
on_events("continue_watching_log", views.continue_watching_log, settled=True)
on_events("continue_watching_latest", views.continue_watching_latest, settled=True)
on_events("quality_events", views.quality_events)
on_events("history_events", lambda e: views.history_events(with_payload_json(e)))
on_events("route_counts", views.route_counts)
on_events("progress_display", lambda e: views.progress_display(views.user_content_progress(e)),
          settled=True)
on_events("continue_watching_display",
          lambda e: views.continue_watching_display(views.continue_watching_latest(e)),
          settled=True)
on_events("retention_apply", lambda e: enrich.retained(
    views.events_by_user(e), "timestamp", "2024-04-15 00:00:00",
    RETENTION_DAYS["events_by_user"]))

# --- metrics and sessions ---------------------------------------------------------

on_events("content_metrics_5min", metrics.content_metrics)
on_events("content_metrics_early", metrics.content_metrics_early)
on_events("replay_content_metrics", lambda e: metrics.content_metrics(
    events_from_history(views.history_events(with_payload_json(e)))))
on_events("viewers_rollup", metrics.viewers_rollup)
on_events("viewers_rollup_sketch", lambda e: metrics.merge_viewer_sketches(
    metrics.viewer_sketches(e)))
on_events("device_class_counts", metrics.device_class_counts)
on_events("qos_anomalies", lambda e: metrics.qos_anomalies(metrics.content_metrics(e, "1 hour")))
on_events("user_sessions", sessions.user_sessions)
on_events("user_sessions_12h", lambda e: sessions.user_sessions(e, "12 hours"))
on_events("user_sessions_window", lambda e: sessions.user_sessions_stream(e, "12 hours"))
on_events("sessions_by_lag", lambda e: sessions.session_starts_by_lag(e, "12 hours"))
on_events("session_distribution",
          lambda e: reports.session_distribution(sessions.user_sessions(e, "12 hours")))
on_events("window_distribution",
          lambda e: reports.window_distribution(metrics.content_metrics(e)))
on_events("completion_distribution", reports.completion_distribution)

# --- roll-ups -------------------------------------------------------------------------

on_events("hourly_content_stats",
          lambda e: rollup.hourly_content_stats(e, date=DAY, hour=20))
on_events("backfill_hourly", lambda e: rollup_jobs.backfill_frames(
    e, "2024-01-10", "2024-01-20", "hourly")["hourly"])
on_events("daily_content_stats", lambda e: rollup_jobs.backfill_frames(
    e, "2024-01-01", "2024-01-31", "all")["daily"])
on_events("daily_content_stats_exact", rollup.daily_content_stats_exact)
on_events("peak_hour", lambda e: rollup.peak_hour(rollup.hourly_content_stats(e)))

# --- reports ----------------------------------------------------------------------------

on_events("event_overview", reports.event_overview)
on_events("event_type_share", reports.event_type_share)
on_events("device_analytics", reports.device_analytics)
on_events("hourly_traffic", reports.hourly_traffic)
on_events("top_content", reports.top_content)
on_events("rebuffer_top", reports.rebuffer_top)
on_events("event_counters", reports.event_counters)
on_events("business_totals", reports.business_totals)
on_events("bitrate_distribution", reports.bitrate_distribution)
on_events("completion_by_device", reports.completion_by_device)
on_events("completion_by_content", reports.completion_by_content)
on_events("device_behaviour", reports.device_behaviour)
on_events("engagement_by_hour", reports.engagement_by_hour)
on_events("title_viewers_day", reports.title_viewers_day)
on_events("seek_patterns", reports.seek_patterns)
on_events("period_report", reports.period_report)
on_events("user_features", lambda e: reports.user_features(e, AS_OF))
on_events("user_content_matrix", reports.user_content_matrix)

# --- quality of service -------------------------------------------------------------------

on_events("qos_by_content", qos.qos_by_content)
on_events("qos_by_device", qos.qos_by_device)
on_events("qos_by_region", qos.qos_by_region)
on_events("qos_realtime", qos.qos_realtime)
on_events("time_to_first_frame", qos.time_to_first_frame)
on_events("pause_durations", qos.pause_durations)
on_events("quality_stability", qos.quality_stability)
on_events("error_rates", qos.error_rates)
on_events("content_health", qos.content_health)

# --- lookups ----------------------------------------------------------------------------

on_events("lookup_continue_watching",
          lambda e: lookups.continue_watching(views.continue_watching_log(e), USER),
          settled=True)
on_events("lookup_progress",
          lambda e: lookups.progress(views.user_content_progress(e), USER, CONTENT),
          settled=True)
on_events("lookup_all_progress",
          lambda e: lookups.all_progress(views.user_content_progress(e), USER), settled=True)
on_events("lookup_user_events", lambda e: lookups.user_events(views.events_by_user(e), USER))
on_events("lookup_session_events", lambda e: lookups.session_events(
    views.events_by_session(with_payload_json(e)), SESSION))
on_events("lookup_content_events",
          lambda e: lookups.content_events(views.events_by_content(e), CONTENT))
on_events("lookup_content_metrics",
          lambda e: lookups.content_metrics(metrics.content_metrics(e), CONTENT))
on_events("lookup_quality_events",
          lambda e: lookups.quality_events(views.quality_events(e), CONTENT, DAY))
on_events("lookup_user_sessions",
          lambda e: lookups.user_sessions(sessions.user_sessions(e), USER))
on_events("continue_watching_top20",
          lambda e: lookups.continue_watching_top(views.continue_watching_log(e)), settled=True)
on_events("user_timeline_top", lambda e: lookups.user_timeline_top(views.events_by_user(e)))
on_events("smart_resume", lambda e: lookups.smart_resume(views.user_content_progress(e)),
          settled=True)
on_events("active_sessions", lambda e: lookups.active_sessions(e, AS_OF))

# --- current tables ------------------------------------------------------------------------

def current_tables(spark: SparkSession, sf_dir: str, table: str, buckets: int = 8) -> str:
    """A current table that three batches with common keys were merged into, the middle one first."""
    root = checkpoint_root(spark, scratch_root(spark))
    path = f"{root}/current-{uuid.uuid4().hex}/{table}"
    events = playback_events(spark, sf_dir, settled=True)
    day = F.dayofmonth("event_timestamp")
    for number, part in enumerate((day.between(11, 20), day <= 10, day > 20)):
        current.merge_batch(HOT_VIEWS[table](events.filter(part)), path, table, number, buckets)
    return path


def scratch_root(spark: SparkSession) -> str | None:
    """A folder for sessions that run on this machine alone."""
    return tempfile.mkdtemp(prefix="/tmp/run-") \
        if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local" \
        else None


@register("stored_progress")
def _(spark, sf_dir):
    path = current_tables(spark, sf_dir, "user_content_progress")
    return current.read_current(spark, path).drop("event_id")


@register("stored_lookup_all_progress")
def _(spark, sf_dir):
    path = current_tables(spark, sf_dir, "user_content_progress")
    rows = current.read_current_key(spark, path, "user_id", USER, 8)
    return lookups.all_progress(rows, USER).drop("event_id")


@register("stored_lookup_content_events")
def _(spark, sf_dir):
    path = current_tables(spark, sf_dir, "events_by_content")
    return lookups.content_events(
        current.read_current_key(spark, path, "content_id", CONTENT, 8), CONTENT)


# --- joins ----------------------------------------------------------------------------------


@register("enrich_content")
def _(spark, sf_dir):
    enriched = enrich.enrich_content(playback_events(spark, sf_dir),
                                     content_dimension(spark, sf_dir))
    return enriched.select("event_id", "content_id", "title", "genre", "duration_ms")


@register("enrich_content_as_of")
def _(spark, sf_dir):
    enriched = enrich.enrich_content_as_of(playback_events(spark, sf_dir),
                                           content_versions(spark, sf_dir))
    return enriched.select("event_id", "content_id", "title", "genre", "duration_ms", "credits_ms")


@register("enrich_device")
def _(spark, sf_dir):
    enriched = enrich.enrich_device(playback_events(spark, sf_dir),
                                    device_dimension(spark, sf_dir))
    return enriched.select("event_id", "device_id", "device_type", "device_model")


@register("hot_cold_reconcile")
def _(spark, sf_dir):
    cold = rollup.with_partition_columns(playback_events(spark, sf_dir))
    hot = enrich.retained(cold, "event_timestamp", AS_OF, RETENTION_DAYS["events_by_session"])
    return quality.reconcile(hot, cold, ["content_id", "event_date"])


@register("content_differences")
def _(spark, sf_dir):
    """A copy of the hot view in which rows of some users were changed or lost."""
    hot = views.events_by_user(playback_events(spark, sf_dir)).withColumn(
        "day", F.to_date("timestamp"))
    last = F.substring("event_id", -3, 3)
    cold = hot.filter(last != "111").withColumn("position", F.when(
        last == "222", F.lit(-1)).otherwise(F.col("position")).cast("long"))
    return contents.differences(hot, cold, "day", ["event_id"], ["user_id", "event_type", "position"])


# --- data checks --------------------------------------------------------------------------

@register("dedup_events")
def _(spark, sf_dir):
    events = playback_events(spark, sf_dir)
    delivered_twice = events.unionByName(events)
    return quality.deduplicated(delivered_twice).select(
        "event_id", "event_type", "event_timestamp", "user_id", "content_id")


on_events("noisy_devices", lambda e: quality.noisy_devices(e, limit=1))
on_events("noisy_devices_sliding",
          lambda e: quality.noisy_devices(e, limit=2, window="1 hour", slide="30 minutes"))
on_events("dq_required_fields", quality.required_fields)
on_events("dq_freshness", lambda e: quality.freshness(e, AS_OF))
on_events("dq_volume", quality.volume)
on_events("dq_null_rates", quality.null_rates)
on_events("dq_scorecard", quality.scorecard)
