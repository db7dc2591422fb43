"""Window metrics, roll-ups, quality of service and checks."""

import pytest
from events import make_events, rows_of
from pyspark.sql import functions as F

from playlens.operators import metrics, qos, quality, reports, rollup


def test_window_edges_and_viewers(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:04:59.999", "event_type": "PLAY_START", "user_id": "a"},
        {"event_timestamp": "10:05:00", "event_type": "PROGRESS", "user_id": "b"},
        {"event_timestamp": "10:00:00", "event_type": "PAUSE", "user_id": "b"},
        {"event_timestamp": "10:01:00", "event_type": "PAUSE", "user_id": "b"}])
    first, second = sorted(rows_of(metrics.content_metrics(events)),
                           key=lambda r: r["window_start"])
    assert (first["view_count"], first["unique_viewers"], first["pause_count"]) == (1, 2, 2)
    assert (second["view_count"], second["unique_viewers"]) == (0, 1)
    assert second["avg_watch_time_ms"] == 0
    assert first["other_device_views"] == 1


def test_completion_border_and_rebuffers(spark):
    end = {"event_type": "PLAYBACK_END", "event_timestamp": "10:00:00"}
    events = make_events(spark, [
        {**end, "completion_percentage": 89.99, "total_watch_time_ms": 10},
        {**end, "completion_percentage": 90.0, "total_watch_time_ms": 15,
         "end_reason": "NETWORK_ERROR"},
        {**end, "completion_percentage": None},
        {"event_type": "REBUFFER_END", "event_timestamp": "10:01:00"},
        {"event_type": "REBUFFER_END", "event_timestamp": "10:01:00",
         "rebuffer_duration_ms": 40},
        {"event_type": "REBUFFER_START", "event_timestamp": "10:01:00"},
        {"event_type": "PLAY_START", "event_timestamp": "10:01:00", "device_type": "WEB"},
        {"event_type": "PLAY_START", "event_timestamp": "10:01:00", "device_type": "SET_TOP_BOX"}])
    row, = rows_of(metrics.content_metrics(events))
    assert (row["completed_views"], row["total_watch_time_ms"]) == (1, 25)
    assert (row["rebuffer_count"], row["total_rebuffer_duration_ms"]) == (2, 40)
    assert (row["desktop_views"], row["tv_views"], row["error_count"]) == (1, 1, 1)
    assert row["avg_watch_time_ms"] == 12


def test_sketches_merge(spark):
    events = make_events(spark, [
        {"event_timestamp": f"10:{m:02d}:00", "user_id": f"u{m % 7}"} for m in range(60)])
    merged, = rows_of(metrics.merge_viewer_sketches(metrics.viewer_sketches(events)))
    exact, = rows_of(metrics.viewers_rollup(events))
    assert merged["approx_viewers"] == exact["unique_viewers"] == 7


def test_early_viewers_of_a_large_group(spark):
    """Exact in the early form, within 3 % in the sketched one."""
    events = make_events(spark, [{"event_timestamp": "10:00:00"}]).drop("user_id").crossJoin(
        spark.range(60000).select(F.concat(F.lit("u"), F.col("id") % 30000).alias("user_id")))
    events = events.unionByName(make_events(spark, [{"event_timestamp": "10:01:00"}])
                                .withColumn("user_id", F.lit(None).cast("string")))
    early, = rows_of(metrics.content_metrics_early(events))
    final, = rows_of(metrics.content_metrics(events))
    sketched, = rows_of(metrics.content_metrics_sketched(events))
    assert early == final and early["unique_viewers"] == 30000
    assert "unique_viewers" not in sketched
    assert sketched["approx_viewers"] == pytest.approx(30000, rel=0.03)


def test_sketches_stay_close(spark):
    """Within 3 % at 20,000 viewers, merged from 5-minute sketches."""
    users = spark.range(20000).select(
        F.lit("c1").alias("content_id"), F.concat(F.lit("u"), "id").alias("user_id"),
        F.timestamp_seconds(1704103200 + F.col("id") % 3600).alias("event_timestamp"))
    merged, = rows_of(metrics.merge_viewer_sketches(metrics.viewer_sketches(users)))
    assert merged["approx_viewers"] == pytest.approx(20000, rel=0.03)


def test_hourly_and_daily(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:00:00", "event_type": "PLAY_START", "device_type": "IOS"},
        {"event_timestamp": "10:00:00", "event_type": "PLAYBACK_END", "position_ms": 1999,
         "user_id": "u2", "session_id": "s2"},
        {"event_timestamp": "11:00:00", "event_type": "PLAYBACK_END", "position_ms": None,
         "device_type": "WEB"},
        {"event_timestamp": "11:30:00", "event_type": "PROGRESS", "bitrate_kbps": 10,
         "content_id": "c1"}])
    hourly = rollup.hourly_content_stats(events)
    ten, eleven = sorted(rows_of(hourly), key=lambda r: r["event_hour"])
    assert (ten["unique_users"], ten["unique_sessions"], ten["total_watch_time_seconds"]) == (
        2, 2, 1)
    assert (ten["avg_bitrate_kbps"], eleven["avg_bitrate_kbps"]) == (None, 10.0)
    daily, = rows_of(rollup.daily_content_stats(hourly))
    assert (daily["peak_hour"], daily["peak_hour_events"]) == (10, 2)  # tie: earlier hour
    assert (daily["mobile_ratio"], daily["web_ratio"], daily["tablet_ratio"]) == (0.5, 0.5, 0.0)
    assert daily["avg_bitrate_kbps"] == 10.0
    peak, = rows_of(rollup.peak_hour(hourly))
    assert (peak["peak_hour"], peak["peak_hour_events"]) == (10, 2)
    exact, = rows_of(rollup.daily_content_stats_exact(events))
    assert exact["unique_users"] == 2 and exact["total_events"] == 4


def test_only_null_positions_give_null_watch_time(spark):
    events = make_events(spark, [{"event_timestamp": "10:00:00", "event_type": "PLAYBACK_END"}])
    row, = rows_of(rollup.hourly_content_stats(events))
    assert row["total_watch_time_seconds"] is None


def test_daily_ratios_without_devices_are_zero(spark):
    events = make_events(spark, [{"event_timestamp": "10:00:00"}])
    row, = rows_of(rollup.daily_content_stats(rollup.hourly_content_stats(events)))
    assert (row["mobile_ratio"], row["tv_ratio"]) == (0.0, 0.0)


def test_time_to_first_frame(spark):
    events = make_events(spark, [
        {"event_timestamp": "09:00:00", "event_type": "PROGRESS"},
        {"event_timestamp": "09:59:59", "event_type": "PLAY_START"},
        {"event_timestamp": "10:30:00", "event_type": "PLAY_START"},
        {"event_timestamp": "12:00:00.250", "event_type": "PROGRESS"},
        {"event_timestamp": "12:01:00", "event_type": "PROGRESS"},
        {"event_timestamp": "12:01:00", "event_type": "PLAY_START", "content_id": "c2"}])
    row, = rows_of(qos.time_to_first_frame(events))
    assert row["first_frame_ms"] == 2 * 3600_000 + 1_000 + 250


def test_pauses_across_spans(spark):
    events = make_events(spark, [
        {"event_timestamp": "09:59:00", "event_type": "PAUSE"},
        {"event_timestamp": "13:01:00", "event_type": "RESUME"},
        {"event_timestamp": "13:02:00", "event_type": "RESUME"},
        {"event_timestamp": "13:03:00", "event_type": "PAUSE"},
        {"event_timestamp": "13:03:30", "event_type": "PROGRESS"},
        {"event_timestamp": "13:04:00", "event_type": "RESUME"}])
    assert sorted(r["pause_ms"] for r in rows_of(qos.pause_durations(events))) == [
        60_000, 3 * 3600_000 + 120_000]


def test_anomaly_needs_history(spark):
    frame = spark.createDataFrame(
        [("c1", i, 1000, 10 + i % 2) for i in range(10)] + [("c1", 10, 1000, 900),
                                                            ("c1", 11, 0, 5)],
        "content_id string, n int, total_watch_time_ms long, total_rebuffer_duration_ms long"
    ).withColumn("window_start", F.timestamp_seconds(F.col("n") * 300))
    flagged = rows_of(metrics.qos_anomalies(frame).filter("is_anomaly"))
    assert [r["rebuffer_ratio"] for r in flagged] == [0.9]


def test_percentiles_are_values_of_the_data(spark):
    frame = spark.range(1, 101).withColumnRenamed("id", "v")
    row, = rows_of(reports.percentiles_of(frame, {"v": F.col("v")}, (50, 95, 99)))
    assert (row["p50"], row["p95"], row["p99"], row["samples"]) == (50, 95, 99, 100)


def test_freshness(spark):
    events = make_events(spark, [{"event_timestamp": "10:00:00"}])
    def stale(as_of, rows=events):
        return quality.freshness(rows, as_of).first()["is_stale"]
    assert not stale("2024-01-01 10:30:00")
    assert stale("2024-01-01 10:30:01")
    assert stale("2024-01-01 10:00:00", events.filter("false"))


def test_volume_counts_silent_hours(spark):
    events = make_events(spark, [{"event_timestamp": t} for t in (
        "10:00:00", "11:00:00", "13:00:00")])
    rows = sorted(rows_of(quality.volume(events)), key=lambda r: r["hour_start"])
    assert [r["events"] for r in rows] == [1, 1, 0, 1]
    assert [r["within_tolerance"] for r in rows] == [True, True, False, False]
    assert quality.volume(events.filter("false")).isEmpty()


def test_rules_and_scorecard(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:00:00", "event_type": "REWIND", "user_id": None},
        {"event_timestamp": "10:00:00", "position_ms": 11, "duration_ms": 10},
        {"event_timestamp": "10:00:00", "device_type": "PHONE", "new_quality": "SD"},
        {"event_timestamp": "10:00:00", "position_ms": 1}])
    broken = {r["rule"]: r["violations"] for r in rows_of(quality.required_fields(events))
              if r["violations"]}
    assert broken == {"user_id present": 1, "event_type known": 1, "position in range": 1,
                      "device_type known": 1, "quality known": 1}
    card, = rows_of(quality.scorecard(events))
    assert card["completeness_percent"] == pytest.approx(100 * 27 / 28)
    assert card["accuracy_percent"] == pytest.approx(100 * 43 / 48)


def test_duplicates_and_noise(spark):
    events = make_events(spark, [{"event_timestamp": "10:00:01", "event_id": "x"}] * 3
                         + [{"event_timestamp": "10:00:59", "event_id": "y"}])
    assert quality.deduplicated(events).count() == 2
    noisy, = rows_of(quality.noisy_devices(events, limit=3))
    assert noisy["events"] == 4
    assert quality.noisy_devices(events, limit=4).isEmpty()


def test_reconcile(spark):
    def frame(*keys):
        return spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: r["status"] for r in quality.reconcile(
        frame("a", "b", "b", "c"), frame("a", "b", "d"), ["k"]).collect()}
    assert got == {"a": "match", "b": "differs", "c": "only_hot", "d": "only_cold"}
