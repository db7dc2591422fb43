"""Hot views, lookups and display text at their borders."""

import pytest
from events import make_events, rows_of

from playlens.operators import enrich, lookups, views

HOUR = 3_600_000


def percent_rows(*percents):
    return [{"event_timestamp": f"10:{i:02d}:00", "event_type": "PROGRESS",
             "position_ms": round(p * 1000), "duration_ms": 100_000, "content_id": f"c{i}"}
            for i, p in enumerate(percents)]


def test_continue_watching_borders(spark):
    log = views.continue_watching_log(make_events(spark, percent_rows(1.99, 2, 94.99, 95)))
    assert sorted(r["content_id"] for r in rows_of(log)) == ["c1", "c2"]


def test_continue_watching_needs_position_and_duration(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:00:00", "position_ms": None, "duration_ms": 10},
        {"event_timestamp": "10:01:00", "position_ms": 5, "duration_ms": None},
        {"event_timestamp": "10:02:00", "position_ms": 5, "duration_ms": 0},
        {"event_timestamp": "10:03:00", "position_ms": 5, "duration_ms": 10,
         "event_type": "PLAY_START"}])
    assert rows_of(views.continue_watching_log(events)) == []


def test_continue_watching_same_key_keeps_last(spark):
    rows = [{"event_timestamp": "10:00:00", "position_ms": p, "duration_ms": 100}
            for p in (10, 20)]
    row, = rows_of(views.continue_watching_log(make_events(spark, rows)))
    assert row["last_position"] == 20


def test_continue_watching_latest_drops_finished_titles(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:00:00", "position_ms": 50, "duration_ms": 100},
        {"event_timestamp": "10:01:00", "position_ms": 99, "duration_ms": 100},
        {"event_timestamp": "10:00:00", "position_ms": 50, "duration_ms": 100,
         "content_id": "c2"}])
    assert [r["content_id"] for r in rows_of(views.continue_watching_latest(events))] == ["c2"]
    assert views.continue_watching_log(events).count() == 2


def test_progress_prefers_payload_completion(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:00:00", "event_type": "PLAYBACK_END", "position_ms": 50,
         "duration_ms": 100, "completion_percentage": 61.5, "total_watch_time_ms": 77}])
    row, = rows_of(views.user_content_progress(events))
    assert (row["completion_percentage"], row["total_watch_time"]) == (61.5, 77)
    assert row["device_type"] == "UNKNOWN"


def test_progress_after_end_resets_watch_time(spark):
    base = {"position_ms": 50, "duration_ms": 100}
    events = make_events(spark, [
        {**base, "event_timestamp": "10:00:00", "event_type": "PLAYBACK_END",
         "total_watch_time_ms": 77},
        {**base, "event_timestamp": "10:00:01", "event_type": "PROGRESS"}])
    row, = rows_of(views.user_content_progress(events))
    assert row["total_watch_time"] == 0


def test_progress_tie_goes_to_larger_event_id(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:00:00", "position_ms": p, "duration_ms": 100, "event_id": i}
        for p, i in ((1, "b"), (2, "c"), (3, "a"))])
    row, = rows_of(views.user_content_progress(events))
    assert row["last_position"] == 2


def test_progress_filter(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:00:00", "position_ms": None, "duration_ms": 100},
        {"event_timestamp": "10:00:00", "position_ms": 1, "duration_ms": None},
        {"event_timestamp": "10:00:00", "position_ms": 1, "duration_ms": 0},
        {"event_timestamp": "10:00:00", "position_ms": 1, "duration_ms": 100,
         "event_type": "RESUME"}])
    assert rows_of(views.user_content_progress(events)) == []


def test_route_counts(spark):
    events = make_events(spark, percent_rows(1, 50) + [
        {"event_timestamp": "11:00:00", "event_type": "REBUFFER_START"}])
    counts = {r["table_name"]: r["accepted_rows"] for r in rows_of(views.route_counts(events))}
    assert counts == {"events_by_user": 3, "events_by_session": 3, "events_by_content": 3,
                      "user_content_progress": 2, "continue_watching": 1,
                      "playback_quality_events": 1}


def test_quality_events_take_their_own_payload(spark):
    events = make_events(spark, [
        {"event_timestamp": "23:59:59", "event_type": "QUALITY_CHANGE", "old_quality": "AUTO",
         "new_quality": "UHD_4K", "new_bitrate": 9},
        {"event_timestamp": "10:00:00", "event_type": "REBUFFER_END", "bandwidth_estimate": 7,
         "rebuffer_duration_ms": None}])
    change, stall = sorted(rows_of(views.quality_events(events)), key=lambda r: r["event_type"])
    assert (change["bitrate"], change["new_quality"], str(change["event_date"])) == (
        9, "UHD_4K", "2024-01-01")
    assert (stall["bitrate"], stall["rebuffer_duration"], stall["old_quality"]) == (
        7, None, None)


@pytest.mark.parametrize("position, duration, text, left", [
    (0, HOUR, "0:00", "1h 0m left"), (61_999, HOUR, "1:01", "58m left"),
    (HOUR, 3 * HOUR, "60:00", "2h 0m left"), (2 * HOUR, HOUR, "120:00", "0m left"),
    (1_000, 3_601_000, "0:01", "1h 0m left"), (2_000, 3_601_000, "0:02", "59m left")])
def test_display_text(spark, position, duration, text, left):
    frame = spark.createDataFrame(
        [("u", "c", "t", position, duration, None)],
        "user_id string, content_id string, title string, last_position long, duration long,"
        " last_watched timestamp")
    shown, = rows_of(views.progress_display(frame))
    row, = rows_of(views.continue_watching_display(frame))
    assert (shown["position_text"], row["remaining_text"]) == (text, left)
    assert shown["remaining_ms"] == max(0, duration - position)


def test_lookups(spark):
    events = make_events(spark, [
        {"event_timestamp": f"10:{i:02d}:00", "position_ms": 50, "duration_ms": 100}
        for i in range(5)] + [{"event_timestamp": "10:04:00", "event_id": "a"}])
    by_user = views.events_by_user(events)
    assert lookups.user_events(by_user, "nobody").isEmpty()
    assert [r["event_id"] for r in lookups.user_events(by_user, "u1", 3).collect()] == [
        "a", "e0004", "e0003"]
    assert lookups.user_events(by_user, "u1", 1).count() == 1
    assert lookups.session_events(views.events_by_session(events), "no such").isEmpty()
    ordered = [r["event_id"] for r in lookups.session_events(
        views.events_by_session(events), "s1").collect()]
    assert ordered == ["e0000", "e0001", "e0002", "e0003", "a", "e0004"]
    assert lookups.progress(views.user_content_progress(events), "u1", "other").isEmpty()


def test_smart_resume(spark):
    frame = spark.createDataFrame(
        [("u", "done", 900_000, 90.0), ("u", "short", 119_999, 5.0),
         ("u", "mid", 120_000, 89.99)],
        "user_id string, content_id string, last_position long, completion_percentage double")
    got = {r["content_id"]: (r["is_completed"], r["resume_position"], r["show_prompt"])
           for r in lookups.smart_resume(frame).collect()}
    assert got == {"done": (True, 0, False), "short": (False, 0, False),
                   "mid": (False, 110_000, True)}


def test_active_sessions(spark):
    events = make_events(spark, [
        {"user_id": "on", "event_timestamp": "09:00:00"},
        {"user_id": "ended", "event_timestamp": "11:00:00"},
        {"user_id": "ended", "event_timestamp": "11:30:00", "event_type": "PLAYBACK_END"},
        {"user_id": "old", "event_timestamp": "07:59:59"},
        {"user_id": "edge", "event_timestamp": "08:00:00"}])
    got = lookups.active_sessions(events, "2024-01-01 12:00:00")
    assert sorted(r["user_id"] for r in got.collect()) == ["edge", "on"]


def test_retention(spark):
    events = make_events(spark, [{"event_timestamp": "10:00:00"},
                                 {"event_timestamp": "2024-01-08 10:00:00"}])
    kept = enrich.retained(views.events_by_user(events), "timestamp", "2024-01-15 10:00:00", 7)
    assert kept.count() == 1
    assert enrich.retained(kept, "timestamp", "2030-01-01 00:00:00", None).count() == 1
