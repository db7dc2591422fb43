"""Session borders and measures."""

import pytest
from events import as_set, make_events, rows_of
from pyspark.sql import functions as F

from playlens.operators import sessions


def starts(spark, *times, gap="30 minutes"):
    events = make_events(spark, [{"event_timestamp": t} for t in times])
    return sorted(str(r["session_start"].time()) for r in rows_of(
        sessions.user_sessions(events, gap)))


@pytest.mark.parametrize("second, expected", [
    ("10:29:59", 1), ("10:30:00", 1), ("10:30:01", 2)])
def test_gap_border(spark, second, expected):
    assert len(starts(spark, "10:00:00", second)) == expected


def test_gap_border_off_the_grid(spark):
    assert len(starts(spark, "10:17:11", "10:47:11")) == 1
    assert len(starts(spark, "10:17:11", "10:47:12")) == 2


def test_chain_of_short_gaps_is_one_session(spark):
    times = [f"1{h}:{m:02d}:00" for h in range(3) for m in (0, 29, 58)]
    assert len(starts(spark, *times)) == 1


def test_row_order_does_not_matter(spark):
    times = ["10:00:00", "12:00:00", "10:20:00", "09:45:00", "12:10:00"]
    assert starts(spark, *times) == starts(spark, *sorted(times)) == ["09:45:00", "12:00:00"]


def test_measures(spark):
    events = make_events(spark, [
        {"event_timestamp": "10:00:00", "event_type": "PLAY_START", "device_type": None},
        {"event_timestamp": "10:01:00", "event_type": "PAUSE", "device_type": "IOS"},
        {"event_timestamp": "10:02:00", "event_type": "SEEK", "content_id": "c2"},
        {"event_timestamp": "10:03:00", "event_type": "REBUFFER_END",
         "rebuffer_duration_ms": 250},
        {"event_timestamp": "10:04:00", "event_type": "REBUFFER_END"},
        {"event_timestamp": "10:05:00", "event_type": "PLAYBACK_END", "end_reason": "ERROR",
         "total_watch_time_ms": 1000, "completion_percentage": 40.0},
        {"event_timestamp": "10:06:00.5", "event_type": "PLAYBACK_END",
         "end_reason": "COMPLETED", "total_watch_time_ms": 500,
         "completion_percentage": 100.0},
    ])
    row, = rows_of(sessions.user_sessions(events))
    assert row["device_type"] is None  # the first event has none
    assert row["session_duration_ms"] == 360500
    assert (row["content_count"], row["total_events"]) == (2, 7)
    assert (row["rebuffer_count"], row["total_rebuffer_duration_ms"]) == (2, 250)
    assert (row["total_watch_time_ms"], row["avg_completion_percentage"]) == (1500, 70.0)
    assert (row["play_start_count"], row["pause_count"], row["seek_count"],
            row["error_count"]) == (1, 1, 1, 1)
    assert row["session_id"] == "u1-1704103200000"


def test_no_playback_end_gives_zero_completion(spark):
    row, = rows_of(sessions.user_sessions(make_events(spark, [{"event_timestamp": "10:00:00"}])))
    assert row["avg_completion_percentage"] == 0.0


def test_equal_timestamps(spark):
    events = make_events(spark, [{"event_timestamp": "10:00:00"}] * 3)
    row, = rows_of(sessions.user_sessions(events))
    assert (row["total_events"], row["session_duration_ms"]) == (3, 0)


def test_two_ways_agree(spark):
    from conftest import SMALL
    from playlens.sources.tables import playback_events

    events = playback_events(spark, SMALL)
    for gap in ("30 minutes", "12 hours"):
        summed = sessions.user_sessions(events, gap).select("user_id", "session_id")
        chained = sessions.session_starts_by_lag(events, gap).select("user_id", "session_id")
        assert as_set(summed) == as_set(chained)


def test_batch_equals_session_window(spark):
    from conftest import SMALL
    from playlens.sources.tables import playback_events

    events = playback_events(spark, SMALL)
    rounded = [F.round("avg_completion_percentage", 6).alias("avg_completion_percentage")]
    def shape(df):
        return df.select(*[c for c in df.columns if c != "avg_completion_percentage"], *rounded)
    assert as_set(shape(sessions.user_sessions(events, "6 hours"))) == \
        as_set(shape(sessions.user_sessions_stream(events, "6 hours")))


def test_hot_user_never_meets_in_one_group(spark):
    """The only window of the plan sees spans, not events."""
    events = make_events(spark, [{"event_timestamp": "10:00:00"}])
    plan = sessions.user_sessions(events)._jdf.queryExecution().optimizedPlan().toString()
    below_window = plan[plan.index("Window"):]
    assert "Aggregate [user_id" in below_window
