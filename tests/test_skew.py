"""Hot keys: results against plain Python, and the shape of the plans."""

import datetime
import random

import pytest
from events import make_events
from pyspark.sql import functions as F

from playlens.operators import lookups, metrics, qos, sessions, views
from playlens.operators.ordered import WIDTHS, time_span, with_previous


@pytest.fixture(scope="module")
def skewed(spark):
    """Events of which a third belong to one user, session and title."""
    dice = random.Random(7)
    first = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    rows = []
    for n in range(3000):
        who = "hot" if n % 3 == 0 else f"u{dice.randrange(40)}"
        seconds = dice.randrange(3600) if who == "hot" else dice.randrange(86400)
        rows.append({"event_id": f"{n:05d}", "user_id": who, "session_id": f"s-{who}",
                     "content_id": f"c-{who}" if who == "hot" else f"c{dice.randrange(9)}",
                     "event_timestamp": first + datetime.timedelta(seconds=seconds),
                     "event_type": dice.choice(["PAUSE", "RESUME", "PLAY_START", "PROGRESS"]),
                     "position_ms": dice.randrange(100), "duration_ms": 100})
    frame = make_events(spark, rows).cache()
    yield rows, frame
    frame.unpersist()


def in_order(rows, key):
    groups = {}
    for row in sorted(rows, key=lambda r: (r["event_timestamp"], r["event_id"])):
        groups.setdefault(row[key], []).append(row)
    return groups


@pytest.mark.parametrize("widths", [WIDTHS, ("1 day",), ("1 minute", "30 seconds"),
                                    ("1 day", "1 hour", "1 minute", "1 second")])
def test_previous_row_is_exact(skewed, widths):
    rows, frame = skewed
    chained = with_previous(frame.select("user_id", "event_timestamp", "event_id"),
                            ["user_id"], "event_timestamp", "event_id", ["event_id"],
                            widths=widths)
    got = {r["event_id"]: r["prev"] and r["prev"]["event_id"] for r in chained.collect()}
    expected = {}
    for group in in_order(rows, "user_id").values():
        for before, row in zip([None, *group], group):
            expected[row["event_id"]] = before and before["event_id"]
    assert got == expected


def test_rows_of_one_second_are_cut(spark):
    """A key whose rows all lie in one second: no group holds most of them."""
    rows = spark.range(3000).select(
        F.lit("u").alias("user_id"), F.col("id").cast("string").alias("event_id"),
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 300).alias("ts"))
    groups = rows.groupBy(time_span("ts", WIDTHS[-1]).alias("s")).count()
    assert groups.agg(F.max("count")).first()[0] <= 4
    chained = with_previous(rows, ["user_id"], "ts", "event_id", ["event_id"]).collect()
    got = {int(r["event_id"]): r["prev"] and int(r["prev"]["event_id"]) for r in chained}
    assert got == {0: None, **{i: i - 1 for i in range(1, 3000)}}


def test_sessions_of_a_hot_user(skewed):
    rows, frame = skewed
    expected = set()
    for user, group in in_order(rows, "user_id").items():
        start, last, size = None, None, 0
        for row in [*group, None]:
            now = row and row["event_timestamp"]
            if last is None or now is None or now - last > datetime.timedelta(minutes=30):
                if last is not None:
                    expected.add((user, start, size))
                start, size = now, 0
            last, size = now, size + 1
    got = {(r["user_id"], r["session_start"].astimezone(datetime.timezone.utc),
            r["total_events"]) for r in sessions.user_sessions(frame).collect()}
    assert got == expected


def test_pauses_of_a_hot_session(skewed):
    rows, frame = skewed
    expected = 0
    for group in in_order([r for r in rows if r["event_type"] in ("PAUSE", "RESUME")],
                          "session_id").values():
        expected += sum(a["event_type"] == "PAUSE" and b["event_type"] == "RESUME"
                        for a, b in zip(group, group[1:]))
    assert qos.pause_durations(frame).count() == expected


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_rows_are_cut_before_the_shuffle(skewed):
    plan = plan_of(lookups.user_timeline_top(views.events_by_user(skewed[1])))
    assert plan.count("WindowGroupLimit") == 2  # partial below the exchange, final above


def test_aggregates_combine_before_the_shuffle(skewed):
    frame = skewed[1]
    for df in (metrics.content_metrics(frame), views.user_content_progress(frame),
               sessions.user_sessions(frame)):
        assert "partial_" in plan_of(df)


def test_viewers_are_spread_over_viewer_keys(skewed):
    """The first shuffle of the window metrics goes by viewer, not by title."""
    plan = plan_of(metrics.content_metrics(skewed[1]))
    widest = plan[plan.rindex("Exchange hashpartitioning"):].split("\n")[0]
    assert "user_id" in widest


def test_no_pair_of_operators_multiplies_rows(skewed):
    for df in (sessions.user_sessions(skewed[1]), qos.pause_durations(skewed[1])):
        assert "CartesianProduct" not in plan_of(df)
        assert "BroadcastNestedLoopJoin" not in plan_of(df)


def test_global_ranks_with_most_rows_on_one_value(spark):
    """Ties, empty input, a hot value; the plan has no window over all rows."""
    from playlens.operators.ordered import global_ranks

    rows = spark.range(5000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 10 < 8, 0.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(700)) / 7)
        .alias("a"), (F.col("id") % 3).alias("b"))
    got = global_ranks(rows, ["k"], {"a": True, "b": False})
    plain = rows.selectExpr("*", "rank() OVER (ORDER BY a DESC) AS a_rank",
                            "rank() OVER (ORDER BY b) AS b_rank")
    assert got.exceptAll(plain).count() == 0 and got.count() == 5000
    assert global_ranks(rows.limit(0), ["k"], {"a": True}).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_content_health_has_no_window_over_all_titles(spark):
    from events import make_events
    from playlens.operators import qos

    events = make_events(spark, [{"event_timestamp": "10:00:00", "content_id": c, "event_type": t,
                                  "end_reason": "ERROR" if c == "bad" else "COMPLETED"}
                                 for c in ("bad", None, *map(str, range(20)))
                                 for t in ("PLAY_START", "PLAYBACK_END")])
    health = qos.content_health(events)
    assert "SinglePartition" not in health._jdf.queryExecution().executedPlan().toString()
    rows = {r["content_id"]: r for r in health.collect()}
    assert len(rows) == 22 and rows["bad"]["health_rank"] == 1 and rows["bad"]["error_rank"] == 1
    assert {r["health_rank"] for c, r in rows.items() if c != "bad"} == {2}


def test_null_keys_keep_their_previous_row(spark):
    rows = [(None if n % 2 else "k", datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
             + datetime.timedelta(minutes=25 * n), n) for n in range(40)]
    frame = spark.createDataFrame(rows, "k string, at timestamp, n long")
    got = {r["n"]: r["prev"]["n"] if r["prev"] else None
           for r in with_previous(frame, ["k"], "at", "n", ["n"]).collect()}
    assert got == {n: n - 2 if n > 1 else None for n in range(40)}
