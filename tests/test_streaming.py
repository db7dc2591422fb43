"""Streams give what the batch gives."""

import json

import pytest
from conftest import SMALL
from events import as_set, at, make_events
from pyspark.sql import functions as F

from playlens.operators import lookups, metrics, quality, sessions, views
from playlens.plans import current, files, layout, maintenance, replace, rollup_jobs
from playlens.sources.schema import FLAT_EVENT
from playlens.sources.tables import playback_events
from playlens.streaming import jobs, sinks, sources

ONCE = {"trigger": {"availableNow": True}}


def land(events, path, name):
    """Puts one file of events into a source folder."""
    events.select(*FLAT_EVENT.fieldNames()).coalesce(1).write.parquet(f"{path}/{name}")
    return f"{path}/*"


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def flat(spark):
    return playback_events(spark, SMALL).withColumn("payload_json", F.lit(None).cast("string"))


def flush(spark):
    """A far later row, which moves the watermark past everything."""
    return make_events(spark, [{"event_timestamp": "2025-01-01 00:00:00", "user_id": "flush",
                                "content_id": "flush", "event_id": "flush"}])


def test_content_metrics(spark, scratch):
    events = flat(spark)
    source = land(events, f"{scratch}/in", "1")
    stream = sources.file_events(spark, source)
    run(jobs.content_metrics_job(stream, f"{scratch}/out", f"{scratch}/cp", **ONCE))
    land(flush(spark), f"{scratch}/in", "2")
    run(jobs.content_metrics_job(sources.file_events(spark, source), f"{scratch}/out",
                                 f"{scratch}/cp", **ONCE))
    expected = metrics.content_metrics(events)
    got = spark.read.parquet(f"{scratch}/out").select(*expected.columns)
    assert as_set(got.filter("content_id <> 'flush'")) == as_set(expected)


def test_late_rows(spark, scratch):
    """A row within the bound counts, one beyond it does not."""
    def row(time, event_id):
        return {"event_timestamp": time, "event_id": event_id, "event_type": "PLAY_START",
                "user_id": event_id}
    steps = [[row("10:00:00", "a"), row("10:06:00", "b")],      # watermark 10:04:30
             [row("10:01:00", "late but in time")],
             [row("10:20:00", "c")],                              # watermark 10:18:30
             [row("10:02:00", "too late")],
             [row("11:00:00", "d")]]
    for n, rows in enumerate(steps):
        source = land(make_events(spark, rows), f"{scratch}/in", str(n))
        run(jobs.content_metrics_job(sources.file_events(spark, source), f"{scratch}/out",
                                     f"{scratch}/cp", **ONCE))
    views_at = {str(r["window_start"].time()): r["view_count"]
                for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert views_at == {"10:00:00": 2, "10:05:00": 1, "10:20:00": 1}


def test_early_metrics_upsert(spark, scratch):
    for n, user in enumerate(("a", "b")):
        source = land(make_events(spark, [{"event_timestamp": "10:00:00", "user_id": user}]),
                      f"{scratch}/in", str(n))
        run(jobs.early_metrics_job(sources.file_events(spark, source), f"{scratch}/out",
                                   f"{scratch}/cp", **ONCE))
    log = spark.read.parquet(f"{scratch}/out")
    assert log.count() == 2
    latest = sinks.latest_rows(log, ["content_id", "window_start"], [])
    assert [r["unique_viewers"] for r in latest.collect()] == [2]


def test_early_metrics_are_exact(spark, scratch):
    """Many viewers, some seen again in a later batch."""
    one = make_events(spark, [{"event_timestamp": "10:00:00"}]).drop("user_id")
    parts = [one.crossJoin(spark.range(first, first + 20000).select(
        F.concat(F.lit("u"), "id").alias("user_id"))) for first in (0, 10000)]
    for n, part in enumerate(parts):
        source = land(part, f"{scratch}/in", str(n))
        run(jobs.early_metrics_job(sources.file_events(spark, source), f"{scratch}/out",
                                   f"{scratch}/cp", **ONCE))
    latest = sinks.latest_rows(spark.read.parquet(f"{scratch}/out"),
                               ["content_id", "window_start"], [])
    expected = metrics.content_metrics(parts[0].unionByName(parts[1]))
    assert as_set(latest.select(*expected.columns)) == as_set(expected)
    assert latest.first()["unique_viewers"] == 30000


def test_sessions(spark, scratch):
    events = flat(spark)
    source = land(events, f"{scratch}/in", "1")
    for extra in (None, flush(spark)):
        if extra is not None:
            land(extra, f"{scratch}/in", "2")
        run(jobs.sessions_job(sources.file_events(spark, source), f"{scratch}/out",
                              f"{scratch}/cp", gap="2 hours", **ONCE))
    expected = sessions.user_sessions(events, "2 hours")
    got = spark.read.parquet(f"{scratch}/out").select(*expected.columns)
    def rounded(df):
        return as_set(df.withColumn("avg_completion_percentage",
                                    F.round("avg_completion_percentage", 6)))
    assert rounded(got.filter("user_id <> 'flush'")) == rounded(expected)


def played(spark, *rows):
    """Events of user u1: (time, title, type)."""
    return make_events(spark, [{"event_timestamp": time, "content_id": title, "event_type": kind,
                                "event_id": f"{time}{title}{kind}"} for time, title, kind in rows])


def run_sessions(spark, scratch, batches, gap="30 minutes"):
    for n, batch in enumerate(batches):
        source = land(batch, f"{scratch}/in", str(n))
        run(jobs.sessions_job(sources.file_events(spark, source), f"{scratch}/out",
                              f"{scratch}/cp", gap=gap, **ONCE))
    return spark.read.parquet(f"{scratch}/out").drop("batch_id").filter("user_id <> 'flush'")


def test_disordered_sessions_equal_the_batch(spark, scratch):
    """Out of order within the bound: extended at both ends, bridged, titles counted once."""
    events = flat(spark).filter(F.pmod(F.col("event_id").cast("int"), F.lit(5)) == 0)
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    # Each day comes in three disordered batches; the watermark stays behind all of them.
    batches = [played(spark, ("2024-01-01 00:00:00", "c0", "PAUSE"))]
    batches += [events.filter(part == n) for n in range(3)]
    expected = sessions.user_sessions(events.unionByName(batches[0], True), "1 hour")
    for frame in batches[1:]:
        land(frame, f"{scratch}/in", f"all{id(frame)}")
    got = run_sessions(spark, scratch, [batches[0], flush(spark)], "1 hour")
    def rounded(df):
        return as_set(df.select(*expected.columns).withColumn(
            "avg_completion_percentage", F.round("avg_completion_percentage", 6)))
    assert rounded(got) == rounded(expected)


def test_sessions_bridged_by_a_later_batch(spark, scratch):
    got = run_sessions(spark, scratch, [
        played(spark, ("10:00:00", "a", "PLAY_START"), ("10:10:00", "b", "SEEK")),
        played(spark, ("10:10:01", "a", "PAUSE"), ("10:09:58", "c", "PAUSE")),
        played(spark, ("10:10:03", "b", "SEEK"), ("10:10:02", "d", "SEEK")), flush(spark)], "5 seconds")
    rows = {str(r["session_start"].time()): r for r in got.collect()}
    assert set(rows) == {"10:00:00", "10:09:58"}
    whole = rows["10:09:58"]
    assert (whole["total_events"], whole["content_count"], whole["seek_count"],
            whole["session_duration_ms"]) == (5, 4, 3, 5000)


def test_late_event_opens_a_session_of_its_own(spark, scratch):
    got = run_sessions(spark, scratch, [
        played(spark, ("10:00:00", "a", "PLAY_START")),
        played(spark, ("12:00:00", "b", "PLAY_START")),     # closes the first
        played(spark, ("10:05:00", "a", "PAUSE")), flush(spark)])
    rows = sorted((str(r["session_start"].time()), r["total_events"], r["session_duration_ms"])
                  for r in got.collect())
    assert rows == [("10:00:00", 1, 0), ("10:05:00", 1, 0), ("12:00:00", 1, 0)]


def test_hot_views(spark, scratch):
    events = flat(spark)
    halves = [events.filter("event_timestamp < '2024-01-15'"),
              events.filter("event_timestamp >= '2024-01-15'")]
    for n, half in enumerate(halves):
        source = land(half, f"{scratch}/in", str(n))
        run(jobs.hot_views_job(sources.file_events(spark, source), f"{scratch}/hot",
                               f"{scratch}/cp", **ONCE))
    log = spark.read.parquet(f"{scratch}/hot/user_content_progress")
    expected = views.user_content_progress(events)
    latest = sinks.latest_rows(log, ["user_id", "content_id"], ["last_watched", "event_id"])
    assert as_set(latest.select(*expected.columns)) == as_set(expected)
    for name, build in (("events_by_user", views.events_by_user),
                        ("continue_watching", views.continue_watching_log),
                        ("playback_quality_events", views.quality_events)):
        stored = spark.read.parquet(f"{scratch}/hot/{name}")
        assert as_set(stored.drop("batch_id")) == as_set(build(events))


def test_one_failing_view_does_not_stop_the_others(spark, scratch):
    def broken(events):
        raise ValueError("no")
    write = sinks.fan_out_to(scratch, {"broken": broken, "events_by_user": views.events_by_user})
    events = make_events(spark, [{"event_timestamp": "10:00:00"}])
    with pytest.raises(RuntimeError, match="broken"):
        write(events, 0)
    assert spark.read.parquet(f"{scratch}/events_by_user").count() == 1


def test_repeated_batch_counts_once(spark, scratch):
    write = sinks.fan_out_to(scratch)
    events = make_events(spark, [{"event_timestamp": "10:00:00"}])
    for _ in range(2):
        write(events, 7)
    assert spark.read.parquet(f"{scratch}/events_by_user").count() == 1


def test_history_stream_feeds_the_batch_jobs(spark, scratch):
    """Stream, roll-up, backfill, freshness, retention and maintenance share one history."""
    events = flat(spark)
    path, apart = f"{scratch}/history", f"{scratch}/batch"
    for n in range(4):
        part = events.filter(F.pmod(F.col("event_id").cast("int"), F.lit(4)) == n)
        source = land(part, f"{scratch}/in", str(n))
        run(jobs.history_job(sources.file_events(spark, source), path, f"{scratch}/cp", **ONCE))
    layout.write_history(events, apart)
    days = layout.history_days(spark, path)
    assert days == layout.history_days(spark, apart)
    hours = []
    for root in (path, apart):
        written = rollup_jobs.backfill(spark, root, f"{root}_h", f"{root}_d", days[0], days[-1])
        hours.append((written, as_set(spark.read.parquet(f"{root}_h").drop("processed_at"))))
    assert hours[0] == hours[1] and hours[0][0]["hourly"] > 0
    first = layout.read_history(spark, path).orderBy("event_timestamp").first()
    assert rollup_jobs.run_hour(spark, path, f"{scratch}/one", str(first["event_date"]),
                                first["event_hour"]) > 0
    assert layout.recent_history(spark, path).count() > 0
    tables = {path: layout.HISTORY_FOLDERS}
    assert maintenance.maintain_tables(spark, tables) == {path: True}
    assert layout.read_history(spark, path).count() == events.count()
    assert replace.drop_expired(spark, path, "2100-01-01", 7) == [f"event_date={d}" for d in days]


def test_history_batch_repeated_and_folded(spark, scratch):
    write, path = sinks.history_to(scratch), scratch
    batches = [make_events(spark, [{"event_id": str(n), "event_timestamp": f"10:0{n}:00"}])
               for n in range(3)]
    for n in (0, 1, 2, 2):
        write(batches[n], n)
    day = layout.history_days(spark, path)[0]
    assert layout.read_history(spark, path).count() == 3
    assert sinks.fold_history(spark, path, day) == 0  # the day is still open
    # A run that stopped after its folder was in place leaves rows twice; the next one repairs it.
    write(batches[0], 7)
    write(batches[1], 8)
    newest = make_events(spark, [{"event_id": "new", "event_timestamp": "10:09:00"}])
    write(newest, 9)
    assert layout.read_history(spark, path).count() == 6
    assert sinks.fold_history(spark, path, "9999-12-31") == 1
    assert layout.read_history(spark, path).count() == 4
    assert files.children(spark, f"{path}/event_date={day}") == ["batch_id=-2", "batch_id=9"]
    assert sinks.fold_history(spark, path, "9999-12-31") == 0
    write(newest, 9)  # the newest batch may be repeated, and counts once
    assert layout.read_history(spark, path).count() == 4


def test_overwrite_after_a_fold_keeps_the_folded_rows(spark, scratch):
    write = sinks.history_to(scratch)
    for n in range(4):
        write(make_events(spark, [{"event_id": f"{n}-{i}", "event_timestamp": f"10:0{n}:00"}
                                  for i in range(6)]), n)
    appended = make_events(spark, [{"event_id": f"a{i}", "event_timestamp": "11:00:00"}
                                   for i in range(12)])
    assert sinks.fold_history(spark, scratch, "9999-12-31") == 1
    for _ in range(2):
        layout.write_history(appended, scratch, "overwrite")
        assert layout.read_history(spark, scratch).count() == 36
    assert sinks.fold_history(spark, scratch, "9999-12-31") == 1
    layout.write_history(appended.limit(0), scratch, "overwrite")
    assert layout.read_history(spark, scratch).count() == 36


def test_fold_keeps_rows_without_an_id_apart(spark, scratch):
    write = sinks.history_to(scratch)
    for n in range(3):
        write(make_events(spark, [{"event_id": None, "event_timestamp": f"10:0{n}:0{i}"}
                                  for i in range(5)] + [{"event_id": "same",
                                                         "event_timestamp": "10:00:00"}]), n)
    sinks.fold_history(spark, scratch, "9999-12-31")
    rows = layout.read_history(spark, scratch)
    assert rows.filter("event_id IS NULL").count() == 15


def thirds(events):
    """Three batches that overlap in keys, the middle one first."""
    day = F.dayofmonth("event_timestamp")
    return [events.filter(day.between(11, 20)), events.filter(day <= 10), events.filter(day > 20)]


def data_files(spark, path):
    return {str(r["path"]) for r in files.listing(spark, path).select("path").collect()}


def test_current_tables_hold_the_latest_rows(spark, scratch):
    events, root = flat(spark), f"{scratch}/tables"
    for n, part in enumerate(thirds(events)):
        source = land(part, f"{scratch}/in", str(n))
        run(jobs.current_tables_job(sources.file_events(spark, source), root, f"{scratch}/cp",
                                    buckets=4, **ONCE))
    log = {name: build(events).withColumn("batch_id", F.lit(0))
           for name, build in sinks.HOT_VIEWS.items()}
    for name in sinks.HOT_VIEWS:
        expected = sinks.current_rows(log[name], name)
        got = current.read_current(spark, f"{root}/{name}")
        assert as_set(got.select(*expected.columns)) == as_set(expected), name
        assert got.count() == expected.count()


def test_a_batch_rewrites_its_own_buckets_only(spark, scratch):
    events = flat(spark)
    build, path = sinks.HOT_VIEWS["user_content_progress"], f"{scratch}/progress"
    current.merge_batch(build(events), path, "user_content_progress", 0, 8)
    before = data_files(spark, path)
    one = make_events(spark, [{"event_timestamp": "2024-02-01 10:00:00", "user_id": "user-1",
                               "content_id": "content-1", "duration_ms": 100, "position_ms": 77}])
    touched = current.merge_batch(build(one), path, "user_content_progress", 1, 8)
    assert len(touched) == 1
    after = data_files(spark, path)
    assert before <= after
    assert all(f"/bucket={touched[0]}/" in name for name in after - before)
    # The same batch again changes nothing, whatever had been written before it stopped.
    assert current.merge_batch(build(one), path, "user_content_progress", 1, 8) == []
    assert data_files(spark, path) == after
    # An older row of the key does not win, a third batch lets the oldest folder go.
    old = one.withColumn("event_timestamp", F.lit("2023-01-01").cast("timestamp")).withColumn(
        "position_ms", F.lit(1).cast("long"))
    current.merge_batch(build(old), path, "user_content_progress", 2, 8)
    assert current.batches_of(spark, path, touched[0]) == [1, 2]
    row = lookups.progress(current.read_current_key(spark, path, "user_id", "user-1", 8),
                           "user-1", "content-1").collect()
    assert [r["last_position"] for r in row] == [77]
    assert current.read_current(spark, path).count() == views.user_content_progress(
        events.unionByName(one, True)).count()


def test_lookups_on_current_tables_read_one_bucket(spark, scratch):
    events = flat(spark)
    for n, part in enumerate(thirds(events)):
        sinks.current_to(scratch, 8)(part, n)

    def stored(table, key, value):
        frame = current.read_current_key(spark, f"{scratch}/{table}", key, value, 8)
        assert len({name.split("/batch_id=")[0] for name in frame.inputFiles()}) == 1
        return frame

    user, content, session, day = "user-1", "content-1", "s-1-20240105", "2024-01-05"
    pairs = [
        (lookups.continue_watching, "continue_watching", "user_id", (user,),
         views.continue_watching_log),
        (lookups.progress, "user_content_progress", "user_id", (user, content),
         views.user_content_progress),
        (lookups.all_progress, "user_content_progress", "user_id", (user,),
         views.user_content_progress),
        (lookups.user_events, "events_by_user", "user_id", (user,), views.events_by_user),
        (lookups.session_events, "events_by_session", "session_id", (session,),
         views.events_by_session),
        (lookups.content_events, "events_by_content", "content_id", (content,),
         views.events_by_content),
        (lookups.quality_events, "playback_quality_events", "content_id", (content, day),
         views.quality_events)]
    for lookup, table, key, values, build in pairs:
        expected = lookup(build(events), *values)
        got = lookup(stored(table, key, values[0]), *values)
        assert [tuple(map(str, r)) for r in got.select(*expected.columns).collect()] == [
            tuple(map(str, r)) for r in expected.collect()], table
    assert stored("events_by_user", "user_id", "nobody").count() == 0


def test_fold_of_an_upsert_log(spark, scratch):
    write = sinks.fan_out_to(scratch)
    for batch, position in enumerate((10, 20, 30, 40)):
        write(make_events(spark, [{"event_timestamp": f"10:0{batch}:00", "duration_ms": 100,
                                   "position_ms": position}]), batch)
    path = f"{scratch}/user_content_progress"
    assert sinks.fold_table(spark, path, "user_content_progress") == 3
    log = spark.read.parquet(path)
    assert log.count() == 2
    assert sinks.current_rows(log, "user_content_progress").first()["last_position"] == 40


class Stopped(Exception):
    pass


@pytest.mark.parametrize("keyed", [True, False])
def test_fold_stopped_at_any_step(spark, tmp_path_factory, monkeypatch, keyed):
    """A run that stops leaves every row readable, and the next one leaves each once."""
    def names(path):
        return sorted(r["event_id"] for r in spark.read.parquet(path).collect())

    def current(path):
        log = spark.read.parquet(path)
        return sorted(r["event_id"] for r in sinks.current_rows(log, "events_by_session").collect())

    def fold(path):
        if keyed:
            return sinks.fold_table(spark, path, "events_by_session")
        return sinks.fold_batches(spark, path)

    batches = [views.events_by_session(make_events(spark, [
        {"event_id": str(n), "event_timestamp": f"10:0{n}:00"}])) for n in range(4)]
    done = {name: getattr(files, name) for name in ("rename", "delete")}
    for stop in range(20):
        path = str(tmp_path_factory.mktemp("log"))
        for n, rows in enumerate(batches):
            sinks.write_batch(rows, path, n)
        steps = []

        def step(name, *args, steps=steps, stop=stop):
            if len(steps) == stop:
                raise Stopped
            steps.append(name)
            done[name](*args)

        for name in done:
            monkeypatch.setattr(files, name, lambda *args, name=name, step=step: step(name, *args))
        try:
            fold(path)
            stopped = False
        except Stopped:
            stopped = True
        monkeypatch.undo()
        assert set(names(path)) == {"0", "1", "2", "3"} and current(path) == ["0", "1", "2", "3"]
        fold(path)
        assert names(path) == ["0", "1", "2", "3"]
        if not stopped:
            break
    assert not stopped and stop >= 4


def test_rows_written_twice_count_once_and_expire(spark, scratch):
    write = sinks.fan_out_to(scratch)
    old = make_events(spark, [{"event_timestamp": "2024-01-01 10:00:00", "event_id": "old"}])
    new = make_events(spark, [{"event_timestamp": "2024-01-10 10:00:00", "event_id": "new"}])
    for batch, events in enumerate((old, new, new, new)):
        write(events, batch)
    log = spark.read.parquet(f"{scratch}/events_by_session")
    def ids(as_of=None):
        rows = sinks.current_rows(log, "events_by_session", as_of)
        return sorted(r["event_id"] for r in rows.collect())
    assert log.count() == 4 and ids() == ["new", "old"]
    assert ids("2024-01-11 00:00:00") == ["new"]
    sinks.fold_table(spark, f"{scratch}/events_by_session", "events_by_session",
                     "2024-01-11 00:00:00")
    assert spark.read.parquet(f"{scratch}/events_by_session").count() == 2


@pytest.mark.parametrize("table", sorted(sinks.HOT_VIEWS))
def test_every_hot_view_has_its_key(spark, table):
    events = make_events(spark, [{"event_timestamp": "10:00:00"}])
    keys, ts = sinks.TABLE_KEYS[table]
    assert {*keys, ts} <= set(sinks.HOT_VIEWS[table](events).columns)


def test_ingest_splits_good_and_bad(spark, scratch):
    good = {"eventId": "e1", "eventType": "PAUSE", "timestamp": 1704067200123, "userId": "u",
            "deviceId": "d", "sessionId": "s", "contentId": "c"}
    values = [json.dumps(good), "broken", json.dumps({**good, "eventType": "REWIND"})]
    spark.createDataFrame([(v, at("10:00:00")) for v in values], sources.RAW_RECORD) \
        .write.parquet(f"{scratch}/in/1")
    records = sources.file_records(spark, f"{scratch}/in/*")
    run(jobs.ingest_job(records, f"{scratch}/events", f"{scratch}/bad", f"{scratch}/cp", **ONCE))
    assert spark.read.parquet(f"{scratch}/events").count() == 1
    bad = spark.read.parquet(f"{scratch}/bad")
    assert {r["reject_reason"] for r in bad.collect()} == {"unreadable", "unknown eventType"}
    decoded = sources.decoded_stream(sources.file_records(spark, f"{scratch}/in/*"))
    assert decoded.isStreaming and decoded.columns == FLAT_EVENT.fieldNames()


def test_duplicates_across_batches(spark, scratch):
    for n in range(2):
        source = land(make_events(spark, [
            {"event_timestamp": "10:00:00", "event_id": "x"},
            {"event_timestamp": "10:00:01", "event_id": f"y{n}"}]), f"{scratch}/in", str(n))
        run(jobs.deduplicated_job(sources.file_events(spark, source), f"{scratch}/out",
                                  f"{scratch}/cp", **ONCE))
    got = [r["event_id"] for r in spark.read.parquet(f"{scratch}/out").collect()]
    assert sorted(got) == ["x", "y0", "y1"]
    assert quality.deduplicated(make_events(spark, [
        {"event_timestamp": "10:00:00", "event_id": "x"}] * 2)).count() == 1


def test_enrichment_on_a_stream(spark, scratch):
    from playlens.operators.enrich import enrich_content
    from playlens.sources.tables import content_dimension

    source = land(flat(spark), f"{scratch}/in", "1")
    dimension = content_dimension(spark, SMALL)
    stream = enrich_content(sources.file_events(spark, source), dimension)
    run(jobs.start(stream, sinks.batches_to(f"{scratch}/out"), f"{scratch}/cp", **ONCE))
    got = spark.read.parquet(f"{scratch}/out").select("event_id", "title", "genre")
    assert as_set(got) == as_set(enrich_content(flat(spark), dimension)
                                 .select("event_id", "title", "genre"))


def test_kafka_options_need_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.kafka_records(spark, "host:9092", "playback-events", "lakehouse")


def sent(spark, *rows):
    """Events (id, time); other fields as they come."""
    return make_events(spark, [{"event_id": i, "event_timestamp": t} for i, t in rows])


def test_events_sent_again_days_later_are_dropped(spark, scratch, monkeypatch):
    """Only the days of possible copies are read; a repeated batch keeps its own rows."""
    write, path = sinks.history_to(f"{scratch}/history", once=True), f"{scratch}/history"
    write(sent(spark, ("a", "2024-01-01 10:00:00"), ("b", "2024-01-02 10:00:00"),
               ("b", "2024-01-02 10:00:00"), (None, "2024-01-01 11:00:00")), 0)
    assert layout.read_history(spark, path).count() == 3
    again = sent(spark, ("a", "2024-01-01 10:00:00"), ("c", "2024-01-02 12:00:00"),
                 ("d", "2024-01-05 09:00:00"), (None, "2024-01-01 11:00:00"))
    read = []
    plain = layout.read_history
    monkeypatch.setattr(layout, "read_history", lambda spark, path, days=None, batches=None:
                        read.extend(days) or plain(spark, path, days, batches))
    for _ in range(2):
        write(again, 1)
    monkeypatch.undo()
    assert set(read) == {"2024-01-01"}
    ids = sorted(str(r["event_id"]) for r in layout.read_history(spark, path).collect())
    assert ids == ["None", "None", "a", "b", "c", "d"]
    # Also after the first batches were merged.
    write(sent(spark, ("z", "2024-01-09 00:00:00")), 2)
    sinks.fold_history(spark, path, "2024-01-08")
    write(sent(spark, ("a", "2024-01-01 10:00:00"), ("d", "2024-01-05 09:00:00"),
               ("e", "2024-01-05 09:00:00")), 3)
    ids = sorted(str(r["event_id"]) for r in layout.read_history(spark, path).collect()
                 if r["event_id"])
    assert ids == ["a", "b", "c", "d", "e", "z"]


def test_history_stream_without_copies(spark, scratch):
    events = flat(spark)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for n, part in enumerate([events.filter(half == 0), events, events.filter(half == 1)]):
        source = land(part, f"{scratch}/in", str(n))
        run(jobs.history_job(sources.file_events(spark, source), f"{scratch}/h", f"{scratch}/cp",
                             once=True, **ONCE))
    stored = layout.read_history(spark, f"{scratch}/h")
    assert stored.count() == events.count() == stored.select("event_id").distinct().count()


def test_noisy_devices_of_a_stream_equal_the_batch(spark, scratch):
    rows = [{"event_timestamp": f"10:{i // 60:02d}:{i % 60:02d}", "event_id": str(i),
             "device_id": "loud" if i % 3 else "quiet"} for i in range(0, 600, 7)]
    events = make_events(spark, rows)
    for n in range(3):
        source = land(make_events(spark, rows[n * 30:(n + 1) * 30]), f"{scratch}/in", str(n))
        run(jobs.noisy_devices_job(sources.file_events(spark, source), f"{scratch}/alerts",
                                   f"{scratch}/bad", f"{scratch}/cp", limit=4, **ONCE))
    log = spark.read.parquet(f"{scratch}/alerts")
    latest = sinks.latest_rows(log, ["device_id", "window_start"], [])
    expected = quality.noisy_devices(events, 4, "1 minute", "10 seconds")
    assert as_set(latest.select(*expected.columns)) == as_set(expected) and expected.count() > 10
    bad = spark.read.parquet(f"{scratch}/bad")
    assert bad.count() == log.count() and {r["reject_reason"] for r in bad.collect()} == {
        "noisy device"}
    # State of windows behind the watermark is gone.
    run(jobs.noisy_devices_job(sources.file_events(spark, land(flush(spark), f"{scratch}/in", "9")),
                               f"{scratch}/alerts", f"{scratch}/bad", f"{scratch}/cp", limit=4, **ONCE))
    left = spark.read.format("statestore").load(f"{scratch}/cp").count()
    assert left <= 6
