"""Stored tables: layouts, replacement, backfill, upkeep."""

import datetime

import pytest
from conftest import SMALL
from events import as_set, make_events
from pyspark.sql import functions as F

from checks.registry import with_payload_json
from playlens.operators import lookups, rollup, views
from playlens.plans import files, layout, maintenance, replace, rollup_jobs
from playlens.session import checkpoint_root
from playlens.sources.tables import playback_events


@pytest.fixture(scope="module")
def history_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("history") / "events")
    layout.write_history(with_payload_json(playback_events(spark, SMALL)), path)
    return path


def stored(spark, path):
    return spark.read.parquet(path).drop("processed_at")


def test_history_round_trip(spark, history_path):
    history = layout.read_history(spark, history_path)
    events = with_payload_json(playback_events(spark, SMALL))
    assert as_set(history.select("event_id", "payload_json", "event_date", "event_hour")) == \
        as_set(views.history_events(events).select("event_id", "payload_json", "event_date",
                                                   "event_hour"))


def test_day_filter_reads_one_folder(spark, history_path):
    day = rollup.hourly_content_stats(layout.read_history(spark, history_path),
                                      date="2024-01-05", hour=20)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(event_hour), EqualTo(event_hour,20)" in plan


def test_recent_rows_read_recent_folders(spark, history_path, scratch):
    assert layout.newest_day(spark, history_path) == "2024-01-30"
    assert layout.newest_day(spark, f"{scratch}/none") is None
    recent = layout.recent_history(spark, history_path, days=2)
    days = {str(r["event_date"]) for r in recent.select("event_date").distinct().collect()}
    assert days == {"2024-01-29", "2024-01-30"}
    active = lookups.active_sessions(layout.read_history(spark, history_path),
                                     "2024-01-31 00:00:00")
    plan = active._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert as_set(active) == as_set(lookups.active_sessions(
        with_payload_json(playback_events(spark, SMALL)), "2024-01-31 00:00:00"))


def test_append_keeps_what_is_there(spark, scratch):
    events = make_events(spark, [{"event_timestamp": "10:00:00"}])
    for _ in range(2):
        layout.write_history(events, f"{scratch}/h")
    assert layout.read_history(spark, f"{scratch}/h").count() == 2


def test_hourly_replace_is_repeatable(spark, history_path, scratch):
    out = f"{scratch}/hourly"
    counts = {rollup_jobs.run_hour(spark, history_path, out, "2024-01-05", 20)
              for _ in range(2)}
    rollup_jobs.run_hour(spark, history_path, out, "2024-01-05", 21)
    events = playback_events(spark, SMALL)
    expected = rollup.hourly_content_stats(events, date="2024-01-05", hour=20)
    got = stored(spark, out).filter("event_hour = 20")
    assert counts == {expected.count()}
    assert as_set(got.select(expected.columns)) == as_set(expected)
    assert stored(spark, out).filter("event_hour = 21").count() > 0


def test_empty_source_changes_nothing(spark, history_path, scratch):
    out = f"{scratch}/hourly"
    assert rollup_jobs.run_hour(spark, f"{scratch}/none", out, "2024-01-05", 20) == 0
    assert rollup_jobs.run_hour(spark, history_path, out, "2030-01-05", 20) == 0
    assert rollup_jobs.backfill(spark, history_path, out, f"{scratch}/d", "2030-01-01",
                                "2030-01-02") == {"hourly": 0, "daily": 0}
    assert not files.exists(spark, out)


def test_previous_hour_crosses_midnight():
    assert rollup_jobs.previous_hour(datetime.datetime(2024, 1, 2, 0, 5)) == ("2024-01-01", 23)


def test_backfill_replace(spark, history_path, scratch):
    hourly, daily = f"{scratch}/hourly", f"{scratch}/daily"
    runs = [rollup_jobs.backfill(spark, history_path, hourly, daily, "2024-01-03", "2024-01-05")
            for _ in range(2)]
    events = playback_events(spark, SMALL)
    frames = rollup_jobs.backfill_frames(events, "2024-01-03", "2024-01-05")
    assert runs[0] == runs[1] == {name: df.count() for name, df in frames.items()}
    assert as_set(stored(spark, hourly).select(frames["hourly"].columns)) == \
        as_set(frames["hourly"])
    assert as_set(stored(spark, daily).select(frames["daily"].columns)) == as_set(frames["daily"])


def test_backfill_targets(spark, history_path, scratch):
    with pytest.raises(ValueError):
        rollup_jobs.backfill(spark, history_path, "h", "d", "2024-01-03", "2024-01-03", "weekly")
    only = rollup_jobs.backfill(spark, history_path, f"{scratch}/h", f"{scratch}/d",
                                "2024-01-03", "2024-01-03", "hourly")
    assert set(only) == {"hourly"} and not files.exists(spark, f"{scratch}/d")


def test_replace_drops_folders_without_rows(spark, scratch):
    path = f"{scratch}/t"
    def frame(*rows):
        return spark.createDataFrame(list(rows), "v int, event_date string, event_hour int")
    scope = ["event_date=2024-01-01", "event_date=2024-01-02"]
    keys = ["event_date", "event_hour"]
    replace.replace_scope(spark, frame((1, "2024-01-01", 5), (2, "2024-01-02", 6),
                                       (3, "2024-01-03", 7)), path, keys, scope)
    written = replace.replace_scope(spark, frame((9, "2024-01-01", 4)), path, keys, scope)
    left = {(r["v"], r["event_hour"]) for r in spark.read.parquet(path).collect()}
    assert written == 1 and left == {(9, 4), (3, 7)}


def test_rebuild_and_swap(spark, history_path, scratch):
    assert rollup_jobs.rebuild_and_swap(spark, history_path, f"{scratch}/v2", "hourly_live",
                                        "2024-01-01", "2024-01-31")
    total = spark.table("hourly_live").agg(F.sum("total_events")).first()[0]
    assert total == playback_events(spark, SMALL).count()


def test_failed_validation_keeps_the_old_view(spark, history_path, scratch, monkeypatch):
    spark.range(3).createOrReplaceTempView("hourly_kept")
    halve = rollup.hourly_content_stats
    monkeypatch.setattr(rollup, "hourly_content_stats",
                        lambda events, **kw: halve(events.filter("event_hour < 12"), **kw))
    assert not rollup_jobs.rebuild_and_swap(spark, history_path, f"{scratch}/v3", "hourly_kept",
                                            "2024-01-01", "2024-01-31")
    assert spark.table("hourly_kept").count() == 3


def test_hot_cold_reconciliation(spark, history_path):
    events = playback_events(spark, SMALL)
    history = layout.read_history(spark, history_path)
    assert rollup_jobs.reconciles(views.events_by_content(events), history, ["content_id"])
    assert not rollup_jobs.reconciles(views.quality_events(events), history, ["content_id"])


def test_two_stores_in_one_query(spark, history_path):
    layout.read_history(spark, history_path).createOrReplaceTempView("cold_events")
    views.user_content_progress(playback_events(spark, SMALL)).createOrReplaceTempView("hot")
    joined = spark.sql("SELECT count(*) AS n FROM hot JOIN cold_events USING "
                       "(user_id, content_id)").first()["n"]
    assert joined > 0


def test_keyed_view_lookup(spark, scratch):
    view = views.events_by_user(playback_events(spark, SMALL))
    layout.write_keyed_view(view, f"{scratch}/v", "user_id", ["timestamp", "event_id"], 8, 4)
    found = layout.read_key(spark, f"{scratch}/v", "user_id", "user-1", 8)
    assert as_set(lookups.user_events(found, "user-1").select(view.columns)) == \
        as_set(lookups.user_events(view, "user-1"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(user_id,user-1)" in plan


def test_hot_key_is_spread_over_files(spark, scratch):
    events = make_events(spark, [
        {"event_timestamp": f"{h:02d}:{m:02d}:00"} for h in range(10) for m in range(60)])
    layout.write_keyed_view(views.events_by_user(events), f"{scratch}/v", "user_id",
                            ["timestamp", "event_id"], 8, 4)
    sizes = files.listing(spark, f"{scratch}/v")
    assert sizes.count() >= 3


def test_ensure_table(spark, scratch):
    schema = layout.history_schema()
    for _ in range(2):
        layout.ensure_table(spark, "history_table", schema, ["event_date"], f"{scratch}/table")
    assert spark.table("history_table").columns[-1] == "event_date"
    assert "history_table" in {t.name for t in spark.catalog.listTables()}
    spark.sql("DROP TABLE history_table")


def small_files(spark, path, times=6):
    events = make_events(spark, [
        {"event_timestamp": f"2024-01-0{d} 10:00:00", "event_id": f"{d}-{i}"}
        for d in (1, 2) for i in range(40)])
    for _ in range(times):
        layout.write_history(events, path)


def test_compaction_keeps_rows_and_cuts_files(spark, scratch):
    path = f"{scratch}/h"
    small_files(spark, path)
    before = maintenance.table_stats(spark, path).first()
    rows = sorted(layout.read_history(spark, path).collect())
    assert maintenance.compact_partitions(spark, path, layout.HISTORY_FOLDERS) == 2
    after = maintenance.table_stats(spark, path).first()
    assert sorted(layout.read_history(spark, path).collect()) == rows
    assert (before["file_count"], after["file_count"]) == (12, 2)
    assert before["record_count"] == after["record_count"] == 480
    assert after["total_size_mb"] < 1
    assert maintenance.compact_partitions(spark, path, layout.HISTORY_FOLDERS) == 0


def test_compaction_to_several_files(spark, scratch):
    path = f"{scratch}/h"
    small_files(spark, path, times=8)
    maintenance.compact_partitions(spark, path, layout.HISTORY_FOLDERS, target_bytes=20_000,
                                   sort_by=["user_id", "event_timestamp"])
    counts = {r["partition"]: r["file_count"]
              for r in maintenance.partition_stats(spark, path).collect()}
    assert set(counts) == {"event_date=2024-01-01/batch_id=-1",
                           "event_date=2024-01-02/batch_id=-1"}
    assert all(1 < n < 8 for n in counts.values())
    assert maintenance._jobs([('a', 3), ('b', 2), ('c', 9), ('d', 1)], 5) == [
        [('a', 3, 0), ('b', 2, 3)], [('c', 9, 0)], [('d', 1, 0)]]
    assert layout.read_history(spark, path).count() == 640


def test_compaction_without_partitions(spark, scratch):
    path = f"{scratch}/flat"
    spark.range(100).repartition(5).write.parquet(path)
    assert maintenance.compact_partitions(spark, path, []) == 1
    assert maintenance.table_stats(spark, path).first()["file_count"] == 1
    assert spark.read.parquet(path).count() == 100


def test_one_bad_table_does_not_stop_the_rest(spark, scratch):
    small_files(spark, f"{scratch}/good", 2)
    outcome = maintenance.maintain_tables(
        spark, {f"{scratch}/missing": [], f"{scratch}/good": ["event_date"]})
    assert outcome == {f"{scratch}/missing": False, f"{scratch}/good": True}


def test_expired_days_are_dropped(spark, scratch):
    path = f"{scratch}/h"
    small_files(spark, path, 1)
    assert replace.drop_expired(spark, path, "2024-01-09", 7) == ["event_date=2024-01-01"]
    assert files.children(spark, path) == ["event_date=2024-01-02"]


def test_checkpoint_root_prefers_the_cluster():
    class Session:
        def __init__(self, **settings):
            self.conf = settings

    assert checkpoint_root(Session(**{"spark.checkpoint.dir": "/shared/folder/"}), "/own") == \
        "/shared/folder"
    assert checkpoint_root(Session(), "/own") == "/own"
    with pytest.raises(ValueError):
        checkpoint_root(Session())


def test_a_swap_is_seen_by_other_sessions(spark, scratch):
    events = make_events(spark, [{"event_timestamp": "10:00:00"}, {"event_timestamp": "11:00:00"}])
    layout.write_history(events, f"{scratch}/history")
    other = spark.newSession()
    try:
        for version in ("a", "b"):
            assert rollup_jobs.rebuild_and_swap(spark, f"{scratch}/history", f"{scratch}/{version}",
                                                "hourly_now", "2024-01-01", "2024-01-01")
            assert other.table("hourly_now").count() == 2
            assert f"{scratch}/{version}/" in other.table("hourly_now").inputFiles()[0]
    finally:
        spark.sql("DROP VIEW IF EXISTS hourly_now")


def test_written_partitions_are_in_the_catalog(spark, scratch):
    other, path = spark.newSession(), f"{scratch}/table"
    rows = lambda day, n: spark.range(n).select("id", F.lit(day).cast("date").alias("event_date"))
    try:
        for day, n in (("2024-01-01", 3), ("2024-01-02", 4), ("2024-01-01", 5)):
            replace.replace_scope(spark, rows(day, n), path, ["event_date"], [f"event_date={day}"],
                                  table="days_of_rows")
        assert other.table("days_of_rows").count() == 9
        assert len(other.sql("SHOW PARTITIONS days_of_rows").collect()) == 2
        replace.replace_scope(spark, rows("2024-01-01", 0), path, ["event_date"],
                              ["event_date=2024-01-01"], table="days_of_rows")
        other.catalog.refreshTable("days_of_rows")
        assert other.table("days_of_rows").count() == 4
    finally:
        spark.sql("DROP TABLE IF EXISTS days_of_rows")


def test_a_stopped_swap_is_put_back(spark, scratch):
    path = f"{scratch}/w/dim"
    spark.range(20).repartition(6).write.parquet(path)
    files.rename(spark, path, f"{path}__retired")  # stopped between the renames
    assert maintenance.warehouse_tables(spark, f"{scratch}/w") == {path: []}
    assert spark.read.parquet(path).count() == 20
    assert maintenance.maintain_tables(spark, {path: []}) == {path: True}
    spark.range(1).write.parquet(f"{path}__retired")  # left over by a finished swap
    spark.range(5).repartition(5).write.mode("append").parquet(path)
    assert maintenance.maintain_tables(spark, {path: []}) == {path: True}
    assert spark.read.parquet(path).count() == 25
    assert maintenance.warehouse_tables(spark, f"{scratch}/w") == {path: []}


def test_one_changed_value_is_found(spark, scratch):
    from playlens.operators import contents

    rows = spark.range(3000).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("day"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 2).alias("a"), F.lit("x").alias("b"))
    rows.repartition(3).write.parquet(f"{scratch}/left")
    changed = rows.withColumn("a", F.when(F.col("id") == 1234, F.lit(-1)).otherwise(F.col("a")))
    changed.repartition(7, "b").write.parquet(f"{scratch}/right")
    left, right = (spark.read.parquet(f"{scratch}/{side}") for side in ("left", "right"))
    args = ("day", ["id"], ["a", "b"])
    assert contents.differing(left, left, *args).count() == 0
    assert contents.differing(left, rows, *args).count() == 0
    assert contents.differing(left, right, *args).count() == 1
    found = contents.differences(left, right, *args).collect()
    assert [(r["id"], r["column"], r["left_value"], r["right_value"]) for r in found] == [
        (1234, "a", "2468", "-1")]
    moved = right.withColumn("b", F.when(F.col("id") % 1000 != 0, F.col("b"))).filter("id <> 6").union(
        right.filter("id = 8"))
    got = {(r["id"], r["column"]) for r in contents.differences(left, moved, *args).collect()}
    assert got == {(1234, "a"), (6, "only_left"), (8, "copies"), (0, "b"), (1000, "b"), (2000, "b")}


def test_sketches_of_days_merge_with_small_rank_error(spark):
    from playlens.operators import reports

    events = make_events(spark, [{"event_timestamp": "10:00:00"}]).drop(
        "bitrate_kbps", "event_timestamp", "content_id").crossJoin(spark.range(200_000).select(
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 5 * 86400).alias("event_timestamp"),
            F.concat(F.lit("c"), F.col("id") % 3).alias("content_id"),
            F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("int").alias("bitrate_kbps")))
    stored = reports.bitrate_sketches(events)
    assert stored.count() == 15
    merged = reports.merged_distribution(stored).filter("measure = 'bitrate_kbps'").first()
    assert merged["samples"] == 200_000
    exact = reports.bitrate_distribution(events).filter("measure = 'bitrate_kbps'").first()
    for point in (5, 25, 50, 75, 95):
        low = events.filter(F.col("bitrate_kbps") <= merged[f"approx_p{point:02d}"]).count()
        assert abs(low / 200_000 - point / 100) < 0.01
        assert abs(merged[f"approx_p{point:02d}"] - exact[f"p{point:02d}"]) < 1000
    per_title = reports.merged_distribution(
        stored.filter("event_date < '2024-01-03'"), ["content_id"])
    assert per_title.count() == 3 and reports.merged_distribution(stored.limit(0)).count() == 0


def test_catalogue_is_read_as_it_was(spark, scratch):
    from playlens.operators.enrich import enrich_content_as_of

    at = lambda text: datetime.datetime.fromisoformat(text).replace(tzinfo=datetime.timezone.utc)
    versions = spark.createDataFrame([
        ("c1", at("2024-01-01 00:00:00"), "Old", "drama", 1000, 900),
        ("c1", at("2024-01-01 12:00:00"), "New", "comedy", 2000, 1900)],
        "content_id string, valid_from timestamp, catalog_title string, genre string, "
        "catalog_duration_ms long, credits_ms long")
    events = make_events(spark, [
        {"event_timestamp": "2023-12-31 23:00:00", "event_id": "before"},
        {"event_timestamp": "11:59:59", "event_id": "old"}, {"event_timestamp": "12:00:00",
                                                             "event_id": "new"},
        {"event_timestamp": "12:00:00", "event_id": "other", "content_id": "c2"}])
    def seen(frame):
        return {r["event_id"]: (r["title"], r["genre"], r["credits_ms"]) for r in frame.collect()}
    expected = {"before": (None, None, None), "old": ("Old", "drama", 900),
                "new": ("New", "comedy", 1900), "other": (None, None, None)}
    assert seen(enrich_content_as_of(events, versions)) == expected
    events.write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{scratch}/in")
    query = enrich_content_as_of(stream, versions).writeStream.format("parquet").option(
        "checkpointLocation", f"{scratch}/cp").trigger(availableNow=True).start(f"{scratch}/out")
    query.awaitTermination()
    assert seen(spark.read.parquet(f"{scratch}/out")) == expected


def test_days_of_the_hourly_table_are_listed_alone(spark, scratch):
    for day in ("2024-01-01", "2024-01-02", "2024-01-05"):
        spark.range(3).withColumns({"event_hour": F.lit(4)}).write.parquet(
            f"{scratch}/h/event_date={day}")
    found = rollup_jobs.read_days(spark, f"{scratch}/h", "2024-01-02", "2024-01-04")
    assert found.count() == 3 and all("event_date=2024-01-02" in f for f in found.inputFiles())
    assert rollup_jobs.read_days(spark, f"{scratch}/h", "2024-01-03", "2024-01-04") is None
    assert not rollup_jobs.has_rows(spark, f"{scratch}/h", "2024-01-03", "2024-01-04")
