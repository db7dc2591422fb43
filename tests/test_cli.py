"""The command line jobs on a small warehouse."""

import datetime

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from checks.registry import with_payload_json
from playlens.__main__ import parse, run
from playlens.plans import layout, maintenance
from playlens.sources.tables import playback_events

NOW = datetime.datetime(2024, 1, 5, 21, 5, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    events = with_payload_json(playback_events(spark, SMALL))
    for half in ("event_timestamp < '2024-01-15'", "event_timestamp >= '2024-01-15'"):
        layout.write_history(events.filter(half), f"{root}/playback_events")
    return root


def job(spark, *arguments, now=NOW):
    return run(spark, parse(list(arguments)), now)


def test_hourly_defaults_to_the_previous_hour(spark, warehouse):
    assert job(spark, "hourly", "--root", warehouse) == 0
    hours = spark.read.parquet(f"{warehouse}/hourly_content_stats").select(
        "event_date", "event_hour").distinct().collect()
    assert [(str(d), h) for d, h in hours] == [("2024-01-05", 20)]


def test_hour_is_zero_when_only_a_date_is_given():
    options = parse(["hourly", "--root", "w", "--date", "2024-01-05"])
    assert options.date == ["2024-01-05"]


def test_backfill_and_maintain(spark, warehouse):
    assert job(spark, "backfill", "--root", warehouse, "--start-date", "2024-01-14",
               "--end-date", "2024-01-16") == 0
    daily = spark.read.parquet(f"{warehouse}/daily_content_stats")
    assert daily.select("event_date").distinct().count() == 3
    assert maintenance.warehouse_tables(spark, warehouse, "hourly_content_stats") == {
        f"{warehouse}/hourly_content_stats": ["event_date", "event_hour"]}
    before = daily.count()
    assert job(spark, "maintain", "--root", warehouse) == 0
    assert spark.read.parquet(f"{warehouse}/daily_content_stats").count() == before


def test_backfill_keeps_the_catalog(spark, warehouse):
    spark.sql("CREATE DATABASE IF NOT EXISTS plays")
    try:
        for end in ("2024-01-10", "2024-01-11"):
            assert job(spark, "backfill", "--root", warehouse, "--start-date", "2024-01-10",
                       "--end-date", end, "--database", "plays") == 0
        other = spark.newSession()
        for table in ("hourly_content_stats", "daily_content_stats"):
            days = other.table(f"plays.{table}").select("event_date").distinct().collect()
            assert {"2024-01-10", "2024-01-11"} <= {str(r[0]) for r in days}
    finally:
        spark.sql("DROP DATABASE IF EXISTS plays CASCADE")


def test_maintenance_reports_before_and_after(spark, scratch):
    for _ in range(3):
        spark.range(10).withColumn("p", F.lit(1)).repartition(2).write.mode("append").partitionBy(
            "p").parquet(f"{scratch}/t")
    row, = maintenance.maintenance_report(spark, {f"{scratch}/t": ["p"]})
    assert (row["done"], row["files_before"], row["files_after"]) == (True, 6, 1)
    assert row["bytes_before"] > row["bytes_after"] > 0
    assert spark.read.parquet(f"{scratch}/t").count() == 30


def test_freshness_code(spark, warehouse, scratch):
    last = datetime.datetime(2024, 1, 31, 0, 0, tzinfo=datetime.timezone.utc)
    assert job(spark, "fresh", "--root", warehouse, "--max-lag", "100000", now=last) == 0
    assert job(spark, "fresh", "--root", warehouse,
               now=datetime.datetime(2024, 2, 2, tzinfo=datetime.timezone.utc)) == 1
    assert job(spark, "fresh", "--root", scratch) == 1
