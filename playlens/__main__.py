"""Batch jobs from the command line, for spark-submit or a scheduler.

    python -m playlens hourly   --root WAREHOUSE [--date 2024-01-05 [20]]
    python -m playlens backfill --root WAREHOUSE --start-date D --end-date D [--target all]
    python -m playlens maintain --root WAREHOUSE [--table NAME]
    python -m playlens fresh    --root WAREHOUSE [--max-lag 30]

With --database NAME, hourly and backfill keep the catalog's tables of that database up to date.

The warehouse folder holds `playback_events`, `hourly_content_stats` and
`daily_content_stats`.
"""

from __future__ import annotations

import argparse
import datetime
import logging

from pyspark.sql import SparkSession

from playlens.operators import quality
from playlens.plans import maintenance, rollup_jobs
from playlens.plans.layout import newest_day, recent_history
from playlens.session import build_session

log = logging.getLogger("playlens")

EVENTS, HOURLY, DAILY = "playback_events", "hourly_content_stats", "daily_content_stats"
TARGETS = {HOURLY: "hourly", DAILY: "daily", "all": "all"}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="playlens")
    jobs = parser.add_subparsers(dest="job", required=True)
    hourly = jobs.add_parser("hourly", help="aggregate one hour, the previous one by default")
    hourly.add_argument("--date", nargs="+", metavar=("DATE", "HOUR"))
    backfill = jobs.add_parser("backfill", help="recompute a date range")
    backfill.add_argument("--start-date", required=True)
    backfill.add_argument("--end-date", required=True)
    backfill.add_argument("--target", choices=list(TARGETS), default="all")
    maintain = jobs.add_parser("maintain", help="compact small files")
    maintain.add_argument("--table")
    fresh = jobs.add_parser("fresh", help="exit 1 when the newest event is too old")
    fresh.add_argument("--max-lag", type=float, default=30.0, help="minutes")
    for job in (hourly, backfill):
        job.add_argument("--database", help="of the catalog's tables")
    for job in (hourly, backfill, maintain, fresh):
        job.add_argument("--root", required=True, help="warehouse folder")
    return parser.parse_args(arguments)


def named(database: str | None, table: str) -> str | None:
    return f"{database}.{table}" if database else None


def run(spark: SparkSession, options: argparse.Namespace,
        now: datetime.datetime | None = None) -> int:
    """Runs one job; returns the exit code."""
    now = now or datetime.datetime.now(datetime.timezone.utc)
    root = options.root.rstrip("/")
    events = f"{root}/{EVENTS}"
    if options.job == "hourly":
        if options.date:
            date, hour = options.date[0], int(options.date[1]) if len(options.date) > 1 else 0
        else:
            date, hour = rollup_jobs.previous_hour(now)
        rows = rollup_jobs.run_hour(spark, events, f"{root}/{HOURLY}", date, hour,
                                    named(options.database, HOURLY))
        log.info("%s hour %d: %d titles", date, hour, rows)
    elif options.job == "backfill":
        written = rollup_jobs.backfill(spark, events, f"{root}/{HOURLY}", f"{root}/{DAILY}",
                                       options.start_date, options.end_date,
                                       TARGETS[options.target],
                                       {"hourly": named(options.database, HOURLY),
                                        "daily": named(options.database, DAILY)})
        for table, rows in written.items():
            log.info("%s: %d rows", table, rows)
    elif options.job == "maintain":
        report = maintenance.maintenance_report(
            spark, maintenance.warehouse_tables(spark, root, options.table))
        for row in report:
            log.info("%(table)s: %(files_before)s files, %(bytes_before)s bytes, then "
                     "%(files_after)s files, %(bytes_after)s bytes", row)
        return 0 if all(row["done"] for row in report) else 1
    else:
        if newest_day(spark, events) is None:
            return 1
        as_of = now.strftime("%Y-%m-%d %H:%M:%S")
        state = quality.freshness(recent_history(spark, events), as_of, options.max_lag).first()
        log.info("latest event %s, %s minutes old", state["latest_event"], state["lag_minutes"])
        return 1 if state["is_stale"] else 0
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    chosen = parse()
    session = build_session(f"playlens {chosen.job}")
    try:
        raise SystemExit(run(session, chosen))
    finally:
        session.stop()
