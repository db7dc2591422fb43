"""Runs registered queries beside their SQL and compares the values."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def open_tables(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def _multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, build, sql: str, sf_dir: str) -> tuple[str | None, int]:
    """None and the row count when equal, else what differs."""
    df = build(spark, sf_dir)
    ours = [tuple(row) for row in df.collect()]
    cursor = connection.execute(sql)
    their_columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(their_columns):
        return f"columns {sorted(set(df.columns) ^ set(their_columns))}", len(ours)
    left, right = _multiset(df.columns, ours), _multiset(their_columns, theirs)
    if left != right:
        extra, missing = list((left - right))[:2], list((right - left))[:2]
        return (f"rows {len(ours)} vs {len(theirs)}; columns {sorted(df.columns)}; "
                f"only ours {extra}; only SQL {missing}"), len(ours)
    return None, len(ours)


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from checks.oracle import ORACLE_SQL
    from checks.registry import QUERIES
    from playlens.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("compare", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = open_tables(sf_dir), 0
    for name, build in QUERIES.items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            problem, rows = compare(spark, connection, build, ORACLE_SQL[name], sf_dir) \
                if name in ORACLE_SQL else (None, build(spark, sf_dir).count())
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={rows} "
              f"{time.time() - started:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
