"""Replacing part of a stored table, repeatable without duplicates."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playlens.plans import files
from playlens.plans.layout import ensure_table, register_partitions, write_partitioned


def days_between(start: str, end: str) -> list[str]:
    first, last = datetime.date.fromisoformat(start), datetime.date.fromisoformat(end)
    return [str(first + datetime.timedelta(days=i)) for i in range((last - first).days + 1)]


def replace_scope(spark: SparkSession, df: DataFrame, path: str, partition_by: list[str],
                  scope: list[str], table: str | None = None) -> int:
    """Makes `df` the only content of the partition folders in `scope`.

    With `table`, the catalog's table at `path` is created if missing and learns of new and removed
    folders.

    `scope` holds folder names such as `event_date=2024-01-05`. New folders take
    over in the job's commit; folders of the scope that get no rows any more are
    removed. Returns the number of rows written, counted by the write itself.
    """
    if table:
        ensure_table(spark, table, df.schema, partition_by, path)
    before = _leaf_files(spark, path, scope, len(partition_by))
    counted = Observation()
    write_partitioned(df.observe(counted, F.count(F.lit(1)).alias("rows")), path, partition_by,
                      mode="overwrite")
    after = _leaf_files(spark, path, scope, len(partition_by))
    for folder, names in before.items():
        if after.get(folder) == names:  # nothing took its place
            files.delete(spark, f"{path}/{folder}")
    if table:
        register_partitions(spark, table)
    return counted.get["rows"]


def _leaf_files(spark: SparkSession, path: str, scope: list[str], depth: int
                ) -> dict[str, list[str]]:
    """File names per partition folder below the scope folders."""
    level = [folder for folder in scope if files.exists(spark, f"{path}/{folder}")]
    while level and level[0].count("/") + 1 < depth:
        level = [f"{folder}/{name}" for folder in level
                 for name in files.children(spark, f"{path}/{folder}")]
    return {folder: files.children(spark, f"{path}/{folder}") for folder in level}


def drop_expired(spark: SparkSession, path: str, as_of: str, days: int,
                 column: str = "event_date") -> list[str]:
    """Removes day folders wholly past the retention; returns their names."""
    oldest = str(datetime.date.fromisoformat(as_of) - datetime.timedelta(days=days))
    expired = [name for name in files.children(spark, path)
               if name.startswith(f"{column}=") and name.split("=", 1)[1] < oldest]
    for name in expired:
        files.delete(spark, f"{path}/{name}")
    return expired
