"""Current tables: one row per primary key, merged batch by batch in key buckets.

A table is a set of bucket folders by the first column of its primary key. Each bucket has a folder
per batch that touched it; the newest one holds all current rows of the bucket. A batch reads and
writes the buckets of its own keys only; files of all other buckets stay as they are. A key with a
third of all rows spreads over several files of its bucket, sorted by the primary key.

A batch may be repeated at any time: a bucket that has the batch's folder is done with it. The folder
before the newest is kept for readers that have listed it; older ones go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.operators.enrich import retained
from playlens.operators.ordered import latest_per_key
from playlens.plans import files
from playlens.plans.layout import key_bucket
from playlens.sources.schema import RETENTION_DAYS, TABLE_KEYS

BUCKETS = 64
KEPT_FOLDERS = 2

# Columns that decide which row of a primary key is the last; the batch decides ties.
ORDER = {"user_content_progress": ["last_watched", "event_id"]}


def batches_of(spark: SparkSession, path: str, bucket: int) -> list[int]:
    """Numbers of the batches that a bucket has a folder of, the newest last."""
    return sorted(int(name.split("=")[1])
                  for name in files.children(spark, f"{path}/bucket={bucket}")
                  if name.startswith("batch_id="))


def merge_batch(rows: DataFrame, path: str, table: str, batch_id: int, buckets: int = BUCKETS,
                as_of: str | None = None) -> list[int]:
    """Merges a batch into a current table; returns the buckets that were rewritten.

    With `as_of`, rows past the table's retention are left out of the rewritten buckets.
    """
    spark = rows.sparkSession
    keys, ts = TABLE_KEYS[table]
    placed = rows.withColumn("bucket", key_bucket(F.col(keys[0]), buckets))
    # At most one row per bucket.
    touched = sorted(r["bucket"] for r in placed.select("bucket").distinct().collect())
    known = {bucket: batches_of(spark, path, bucket) for bucket in touched}
    todo = [bucket for bucket in touched if batch_id not in known[bucket]]
    if not todo:
        return []
    fresh = placed.filter(F.col("bucket").isin(todo)).withColumn("__batch", F.lit(batch_id))
    stored = [f"{path}/bucket={b}/batch_id={known[b][-1]}" for b in todo if known[b]]
    if stored:
        fields = [*rows.schema.fields, T.StructField("bucket", T.IntegerType())]
        before = spark.read.option("basePath", path).schema(T.StructType(fields)).parquet(*stored)
        fresh = fresh.unionByName(before.drop("batch_id").withColumn("__batch", F.lit(-1)))
    merged = latest_per_key(fresh, list(keys), [*ORDER.get(table, []), "__batch"]).drop("__batch")
    if as_of:
        merged = retained(merged, ts, as_of, RETENTION_DAYS.get(table))
    (merged.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", F.col("bucket"))
           .sortWithinPartitions("bucket", *keys).write.mode("overwrite")
           .options(compression="zstd", partitionOverwriteMode="dynamic")
           .partitionBy("bucket", "batch_id").parquet(path))
    for bucket in todo:
        for old in batches_of(spark, path, bucket)[:-KEPT_FOLDERS]:
            files.delete(spark, f"{path}/bucket={bucket}/batch_id={old}")
    return todo


def read_current(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """The current rows of a table, of the buckets in `only` if given."""
    buckets = [int(name.split("=")[1]) for name in files.children(spark, path)
               if name.startswith("bucket=")]
    newest = {b: found[-1] for b in buckets if (found := batches_of(spark, path, b))}
    chosen = [b for b in newest if only is None or b in only]
    if not newest:
        raise FileNotFoundError(f"{path} has no bucket yet")
    read = lambda some: spark.read.option("basePath", path).parquet(
        *[f"{path}/bucket={b}/batch_id={newest[b]}" for b in some]).drop("bucket", "batch_id")
    return read(chosen) if chosen else read(list(newest)[:1]).limit(0)


def read_current_key(spark: SparkSession, path: str, key: str, value: str,
                     buckets: int = BUCKETS) -> DataFrame:
    """The current rows of one key: one folder of one bucket."""
    bucket = spark.range(1).select(key_bucket(F.lit(value), buckets).alias("b")).head()["b"]
    return read_current(spark, path, [bucket]).filter(F.col(key) == value)
