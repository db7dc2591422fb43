"""Which events a history has: membership filters per day, beside the history's folders.

An event sent again carries its own time, so a copy belongs to the day of the first one. Every batch
leaves bit maps of its event ids for each of its days. A later batch reads the maps of its own days;
ids that hit no bit are new, only the others are compared with the stored ids, of the days that have
a hit. Maps are joined on their number, rows are never gathered.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions import expr as X
from playlens.plans import files, layout

# Bits per day: at most 16 MB of maps for a day, 32,768 bits a row, and only rows that have a bit.
DAY_BITS = 1 << 27


def maps_path(history: str) -> str:
    return f"{history.rstrip('/')}_seen"


def _slot() -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(DAY_BITS))


def remember(events: DataFrame, history: str, batch_id: int) -> None:
    """Stores the batch's maps; a repeated batch replaces its own."""
    maps = events.filter("event_id IS NOT NULL").groupBy(
        X.event_date().alias("event_date"), F.bitmap_bucket_number(_slot()).alias("number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_slot())).alias("bits"))
    layout.write_partitioned(maps.withColumn("batch_id", F.lit(batch_id)), maps_path(history),
                             layout.HISTORY_FOLDERS, "overwrite")


def other_batches(spark: SparkSession, path: str, day: str, batch_id: int) -> list[int]:
    names = files.children(spark, f"{path}/event_date={day}")
    return [n for n in (int(name.split("=")[1]) for name in names if name.startswith("batch_id="))
            if n != batch_id]


def unseen(events: DataFrame, history: str, batch_id: int) -> DataFrame:
    """The events of a batch that the history does not have, each id once.

    What the batch itself has stored before a stop does not count. Events without an id or a time
    pass.
    """
    spark = events.sparkSession
    day = X.event_date().cast("string")
    known = events.filter(F.col("event_id").isNotNull() & F.col("event_timestamp").isNotNull())
    nameless = events.filter(F.col("event_id").isNull() | F.col("event_timestamp").isNull())
    once = known.dropDuplicates(["event_id"]).withColumns({"__day": day, "__slot": _slot()})
    # At most one row per day of the batch.
    days = sorted(r["__day"] for r in once.select("__day").distinct().collect())
    maps = maps_path(history)
    folders = [f"{maps}/event_date={d}/batch_id={n}" for d in days
               for n in other_batches(spark, maps, d, batch_id)]
    if not folders:
        return once.drop("__day", "__slot").unionByName(nameless)
    stored = spark.read.option("basePath", maps).schema(
        "event_date string, number long, bits binary").parquet(*folders)
    merged = stored.groupBy(F.col("event_date").alias("__day"), F.col("number").alias("__number")).agg(
        F.bitmap_or_agg("bits").alias("__bits"))
    bit = F.bitmap_bit_position(F.col("__slot"))
    byte = F.conv(F.hex(F.substring("__bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    hit = F.coalesce(F.getbit(byte.cast("bigint"), (bit % 8).cast("int")) == 1, F.lit(False))
    marked = once.withColumn("__number", F.bitmap_bucket_number(F.col("__slot"))).join(
        merged, ["__day", "__number"], "left").withColumn("__hit", hit).drop(
        "__number", "__bits", "__slot").persist(StorageLevel.MEMORY_AND_DISK)
    hits = marked.filter("__hit")
    concerned = sorted(r["__day"] for r in hits.select("__day").distinct().collect())
    new = marked.filter("NOT __hit")
    if concerned:
        new = new.unionByName(hits.join(stored_ids(spark, history, concerned, batch_id), "event_id",
                                        "left_anti"))
    return new.drop("__day", "__hit").select(*events.columns).unionByName(nameless)


def stored_ids(spark: SparkSession, history: str, days: list[str], batch_id: int) -> DataFrame:
    """Ids that the history has on these days, but for those of one batch."""
    parts = [layout.read_history(spark, history, [d], others).select("event_id") for d in days
             if (others := other_batches(spark, history, d, batch_id))]
    found = parts[0] if parts else spark.createDataFrame([], "event_id string")
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
