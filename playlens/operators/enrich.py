"""Joins of the event stream with dimensions, and of the hot with the cold store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_dimension(events: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join on a dimension that has one row per key; batch or stream-static.

    No broadcast hint: Spark broadcasts the dimension only when its size, known
    from the files or measured at run time, is under
    `spark.sql.autoBroadcastJoinThreshold`. A larger dimension is joined by
    shuffle, where adaptive execution splits the partition of a hot key.
    """
    return events.join(dimension, key, "left")


def enrich_content(events: DataFrame, contents: DataFrame) -> DataFrame:
    """Adds title, genre and duration of the catalogue; the event's own come first."""
    joined = with_dimension(events, contents, "content_id")
    return (joined.withColumn("title", F.coalesce("title", "catalog_title"))
                  .withColumn("duration_ms", F.coalesce("duration_ms", "catalog_duration_ms")))


def enrich_content_as_of(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Adds title, genre, duration and credits time of the catalogue as they were at the event.

    `versions` has content_id, valid_from, catalog_title, genre, catalog_duration_ms, credits_ms; the
    latest version not after the event counts, null before the first. The versions of a title are one
    sorted list beside its events, so the join has one row per title and multiplies nothing; it works
    on streams, too. The event's own title and duration come first.
    """
    facts = ["catalog_title", "genre", "catalog_duration_ms", "credits_ms"]
    listed = versions.groupBy("content_id").agg(F.array_sort(F.collect_list(
        F.struct("valid_from", *facts))).alias("versions"))
    joined = with_dimension(events, listed, "content_id")
    valid = F.filter("versions", lambda v: v["valid_from"] <= F.col("event_timestamp"))
    newest = F.when(F.size(valid) > 0, F.element_at(valid, -1))
    found = joined.withColumn("version", newest).select(
        *events.columns, *[F.col(f"version.{name}").alias(name) for name in facts])
    return (found.withColumn("title", F.coalesce("title", "catalog_title"))
                 .withColumn("duration_ms", F.coalesce("duration_ms", "catalog_duration_ms")))


def enrich_device(events: DataFrame, devices: DataFrame) -> DataFrame:
    return with_dimension(events, devices, "device_id")


def hot_cold_join(progress: DataFrame, history: DataFrame) -> DataFrame:
    """Resume positions of the hot store beside the whole history of the cold one."""
    past = history.groupBy("user_id", "content_id").agg(
        F.count(F.lit(1)).alias("history_events"),
        F.min("event_timestamp").alias("first_seen"))
    return progress.join(past, ["user_id", "content_id"]).select(
        "user_id", "content_id", "last_position", "last_watched", "history_events",
        "first_seen")


def retained(view: DataFrame, ts: str, as_of: str, days: int | None) -> DataFrame:
    """Rows a store with this retention still has at `as_of`."""
    if days is None:
        return view
    return view.filter(F.col(ts) >= F.lit(as_of).cast("timestamp")
                       - F.expr(f"INTERVAL {int(days)} DAYS"))
