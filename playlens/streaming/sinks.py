"""Sinks that can be repeated: every micro-batch owns one folder.

A batch that runs again after a failure overwrites its own folder, so each batch
counts once. Upserts are logs of such folders; the latest row of a key is taken
on reading, and `fold_batches` shortens the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators import views
from playlens.operators.enrich import retained
from playlens.operators.ordered import latest_per_key
from playlens.operators.quality import deduplicated
from playlens.plans import current, files, layout, seen
from playlens.sources.decode import accepted, decode_events, quarantined
from playlens.sources.schema import RETENTION_DAYS, TABLE_KEYS

BatchWriter = Callable[[DataFrame, int], None]


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int,
                partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").options(compression="zstd",
                                                partitionOverwriteMode="static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(batch_folder(path, batch_id))


def batches_to(path: str, partition_by: list[str] | None = None) -> BatchWriter:
    return lambda df, batch_id: write_batch(df, path, batch_id, partition_by)


def history_to(path: str, once: bool = False) -> BatchWriter:
    """History rows by day and batch; a repeated batch replaces its own folders.

    With `once`, events that the history already has are left out, however long ago they came.
    """
    def write(events: DataFrame, batch_id: int) -> None:
        if not once:
            layout.write_history(events, path, "overwrite", batch_id)
            return
        new = seen.unseen(events, path, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            layout.write_history(new, path, "overwrite", batch_id)
            seen.remember(new, path, batch_id)
        finally:
            new.unpersist()
    return write


def fold_history(spark: SparkSession, path: str, before: str) -> int:
    """Merges the batch folders of every day earlier than `before`; returns the days merged.

    Rows are deduplicated on the event id, those without one on the whole row. The newest batch of
    the stream is left alone, because it may still be repeated. Merged folders are numbered below
    `layout.APPENDED`, so no append or batch ever replaces one. A merged folder is complete and in
    place before an old one goes, so a run that stops anywhere leaves every event readable, some
    twice at worst, and the next run repairs that. Days with one folder are not touched.
    """
    batches = {day: sorted(int(name.split("=")[1])
                           for name in files.children(spark, f"{path}/event_date={day}")
                           if name.startswith("batch_id="))
               for day in layout.history_days(spark, path)}
    newest = max((n for found in batches.values() for n in found if n >= 0), default=None)
    folded = 0
    for day, found in batches.items():
        closed = [n for n in found if n != newest]
        if day >= before or len(closed) < 2:
            continue
        folder = f"{path}/event_date={day}"
        staged = files.hidden_name(path, "fold")
        rows = layout.read_history(spark, path, [day], closed).drop("event_date")
        named = F.col("event_id").isNotNull()
        merged = deduplicated(rows.filter(named)).unionByName(rows.filter(~named).distinct())
        merged.hint("rebalance").write.option("compression", "zstd").parquet(staged)
        files.rename(spark, staged, f"{folder}/batch_id={min(layout.APPENDED, *closed) - 1}")
        for batch in closed:
            files.delete(spark, f"{folder}/batch_id={batch}")
        folded += 1
    return folded


# The six views of the hot store: builder and key of the latest row, if it is
# an upsert rather than a log of events.
HOT_VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "events_by_user": views.events_by_user,
    "events_by_session": views.events_by_session,
    "events_by_content": views.events_by_content,
    "user_content_progress": lambda events: latest_per_key(
        views.progress_log(events), ["user_id", "content_id"], ["last_watched", "event_id"]),
    "continue_watching": views.continue_watching_log,
    "playback_quality_events": views.quality_events,
}


def fan_out_to(root: str, table_views: dict[str, Callable] | None = None) -> BatchWriter:
    """Writes every hot view of a batch from one read of it.

    A view that fails does not keep the others from being written; the batch
    fails afterwards and is repeated as a whole, so nothing is lost.
    """
    chosen = table_views or HOT_VIEWS

    def write(events: DataFrame, batch_id: int) -> None:
        events.persist(StorageLevel.MEMORY_AND_DISK)
        failures = []
        try:
            for name, build in chosen.items():
                try:
                    write_batch(build(events), f"{root}/{name}", batch_id)
                except Exception as error:  # noqa: BLE001 - raised below
                    failures.append((name, error))
        finally:
            events.unpersist()
        if failures:
            names = ", ".join(name for name, _ in failures)
            raise RuntimeError(f"batch {batch_id}: failed views {names}") from failures[0][1]
    return write


def current_to(root: str, buckets: int = current.BUCKETS,
               table_views: dict[str, Callable] | None = None) -> BatchWriter:
    """Keeps every hot view as a current table; see `plans.current`."""
    chosen = table_views or HOT_VIEWS

    def write(events: DataFrame, batch_id: int) -> None:
        events.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, build in chosen.items():
                current.merge_batch(build(events), f"{root}/{name}", name, batch_id, buckets)
        finally:
            events.unpersist()
    return write


def ingest_to(events_path: str, quarantine_path: str, fmt: str = "json",
              avro_schema: str | None = None) -> BatchWriter:
    """Splits raw records into good events and a quarantine, from one parse."""
    def write(records: DataFrame, batch_id: int) -> None:
        decoded = decode_events(records, fmt, avro_schema).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(accepted(decoded), events_path, batch_id)
            write_batch(quarantined(decoded), quarantine_path, batch_id)
        finally:
            decoded.unpersist()
    return write


def latest_rows(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Current state of an upsert log: the last row per key, later batches winning."""
    return latest_per_key(log, keys, [*order, "batch_id"]).drop("batch_id")


def current_rows(log: DataFrame, table: str, as_of: str | None = None) -> DataFrame:
    """What a hot table holds: one row per primary key, expired rows left out."""
    keys, ts = TABLE_KEYS[table]
    order = ["last_watched", "event_id"] if table == "user_content_progress" else []
    rows = latest_rows(log, list(keys), order)
    return retained(rows, ts, as_of, RETENTION_DAYS.get(table)) if as_of else rows


def fold_table(spark: SparkSession, path: str, table: str, as_of: str | None = None) -> int:
    """Folds the log of a hot table down to its current rows."""
    return fold_batches(spark, path, lambda log: current_rows(log, table, as_of))


def fold_batches(spark: SparkSession, path: str,
                 merge: Callable[[DataFrame], DataFrame] | None = None,
                 partition_by: list[str] | None = None) -> int:
    """Merges all batch folders below the newest into one; returns how many.

    The newest folder is left alone because its batch may still be repeated.
    The merged folder is complete and in place under a new, lowest number before
    an old one goes, so a run that stops anywhere leaves every row readable,
    some twice at worst. Upsert logs are settled by `latest_rows` then, as the
    oldest folders go first; for all others the merged folder keeps a mark of
    the folders it replaces, and the next run deletes what is left of them.
    """
    _finish_fold(spark, path)
    batches = sorted(int(name.split("=")[1]) for name in files.children(spark, path)
                     if name.startswith("batch_id="))
    closed = batches[:-1]
    if len(closed) < 2:
        return 0
    folders = [batch_folder(path, b) for b in closed]
    rows = spark.read.option("basePath", path).parquet(*folders)
    merged = merge(rows) if merge else rows
    staged = files.hidden_name(path, "fold")
    writer = merged.drop("batch_id").write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(staged)
    files.make_folder(spark, f"{staged}/{_REPLACES}{closed[-1]}")
    files.rename(spark, staged, batch_folder(path, min(0, *closed) - 1))
    _finish_fold(spark, path)
    return len(closed)


# A hidden folder in a merged one: every batch after the merged one and up to this is merged in it.
_REPLACES = "_replaces-"


def _finish_fold(spark: SparkSession, path: str) -> None:
    """Deletes the folders, oldest first, that the last merged one replaces, then its mark."""
    batches = sorted(int(name.split("=")[1]) for name in files.children(spark, path)
                     if name.startswith("batch_id="))
    if not batches or batches[0] >= 0:
        return
    merged = batch_folder(path, batches[0])
    for mark in files.children(spark, merged, hidden=True):
        if mark.startswith(_REPLACES):
            last = int(mark.removeprefix(_REPLACES))
            for batch in (b for b in batches[1:] if b <= last):
                files.delete(spark, batch_folder(path, batch))
            files.delete(spark, f"{merged}/{mark}")
