"""The streaming jobs: source stream to sink, with watermark and trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlens.operators import metrics, quality, sessions
from playlens.streaming import session_state, sinks
from playlens.streaming.sources import DISORDER, WINDOW_LATENESS, watermarked

# Fixed value: a checkpoint every minute.
TRIGGER = {"processingTime": "60 seconds"}


def start(stream: DataFrame, write: sinks.BatchWriter, checkpoint: str, mode: str = "append",
          trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    writer = (stream.writeStream.outputMode(mode).foreachBatch(write)
              .option("checkpointLocation", checkpoint).trigger(**(trigger or TRIGGER)))
    return (writer.queryName(name) if name else writer).start()


def content_metrics_job(events: DataFrame, path: str, checkpoint: str, **options
                        ) -> StreamingQuery:
    """Final 5-minute metrics, written once a window can no longer change."""
    result = metrics.content_metrics(watermarked(events, WINDOW_LATENESS))
    return start(result, sinks.batches_to(path), checkpoint, **options)


def early_metrics_job(events: DataFrame, path: str, checkpoint: str, **options
                      ) -> StreamingQuery:
    """Running values of open windows; read with `sinks.latest_rows` on the key
    (content_id, window_start)."""
    result = metrics.content_metrics_early(watermarked(events, WINDOW_LATENESS))
    return start(result, sinks.batches_to(path), checkpoint, mode="update", **options)


def sessions_job(events: DataFrame, path: str, checkpoint: str, gap: str = "30 minutes",
                 **options) -> StreamingQuery:
    """Sessions, written when the gap has passed; an event later than the watermark whose session is
    closed opens one of its own."""
    result = session_state.user_sessions_state(watermarked(events, DISORDER), gap)
    return start(result, sinks.batches_to(path), checkpoint, **options)


def hot_views_job(events: DataFrame, root: str, checkpoint: str, **options) -> StreamingQuery:
    return start(events, sinks.fan_out_to(root), checkpoint, **options)


def current_tables_job(events: DataFrame, root: str, checkpoint: str, buckets: int = 64, **options
                       ) -> StreamingQuery:
    """Hot views as current tables: each batch rewrites the buckets of its own keys."""
    return start(events, sinks.current_to(root, buckets), checkpoint, **options)


def history_job(events: DataFrame, path: str, checkpoint: str, once: bool = False, **options
                ) -> StreamingQuery:
    return start(events, sinks.history_to(path, once), checkpoint, **options)


def noisy_devices_job(events: DataFrame, alerts: str, quarantine: str, checkpoint: str, limit: int,
                      window: str = "1 minute", slide: str = "10 seconds", **options
                      ) -> StreamingQuery:
    """Devices over `limit` in a sliding window, as an upsert log of alerts by (device, window), and
    each batch's alerts as reasons in the quarantine. State is dropped behind the watermark."""
    found = quality.noisy_devices(watermarked(events, WINDOW_LATENESS), limit, window, slide)

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            sinks.write_batch(rows, alerts, batch_id)
            sinks.write_batch(rows.select(
                F.lit("noisy device").alias("reject_reason"),
                F.to_json(F.struct("device_id", "window_start", "events")).alias("raw_value"),
                F.col("window_start").alias("received_at")), quarantine, batch_id)
        finally:
            rows.unpersist()

    return start(found, write, checkpoint, mode="update", **options)


def ingest_job(records: DataFrame, events_path: str, quarantine_path: str, checkpoint: str,
               fmt: str = "json", avro_schema: str | None = None, **options) -> StreamingQuery:
    return start(records, sinks.ingest_to(events_path, quarantine_path, fmt, avro_schema),
                 checkpoint, **options)


def deduplicated_job(events: DataFrame, path: str, checkpoint: str, within: str = "10 minutes",
                     **options) -> StreamingQuery:
    """Each event id once; copies further apart than `within` are not remembered."""
    return start(quality.deduplicated(watermarked(events, within)), sinks.batches_to(path),
                 checkpoint, **options)
