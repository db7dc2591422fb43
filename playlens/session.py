"""Session settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks shuffle widths, splits skewed joins and switches to
# broadcast joins from measured sizes, so no operator carries a join hint or a
# partition count.
BATCH_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Stream state lives in RocksDB; sessions are merged before the shuffle so that
# a user with very many events sends one row per micro-batch partition.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str, master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BATCH_SETTINGS, **STREAM_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints: the cluster's own setting comes first."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = configured or fallback
    if not root:
        raise ValueError("spark.checkpoint.dir is not set and no fallback folder was given")
    return root.rstrip("/")
