"""Table upkeep: statistics, small-file compaction, several tables in a row."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.plans import files

log = logging.getLogger(__name__)

TARGET_FILE_BYTES = 128 * 1024 * 1024
MIN_INPUT_FILES = 2
FILES_PER_JOB = 4000
# Fixed value: folder name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def table_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files, bytes, megabytes and rows of a table, as one row."""
    sizes = files.listing(spark, path).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("total_bytes"),
        F.round(F.sum("bytes") / (1024 * 1024), 2).alias("total_size_mb"))
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.withColumn("record_count", rows.scalar())


def partition_stats(spark: SparkSession, path: str) -> DataFrame:
    return files.listing(spark, path).groupBy("partition").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("total_bytes"))


def compact_partitions(spark: SparkSession, path: str, partition_by: list[str],
                       target_bytes: int = TARGET_FILE_BYTES, sort_by: list[str] | None = None,
                       files_per_job: int = FILES_PER_JOB) -> int:
    """Rewrites partitions that hold more files than their size calls for.

    A partition gets as many slots as its size calls for files; rows are dealt
    over the slots and each slot becomes one file. Partitions are taken in jobs
    of bounded shuffle width, and the new files of a job replace the old ones
    when it commits, so an interrupted run keeps what it finished. Returns the
    number of partitions rewritten. What the driver sees is one line per
    partition folder.
    """
    wanted = F.greatest(F.lit(1), F.ceil(F.col("total_bytes") / F.lit(float(target_bytes))))
    crowded = (partition_stats(spark, path).withColumn("slots", wanted.cast("int"))
               .filter((F.col("file_count") >= MIN_INPUT_FILES)
                       & (F.col("file_count") > F.col("slots")))
               .select("partition", "slots").orderBy("partition").collect())
    if not crowded:
        return 0
    if not partition_by:
        _rewrite_whole(spark, path, crowded[0]["slots"], sort_by)
        return 1
    for job in _jobs([(row["partition"], row["slots"]) for row in crowded], files_per_job):
        _rewrite_partitions(spark, path, partition_by, job, sort_by)
    return len(crowded)


def _jobs(crowded: list[tuple[str, int]], files_per_job: int) -> list[list[tuple[str, int, int]]]:
    """Groups partitions; each entry is (partition, slots, first slot of the job)."""
    jobs, used = [[]], 0
    for partition, slots in crowded:
        if jobs[-1] and used + slots > files_per_job:
            jobs.append([])
            used = 0
        jobs[-1].append((partition, slots, used))
        used += slots
    return jobs


def _rewrite_partitions(spark: SparkSession, path: str, partition_by: list[str],
                        job: list[tuple[str, int, int]], sort_by: list[str] | None) -> None:
    source = spark.read.option("basePath", path).parquet(*[f"{path}/{p}" for p, _, _ in job])
    plan = spark.createDataFrame(job, "partition string, slots int, first_slot int")
    folder = F.concat_ws("/", *[
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION)))
        for c in partition_by])
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("slots")).cast("int")
    placed = source.withColumn("partition", folder).join(plan, "partition").withColumn(
        "slot", F.col("first_slot") + dealt)
    spread = placed.repartitionById(sum(slots for _, slots, _ in job), "slot")
    if sort_by:
        spread = spread.sortWithinPartitions(*partition_by, *sort_by)
    (spread.drop("partition", "slots", "first_slot", "slot").write.mode("overwrite")
           .options(partitionOverwriteMode="dynamic", compression="zstd")
           .partitionBy(*partition_by).parquet(path))


def _rewrite_whole(spark: SparkSession, path: str, slots: int, sort_by: list[str] | None) -> None:
    """Compacts a table without partitions: written beside, then swapped in.

    A run that stopped between the two renames left the rows in the retired folder alone: see
    `restore_whole`.
    """
    root = path.rstrip("/")
    staged, retired = f"{root}__compacted", f"{root}__retired"
    restore_whole(spark, root)
    spread = spark.read.parquet(root).repartition(slots)
    if sort_by:
        spread = spread.sortWithinPartitions(*sort_by)
    spread.write.mode("overwrite").option("compression", "zstd").parquet(staged)
    files.rename(spark, root, retired)
    files.rename(spark, staged, root)
    files.delete(spark, retired)


def restore_whole(spark: SparkSession, root: str) -> None:
    """Puts a table back that a stopped swap left retired, and clears what a finished one left."""
    retired = f"{root.rstrip('/')}__retired"
    if files.exists(spark, retired) and not files.exists(spark, root):
        files.rename(spark, retired, root)
    elif files.exists(spark, retired):
        files.delete(spark, retired)


def warehouse_tables(spark: SparkSession, root: str, only: str | None = None
                     ) -> dict[str, list[str]]:
    """Tables below a folder with their partition columns, read off the folder names."""
    found = {}
    for name in files.children(spark, root):
        if name.endswith("__retired"):
            restore_whole(spark, f"{root.rstrip('/')}/{name.removesuffix('__retired')}")
    for name in files.children(spark, root):
        if name.endswith(("__retired", "__compacted")):
            continue
        if only in (None, name):
            path, columns = f"{root.rstrip('/')}/{name}", []
            step = next((c for c in files.children(spark, path) if "=" in c), None)
            below = path
            while step:
                columns.append(step.split("=", 1)[0])
                below = f"{below}/{step}"
                step = next((c for c in files.children(spark, below) if "=" in c), None)
            found[path] = columns
    return found


def maintenance_report(spark: SparkSession, tables: dict[str, list[str]],
                       target_bytes: int = TARGET_FILE_BYTES) -> list[dict]:
    """Compacts several tables; one line per table: table, done, files and bytes before and after."""
    def sizes(path: str) -> tuple[int, int]:
        row = files.listing(spark, path).agg(
            F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")).first()
        return row["files"], row["bytes"] or 0

    report = []
    for path, partition_by in tables.items():
        restore_whole(spark, path)
        before = sizes(path)
        done = maintain_tables(spark, {path: partition_by}, target_bytes)[path]
        after = sizes(path)
        report.append({"table": path, "done": done, "files_before": before[0],
                       "bytes_before": before[1], "files_after": after[0],
                       "bytes_after": after[1]})
    return report


def maintain_tables(spark: SparkSession, tables: dict[str, list[str]],
                    target_bytes: int = TARGET_FILE_BYTES) -> dict[str, bool]:
    """Compacts several tables (path to partition columns); one failure stops no other."""
    outcome = {}
    for path, partition_by in tables.items():
        try:
            rewritten = compact_partitions(spark, path, partition_by, target_bytes)
            log.info("%s: %d partitions rewritten", path, rewritten)
            outcome[path] = True
        except Exception:  # noqa: BLE001 - reported per table
            log.exception("could not maintain %s", path)
            outcome[path] = False
    return outcome

