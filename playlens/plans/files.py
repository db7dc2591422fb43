"""Folder operations through the cluster's own file system layer.

Only names and sizes pass through the driver, never rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _file_system(spark, path)
    return fs.exists(hadoop.Path(path))


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop.Path(path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, hadoop = _file_system(spark, source)
    if not fs.rename(hadoop.Path(source), hadoop.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop = _file_system(spark, path)
    if not fs.mkdirs(hadoop.Path(path)):
        raise OSError(f"could not make {path}")


def children(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Names directly below a folder, hidden ones left out unless asked for."""
    if not exists(spark, path):
        return []
    fs, hadoop = _file_system(spark, path)
    if not fs.getFileStatus(hadoop.Path(path)).isDirectory():
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop.Path(path))]
    return sorted(n for n in names if hidden or not n.startswith(("_", ".")))


def hidden_name(path: str, purpose: str) -> str:
    """A folder beside the data that readers skip."""
    return f"{path.rstrip('/')}/_{purpose}-{uuid.uuid4().hex}"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file: partition folder and size; contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))
    folder = F.regexp_replace("path", "/[^/]*$", "")
    steps = F.filter(F.split(folder, "/"), lambda step: step.contains("="))
    return files.select(F.array_join(steps, "/").alias("partition"), "path",
                        F.col("length").alias("bytes"))
