"""Helpers shared by the training-data operators: tables, lineage cuts, words and shingles."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

# ASCII white space; a word is a run of anything else.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = "[\\x20\\x09-\\x0D]+"

# Odd multipliers of 64-bit mixing functions (fixed values).
ROLL = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

# Words remembered by a Python worker; the memory is emptied when full.
REMEMBERED_WORDS = 150_000

# Characters of texts that are tokenized together; a longer text comes alone.
BATCH_CHARS = 1 << 20

# Bytes of terms that come to the driver at once.
FETCHED_BYTES = 2_000_000

# Rows of an order that one task takes.
PIECE_ROWS = 100_000

# Bits of the filters that spare rows a shuffle: 1,024 rows of 4 KB whatever the input.
FILTER_BITS = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where none is set, a local session gets a scratch folder (tests); a cluster has to name one,
    since executors would not see each other's files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="playlens-", dir="/tmp")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialized(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, so that a lost executor loses none of them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as a compressed table in the shared folder, for wide or large intermediate rows."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(sample: DataFrame, most_bytes: int) -> DataFrame:
    """Of a sample of bounded rows the first by `place` that have so many bytes of `terms` at most."""
    sizes = sorted((r["place"], r["size"]) for r in
                   sample.select("place", F.length("terms").alias("size")).collect())
    last = int(np.searchsorted(np.cumsum([size for _, size in sizes]), most_bytes, "right"))
    return sample.filter(F.col("place") < sizes[last][0]) if last < len(sizes) else sample


def fetched(sample: DataFrame) -> Iterator[Row]:
    """All rows of a sample of bounded rows, in any order. They are dealt to partitions of about
    FETCHED_BYTES of `terms` that come one after another: the driver's JVM would hold a result that
    comes at once several times over."""
    size = sample.agg(F.sum(F.length("terms"))).first()[0] or 0
    return sample.repartition(max(1, -(-size // FETCHED_BYTES))).toLocalIterator()


def wrapped(docs: DataFrame, id_col: str) -> DataFrame:
    """The rows as one column `doc` and their id as `key`, so that no name of theirs can clash."""
    columns = [F.col(f"`{name}`") for name in docs.columns]
    return docs.select(F.struct(*columns).alias("doc"), F.col(id_col).alias("key"))


def sums_before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds for every name the sum of its column over all rows before, in an order without ties.

    Rows are cut into pieces along the order, PIECE_ROWS in each; the sums run within pieces and over
    the totals of the pieces. The rows are materialized.
    """
    pieces = max(1, -(-df.count() // PIECE_ROWS))
    own = {f"__{name}": value for name, value in sums.items()}
    keys = {f"__order_{i}": column for i, column in enumerate(order)}
    placed = materialized(df.withColumns(own | keys).repartitionByRange(pieces, *keys)
                          .withColumn("__piece", F.spark_partition_id()))
    line = Window.partitionBy("__piece").orderBy(*keys).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = placed.groupBy("__piece").agg(*[F.sum(name).alias(f"{name}_all") for name in own])
    # One row per piece.
    before = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = totals.select(F.col("__piece"), *[
        (F.sum(f"{name}_all").over(before) - F.col(f"{name}_all")).alias(f"{name}_start")
        for name in own])
    return placed.withColumns({f"{name}_run": F.sum(name).over(line) - F.col(name) for name in own}
                              ).join(starts, "__piece").select(
        *df.columns, *[(F.col(f"__{name}_start") + F.col(f"__{name}_run")).alias(name)
                       for name in sums])


def _slot(columns: tuple[str, ...]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))


def bit_maps(rows: DataFrame, *columns: str) -> DataFrame:
    """Bit maps of the values that occur, at most FILTER_BITS / 32768 rows."""
    slot = _slot(columns)
    return rows.groupBy(F.bitmap_bucket_number(slot).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("__bits"))


def with_maybe(rows: DataFrame, maps: DataFrame, *columns: str) -> DataFrame:
    """The rows with `__maybe`: false means that the values are certainly not in the maps.

    The maps have a fixed size (4 MB at most) and are joined by broadcast, so nothing is shuffled.
    """
    bit = F.bitmap_bit_position(_slot(columns))
    byte = F.conv(F.hex(F.substring("__bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.getbit(byte.cast("bigint"), (bit % 8).cast("int")) == 1
    return rows.withColumn("__bucket", F.bitmap_bucket_number(_slot(columns))).join(
        F.broadcast(maps), "__bucket", "left").withColumn(
        "__maybe", F.coalesce(is_set, F.lit(False))).drop("__bucket", "__bits")


def without(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose id is not among `ids` (one column): only possible ones meet the list."""
    ids = materialized(ids.toDF("__id"))
    marked = with_maybe(rows, bit_maps(ids, "__id"), column)
    met = marked.filter("__maybe").join(ids, F.col(column) == F.col("__id"), "left_anti")
    return marked.filter("NOT __maybe").unionByName(met).drop("__maybe")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as it is, the
    others as letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


def in_batches(texts: list[str]) -> Iterator[list[str]]:
    """Neighbouring texts up to BATCH_CHARS together."""
    batch, size = [], 0
    for text in texts:
        if batch and size + len(text) > BATCH_CHARS:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    z = values + ROLL
    z = (z ^ (z >> np.uint64(30))) * MIX_1
    z = (z ^ (z >> np.uint64(27))) * MIX_2
    return z ^ (z >> np.uint64(31))


class WordHashes(dict):
    """Remembers the 64-bit hash of each word it is asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value


_HASHES = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z in lower case; byte methods touch ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words.

    A text with fewer words is one shingle, a text without words has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    rolled = np.zeros(len(words) - span + 1, np.uint64)
    for i in range(span):
        rolled = rolled * ROLL + hashes[i:len(words) - span + 1 + i]
    return np.unique(mix(rolled + np.uint64(span)))
