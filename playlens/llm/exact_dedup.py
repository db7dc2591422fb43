"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after replacing each run of ASCII white space by one
space; null counts as empty. Everything here is DataFrame functions.

Edge cases
    null text       equal to the empty text
    null doc_id     smaller ids win; a group of null ids only keeps one of its rows, keep_id null
    repeated rows   rows with the same id and equal text count as copies, exactly one is kept
    very long text  normalised and hashed where it is read
    empty table     empty result
    other columns   ignored by `refine`, returned untouched by `deduplicate`, whatever their names
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import SPACES, bit_maps, materialized, with_maybe, wrapped

PREFIX_CHARS = 256


def normalized(text: str | Column) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                            SPACES, " ")


def _measured(body: Column, prefix_chars: int) -> list[Column]:
    return [F.length(body).alias("__length"),
            F.xxhash64(F.substring(body, 1, prefix_chars)).alias("__prefix")]


def surviving_groups(docs: DataFrame, text_col: str = "text",
                     prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Bit maps of the (length, prefix hash) groups that hold more than one row.

    Rows that are alone with their length leave before the second grouping; only numbers are
    shuffled. The result has a fixed size.
    """
    facts = materialized(docs.select(*_measured(normalized(text_col), prefix_chars)))
    lengths = facts.groupBy("__length").agg(F.count("*").alias("n")).filter("n > 1")
    groups = (facts.join(lengths, "__length", "left_semi")
              .groupBy("__length", "__prefix").agg(F.count("*").alias("n")).filter("n > 1"))
    return bit_maps(groups, "__length", "__prefix")


def flagged(docs: DataFrame, survivors: DataFrame, text_col: str | Column = "text",
            prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The rows with `__maybe`: false means certainly without a copy. No text is shuffled."""
    measured = docs.select("*", *_measured(normalized(text_col), prefix_chars))
    return with_maybe(measured, survivors, "__length", "__prefix").drop("__length", "__prefix")


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           survivors: DataFrame | None = None, hash_all: bool = False) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, full_hash.

    `full_hash` is null for rows that refinement sets apart before their content is hashed, unless
    `hash_all` asks for it. The hash is taken where the text is read: 32 bytes travel, not the text.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if survivors is None:
        survivors = materialized(surviving_groups(base))
    full = F.sha2(normalized("text"), 256)
    members = materialized(flagged(base, survivors).select(
        "doc_id", "__maybe",
        (full if hash_all else F.when(F.col("__maybe"), full)).alias("full_hash"),
        F.monotonically_increasing_id().alias("__row")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_last"), "doc_id", "__row"))
    groups = (members.filter("__maybe").groupBy("full_hash")
              .agg(first.alias("first"), F.count("*").alias("n")).filter("n > 1"))
    # Rows that refinement set apart meet no group.
    apart = members.filter("NOT __maybe").withColumns(
        {"first": F.lit(None).cast(dict(groups.dtypes)["first"]), "n": F.lit(None).cast("long")})
    met = members.filter("__maybe").join(groups, "full_hash", "left")
    alone = F.col("n").isNull()
    return met.unionByName(apart).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first.__row") == F.col("__row"))).alias("kept"),
        "full_hash")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Rows the filter clears pass by without a shuffle; only possible copies meet the list of
    dropped ids. Rows without an id are told by the hash of their text, one of each is kept
    where no row with an id has the same text.
    """
    survivors = materialized(surviving_groups(docs, text_col))
    decided = materialized(refine(docs, id_col, text_col, survivors))
    text = F.col("doc")[text_col]
    marked = flagged(wrapped(docs, id_col), survivors, text)
    dropped = (decided.groupBy(F.col("doc_id").alias("key"))
               .agg(F.max("kept").alias("kept")).filter("NOT kept").select("key"))
    possible = marked.filter("__maybe").join(dropped, "key", "left_anti")
    nameless = decided.filter("doc_id IS NULL AND full_hash IS NOT NULL")
    if not nameless.filter("NOT kept").isEmpty():
        gone = (nameless.groupBy(F.col("full_hash").alias("hash"))
                .agg(F.max("kept").alias("kept")).filter("NOT kept").select("hash"))
        hashed = possible.filter("key IS NULL").withColumn("hash", F.sha2(normalized(text), 256))
        possible = possible.filter("key IS NOT NULL").unionByName(
            hashed.join(gone, "hash", "left_anti").dropDuplicates(["hash"]).drop("hash"))
    repeated = (decided.filter("NOT kept AND doc_id = keep_id")
                .select(F.col("doc_id").alias("key")).distinct())
    if not repeated.isEmpty():
        possible = possible.join(repeated, "key", "left_anti").unionByName(
            possible.join(repeated, "key", "left_semi").withColumn("body", normalized(text))
            .dropDuplicates(["key", "body"]).drop("body"))
    return marked.filter("NOT __maybe").unionByName(possible).select("doc.*")
