"""Mixes sources to target weights in fixed-length blocks of tokens.

The words of a source form one line, documents in pseudorandom order, cut into blocks of equal
length. Every output shard draws how many of its slots each source fills; the k-th slot of a source
maps through a pseudorandom permutation of the source's block numbers; slots and blocks meet in a
join on (source, block number).

The draw of a shard is a multinomial one conditioned on the totals: slots are dealt by a
pseudorandom permutation of all slots, so every shard's counts vary as drawn ones do, while each
source gets its target over all shards, to one block. Independent draws would miss small targets by
their standard deviation and could ask for a block a third time, beyond the limit of two.

Edge cases
    null text       size 0, never taken
    null source     a source of its own, ranked last
    repeated rows   each counts with its own words
    null doc_id     ordered first within its bucket, mixed like any other row
    empty table     empty result
    very long text  its words are counted where it is read; blocks name runs of words, not the text
    other columns   ignored, or returned untouched by `mixed_documents`, whatever their names
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import WORD, materialized, mix, sums_before, wrapped

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
CHUNK_TURNS = 50_000
MOST_TASKS = 20_000
ROWS_PER_BUCKET = 20_000
SEED = 17


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: source, number (from 0), source_size, target.

    Sources are capped in ascending order of limit / weight: once the rate that serves the rest
    keeps the next source under its limit, it does so for all later ones. `sizes` has a row per
    document with source and size. Sources are ranked and summed in pieces, so their number has no
    bound.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = sums_before(totals, [F.col("source").isNull(), F.encode("source", "UTF-8")],
                           {"number": F.lit(1)})
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = numbered.withColumns({
        "weight": F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int")),
        "limit": F.col("source_size") * float(most)})
    by_rate = [F.col("limit") / F.col("weight"), F.col("number")]
    placed = sums_before(ranked, by_rate, {"limit_before": F.col("limit"),
                                           "weight_before": F.col("weight")})
    whole = placed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = float(whole["size"] or 0) * share
    rated = placed.withColumn("rate", (F.lit(budget) - F.col("limit_before"))
                              / (F.lit(whole["weight"] or 0.0) - F.col("weight_before")))
    settled = rated.filter(F.col("rate") * F.col("weight") <= F.col("limit")).agg(
        F.min(F.struct(*by_rate, "rate")).alias("first")).first()["first"]
    target = F.least(F.lit(settled["rate"]) * F.col("weight"), F.col("limit")) if settled \
        else F.col("limit")
    return placed.select("source", F.col("number").cast("long").alias("number"), "source_size",
                         target.alias("target"))


def laid_out(numbered: DataFrame, buckets: int) -> DataFrame:
    """The documents with `at`, the number of words before each one in its source's line.

    Documents are dealt into small buckets by a hash of id and text; prefix sums run within buckets
    and over bucket totals, so no task orders a whole source. Rows with one id are told apart by
    their text first, so the order of the input decides only between copies.
    """
    keyed = numbered.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "key", F.lit(SEED)), F.lit(buckets)))
    line = Window.partitionBy("number", "bucket").orderBy("doc_id", "key", "size", "row")
    inside = keyed.withColumn("within", F.sum("size").over(
        line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    totals = keyed.groupBy("number", "bucket").agg(F.sum("size").alias("bucket_size"))
    over = Window.partitionBy("number").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    starts = totals.select("number", "bucket", (
        F.sum("bucket_size").over(over) - F.col("bucket_size")).alias("base"))
    return inside.join(starts, ["number", "bucket"]).withColumn(
        "at", F.col("base") + F.col("within")).drop("base", "within", "bucket")


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(size), element by element.

    Four Feistel rounds over the smallest even number of bits; results beyond the size walk on
    until they fall inside.
    """
    out = index.astype(np.uint64)
    size = np.broadcast_to(np.asarray(size, np.uint64), out.shape)
    key = np.broadcast_to(np.asarray(key, np.uint64), out.shape)
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.uint64)
    half = (bits + np.uint64(1)) // np.uint64(2)
    todo = np.arange(len(out))
    while len(todo):
        h, k = half[todo], key[todo]
        low_bits = (np.uint64(1) << h) - np.uint64(1)
        left, right = out[todo] >> h, out[todo] & low_bits
        for turn in range(4):
            left, right = right, left ^ (mix(right + mix(k + np.uint64(turn))) & low_bits)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out


def slots(targets: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """One row per output slot: shard, slot, number of the source, block, lap over the source.

    `targets` has a row per source (number, source_size, target). A source's turns, one per block
    wanted, take consecutive places in the deal; the permutation of all places says in which slot,
    and so in which shard, each turn lands. Turns are computed in chunks, in parallel.
    """
    blocks = F.ceil(F.col("source_size") / block_words)
    # The last block of a source is shorter; turns are counted in blocks of its average length.
    wanted = F.round(F.col("target") * blocks / F.col("source_size")).cast("long")
    dealt = targets.filter("source_size > 0").select(
        "number", blocks.alias("blocks"), F.least(wanted, blocks * MOST_REPEATS).alias("turns"))
    total = dealt.agg(F.sum("turns")).first()[0] or 0
    places = sums_before(dealt, [F.col("number")], {"place": F.col("turns")})
    chunks = places.withColumn("total", F.lit(total).cast("long")).filter("turns > 0").select("*", F.explode(F.sequence(
        F.lit(0), F.col("turns") - 1, F.lit(CHUNK_TURNS))).alias("first"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                turn = np.arange(r["first"], min(r["turns"], r["first"] + CHUNK_TURNS))
                slot = permuted(turn + r["place"], r["total"], seed).astype(np.int64)
                lap = turn // r["blocks"]
                key = mix(lap.astype(np.uint64) + np.uint64((r["number"] + 1) * seed))
                block = permuted(turn % r["blocks"], r["blocks"], key).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot // SHARD_SLOTS), pa.array(slot),
                     pa.array(np.full(len(slot), r["number"], np.int64)), pa.array(block),
                     pa.array(lap)], ["shard", "slot", "number", "block", "lap"])

    # So many tasks, which adaptive execution would join because the chunks themselves are narrow.
    width = max(1, min(chunks.count(), MOST_TASKS))
    return chunks.repartition(width).mapInArrow(
        draw, "shard long, slot long, number long, block long, lap long")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source",
            block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Laid-out documents, and the mix: one row per slot and piece of a document in its block.

    The pieces (row, doc_id, key, word_start, word_count) name what a slot holds; the text stays
    where it is. `row` tells rows with one id apart, `key` is a hash of the text.
    """
    sized = materialized(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        F.xxhash64(text_col).alias("key")))
    targets = materialized(source_targets(sized))
    named = targets.withColumnRenamed("source", "of")
    numbered = sized.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")
    lines = materialized(laid_out(numbered, max(1, sized.count() // ROWS_PER_BUCKET)))
    first, last = F.col("at") / block_words, (F.col("at") + F.col("size") - 1) / block_words
    pieces = lines.filter("size > 0").select(
        "row", "doc_id", "key", "number", "at", "size",
        F.explode(F.sequence(F.floor(first), F.floor(last))).alias("block"))
    start = F.greatest("at", F.col("block") * block_words)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select("row", "doc_id", "key", "number", "block",
                           (start - F.col("at")).alias("word_start"),
                           (end - start).alias("word_count"))
    # Both sides grow with the corpus: the join is one by sorting and never sends a side whole.
    return lines, slots(targets, block_words).join(pieces.hint("merge"), ["number", "block"])


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    lines, mix_rows = mixture(docs, **options)
    taken = mix_rows.groupBy("row").agg(F.sum("word_count").alias("taken"))
    return lines.join(taken.hint("merge"), "row", "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def cut_words(text: str, runs: list[tuple[int, int]]) -> str:
    """The runs of words (start, count; ascending) of a text, neighbours joined as they stood."""
    spans = [m.span() for m in re.finditer(WORD, text)]
    merged = []
    for start, count in runs:
        if merged and merged[-1][1] == start:
            merged[-1][1] = start + count
        else:
            merged.append([start, start + count])
    if merged == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in merged)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", chars_col: str = "n_chars") -> DataFrame:
    """The mix as documents: a row per document and lap, with the words its drawn blocks hold.

    A document whose blocks are all drawn keeps its text as it is; of others the drawn runs of
    words stay, in order, joined by a line break. Documents without words are never drawn. Columns
    are those of `docs`. Rows equal in id and text share their draws.
    """
    lines, mix_rows = mixture(docs, id_col, text_col, source_col)
    runs = mix_rows.groupBy("doc_id", "key", "row", "lap").agg(
        F.sort_array(F.collect_list(F.struct("word_start", "word_count"))).alias("__runs"))
    runs = runs.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "__runs")
    texts = wrapped(docs, id_col).withColumn("hash", F.xxhash64(F.col("doc")[text_col]))
    if not lines.groupBy("doc_id", "key").count().filter("count > 1").isEmpty():
        texts = texts.dropDuplicates(["key", "hash"])

    @F.pandas_udf("string")
    def cut(text: pd.Series, drawn: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, [(r["word_start"], r["word_count"]) for r in runs_])
                          for t, runs_ in zip(text, drawn, strict=True)], dtype=object)

    joined = texts.join(runs.hint("merge"), F.col("key").eqNullSafe(F.col("__id"))
                        & (F.col("hash") == F.col("__key")))
    joined = joined.withColumn("body", cut(F.col("doc")[text_col], "__runs"))
    changed = {text_col: F.col("body"), chars_col: F.length("body").cast("long")}
    return joined.select(*[changed.get(name, F.col("doc")[name]).alias(name)
                           for name in docs.columns])
