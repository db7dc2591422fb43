"""MinHash fingerprints of documents over shingles of five words.

Every shingle hash goes through PERMUTATIONS universal hash functions (a * x + b, upper half of 64
bits) in numpy; the smallest value of each function makes the signature. The share of equal values
estimates the Jaccard similarity of two shingle sets. `search` joins bands of signatures in Spark,
between classes of equal shingle sets, and verifies every candidate by its exact Jaccard.

Edge cases
    null, empty text, white space   no shingles: the largest value everywhere; such texts are alike
    under five words                the whole sequence is the one shingle
    repeated rows                   equal texts have equal fingerprints
    null doc_id                     ordered after all ids in `edited`
    repeated and null ids           ordered by a hash of the text, then by the text
    very long text                  shingles are hashed in one pass, signatures in parts
    empty table                     empty result
    other columns                   ignored, whatever their names
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import materialized, shingle_hashes

SHINGLE_WORDS = 5
PERMUTATIONS = 64
BANDS = 16
SIMILAR = 0.8
CHUNK = 8192
PIECES = 8  # fine pieces per range
HASH_BITS = 8  # pieces of a frequent id: 2^8

_random = np.random.default_rng(20_240_501)
FACTOR = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
EMPTY = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of every hash function over the shingles."""
    lowest = EMPTY.copy()
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at:at + CHUNK]
        hashed = (part[None, :] * FACTOR[:, None] + SHIFT[:, None]) >> np.uint64(32)
        lowest = np.minimum(lowest, hashed.min(axis=1).astype(np.uint32))
    return lowest


def fingerprint(text: str | None) -> np.ndarray:
    return signature(shingle_hashes(text, SHINGLE_WORDS))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edit(text: str, following: str) -> str:
    """The text with its last half replaced by as many characters of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_order(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows dealt into ranges along (doc_id, hash of the text), the first row of the next range added
    to each.

    Fine pieces are cut at quantiles of the ids; ids that fill pieces of their own, and null ones, are
    cut by the hash. Neighbouring pieces are put together to ranges of about equal bytes. Outside the
    tasks only the pieces' sizes are known, `PIECES` per range and `HASH_PIECES` per frequent id, and
    one head per range. Texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash"))
    fine = ranges * PIECES
    shares = [i / fine for i in range(1, fine)]
    cuts = [int(b) for b in rows.filter("doc_id IS NOT NULL").approxQuantile(
        "doc_id", shares, 0.2 / fine)] if shares else []
    borders = sorted(set(cuts))
    frequent = sorted({a for a, b in zip(cuts, cuts[1:], strict=False) if a == b})
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values]).cast("array<long>")
    no_id = F.col("doc_id").isNull()
    by_hash = no_id | F.array_contains(longs(frequent), F.coalesce("doc_id", F.lit(0)))
    at = F.when(no_id, F.lit(len(borders) + 1)).otherwise(
        F.size(F.filter(longs(borders), lambda b: b < F.col("doc_id"))))
    # The hash as an unsigned place in its range.
    part = F.when(by_hash, F.shiftright("__hash", 64 - HASH_BITS) + (1 << (HASH_BITS - 1)) + 1)
    placed = rows.withColumns({"__at": at.cast("int"),
                               "__part": F.coalesce(part, F.lit(0)).cast("int")})
    first = F.min(F.struct(no_id.alias("n"), "doc_id", "__hash")).alias("first")
    pieces = sorted(placed.groupBy("__at", "__part").agg(
        F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 100).alias("bytes"), first).collect(),
        key=lambda r: (r["__at"], r["__part"]))
    if not pieces:
        return placed.select("doc_id", "text", F.lit(0).alias("__range"),
                             F.lit(False).alias("__head"))
    share = max(1, sum(r["bytes"] for r in pieces)) / ranges
    seen, plan, heads = 0, [], []
    for r in pieces:
        number = min(ranges - 1, int((seen + r["bytes"] / 2) / share))
        if not heads or heads[-1][0] != number:
            heads.append((number, r["first"]["doc_id"], r["first"]["__hash"]))
        plan.append((r["__at"], r["__part"], number))
        seen += r["bytes"]
    ranged = placed.join(F.broadcast(spark.createDataFrame(
        plan, "__at int, __part int, __range int")), ["__at", "__part"])
    # Each range takes the head of the following one, the last the very first.
    taker = [(heads[i - 1][0], heads[i][1], heads[i][2]) for i in range(len(heads))]
    wanted = spark.createDataFrame(taker, "taker int, head_id long, head_hash long")
    head_rows = rows.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("head_id"))
                          & (F.col("__hash") == F.col("head_hash"))).groupBy("taker").agg(
        F.min(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"), "__hash")).alias("h"))
    heads_in = head_rows.select("h.doc_id", "h.text", F.col("taker").alias("__range"),
                                F.lit(True).alias("__head"), "h.__hash")
    both = ranged.select("doc_id", "text", "__range", F.lit(False).alias("__head"), "__hash")
    return both.unionByName(heads_in).repartitionById(ranges, "__range").sortWithinPartitions(
        "__range", "__head", no_id, "doc_id", "__hash", "text").drop("__hash")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 ranges: int | None = None) -> DataFrame:
    """The fingerprint of every document and of its edited text, and two likenesses."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, which waits for the one after it
        for batch in batches:
            out = []
            for row in zip(*(batch.column(n).to_pylist()
                             for n in ("doc_id", "text", "__range", "__head")), strict=True):
                doc_id, text, place, is_head = row
                text = text or ""
                mark = fingerprint(text)
                if held and held[2] == place:
                    out.append(described(held, text, mark))
                held = None if is_head else (doc_id, text, place, mark)
            if out:
                yield pa.RecordBatch.from_pylist(out, RESULT)

    return in_order(rows, ranges).mapInArrow(compare, SCHEMA)


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()),
                    ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                    ("near_next", pa.float64())])


def described(row: tuple, following: str, following_mark: np.ndarray) -> dict:
    doc_id, text, _, mark = row
    edited = edit(text, following)
    edited_mark = fingerprint(edited)
    return {"doc_id": doc_id, "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": mark.astype(">u4").tobytes().hex(),
            "edited_fingerprint": edited_mark.astype(">u4").tobytes().hex(),
            "near_edited": likeness(mark, edited_mark),
            "near_next": likeness(mark, following_mark)}


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a digest of the shingle set (null without shingles), shingles, bands."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t, SHINGLE_WORDS) for t in batch.column("text").to_pylist()]
            marks = [signature(s).reshape(BANDS, -1) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None
                          for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                pa.array([[b.tobytes() for b in m] for m in marks], pa.list_(pa.binary()))],
                ["doc_id", "same", "shingles", "bands"])

    return rows.mapInArrow(
        mark, "doc_id long, same binary, shingles array<long>, bands array<binary>")


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, class_id) of all documents, and (query_class, class_id, jaccard).

    Documents with the same shingles form a class, named by its smallest id. Classes of `queries`
    (a subset of `docs`) meet all classes that share a band of the signature; candidates stay when
    the Jaccard similarity of their shingle sets is high enough. Bands find a pair of similarity s
    with probability 1 - (1 - s^4)^16: 0.9998 at 0.8. Texts without shingles are linked with
    nothing; rows without an id take no part.
    """
    marked = materialized(signatures(docs, id_col, text_col).filter("doc_id IS NOT NULL"))
    classes = materialized(marked.filter("same IS NOT NULL").groupBy("same").agg(
        F.min("doc_id").alias("class_id")))
    members = marked.select("doc_id", "same").join(classes, "same", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    asked = queries.select(F.col(id_col).cast("long").alias("doc_id")).join(
        members, "doc_id").select("class_id").distinct()
    heads = marked.join(classes, "same").filter("doc_id = class_id").dropDuplicates(["same"])
    banded = heads.select("class_id", F.posexplode("bands").alias("band", "value"))
    of_query = banded.join(asked, "class_id", "left_semi").withColumnRenamed(
        "class_id", "query_class")
    pairs = of_query.join(banded, ["band", "value"]).filter(
        "query_class <> class_id").select("query_class", "class_id").distinct()
    left = heads.select(F.col("class_id").alias("query_class"), F.col("shingles").alias("of_a"))
    right = heads.select("class_id", F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    both = F.size("of_a") + F.size("of_b") - common
    links = pairs.join(left, "query_class").join(right, "class_id").select(
        "query_class", "class_id", (common / both).alias("jaccard")).filter(
        F.col("jaccard") >= similar)
    return members, links
