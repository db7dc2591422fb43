"""Packs token sequences by their length histogram, shortest pack first.

Lengths are placed longest first, each into the packs with the most room; all packs with the same
content are one pattern with a count, so the work depends on the number of distinct lengths, not on
the number of documents. Patterns are joined back to documents by rank: the r-th document of a
length fills the r-th place for that length.

Documents longer than a sequence are cut into full sequences and a rest. The plan has at most
2 * length patterns, each with at most sqrt(2 * length) distinct lengths, whatever the corpus size
(for 4096: 8,192 patterns, under 750,000 places); it is sent to all tasks.

Edge cases
    null, empty text    the end token alone: one piece of length 1
    very long text      pieces of the full length and a rest
    repeated rows, null doc_id   packed like any other row
    empty table         empty result
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import byte_letters, in_batches, materialized

SEQUENCE = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
BUCKET_PIECES = 200_000  # pieces ranked by one task
REMEMBERED_CHUNKS = 200_000

# Characters Python takes for white space and the vocabulary's pattern does not; and the opening
# of its special tokens, which may stand inside a chunk.
UNUSUAL = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")

# A word of its own between the words of two chunks; chunks with it go the slow way.
BORDER = "\x01"

# Chunks that lower case changes letter by letter and normalization not at all.
PLAIN_CHUNK = re.compile("[!-~]+").fullmatch
LATIN_CHUNK = re.compile("[!-~\xa1-\xac\xae-\u012f\u0131-\u017f]+").fullmatch

# The vocabulary's pattern of words with the border beside it, and as it reads for printable ASCII in
# lower case (fixed values).
LATIN_WORDS = regex.compile(
    r"\x01|'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}\x01]+")
ASCII_WORDS = re.compile(r"\x01|'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9\x01]+")

Pattern = tuple[tuple[int, int], ...]  # (length, repeats), longest first


def pack_histogram(histogram: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Counts of packing patterns; lengths longest first, each into the emptiest packs."""
    by_room: dict[int, dict[Pattern, int]] = defaultdict(dict)

    def add(room: int, pattern: Pattern, count: int) -> None:
        by_room[room][pattern] = by_room[room].get(pattern, 0) + count

    for length in sorted((n for n, count in histogram.items() if count), reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in by_room.items() if packs and r >= length), default=None)
            if room is None:
                # New packs: as many as hold the rest of this length when filled with it alone.
                fits = capacity // length
                if left >= fits:
                    add(capacity - fits * length, ((length, fits),), left // fits)
                    left %= fits
                else:
                    add(capacity - left * length, ((length, left),), 1)
                    left = 0
                continue
            pattern, count = next(iter(by_room[room].items()))
            # Into all packs of the pattern, as often as keeps them from falling far below the
            # next emptiest; single placements would only repeat this step.
            used = min(count, left)
            repeats = max(1, min(room // length, left // used))
            del by_room[room][pattern]
            if count > used:
                add(room, pattern, count - used)
            add(room - repeats * length, (*pattern, (length, repeats)), used)
            left -= used * repeats
    return {pattern: count for packs in by_room.values() for pattern, count in packs.items()}


def places(patterns: dict[Pattern, int]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset, repeats) in order of length and rank."""
    rows, sequence, rank = [], 0, defaultdict(int)
    for pattern, count in sorted(patterns.items(), reverse=True):
        offset = 0
        for length, repeats in pattern:
            rows.append((length, rank[length], sequence, offset, repeats))
            rank[length] += count * repeats
            offset += length * repeats
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place_of(plan: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple:
    """Sequence and offset of the rank-th piece of each length."""
    # One search key: lengths are small, ranks below 2^48.
    at = np.searchsorted((plan[:, 0] << 48) + plan[:, 1], (length << 48) + rank, "right") - 1
    _, first, sequence, offset, repeats = plan[at].T
    along = rank - first
    return sequence + along // repeats, offset + along % repeats * length


class ChunkIds:
    """Token ids (little-endian, 4 bytes each) of texts, remembered by chunk between white space.

    The vocabulary drops white space and joins nothing across it, so the ids of a text are those of
    its chunks. The chunks that a batch of texts brings anew are split into words by the
    vocabulary's pattern and all their words encoded at once. That takes a byte-pair encoder over
    bytes, in which a line end stands for the vocabulary's end-of-word mark: the merges of a last
    byte with it come first, all others in the order of their ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.normalize = self.tokenizer.normalizer.normalize_str
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = byte_letters()
        ranks = {}
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            word = token.removesuffix(WORD_END)
            body = bytes(map(self.letters.__getitem__, word))
            ranks[body + b"\n" if len(word) < len(token) else body] = number
        self.border = ranks[f"{BORDER}\n".encode()]
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks,
                                          special_tokens={})
        self.known: dict[str, bytes] = {}

    def slow(self, chunk: str) -> list[str]:
        """Words by the vocabulary's own normalizer and splitter, which writes bytes as letters."""
        return [bytes(map(self.letters.__getitem__, word)).decode("utf-8")
                for word, _ in self.split(self.normalize(chunk))]

    def learn(self, chunks: set[str]) -> None:
        if len(self.known) > REMEMBERED_CHUNKS:
            # The older half goes.
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
        known = self.known
        plain, latin, other = [], [], []
        for chunk in chunks:
            if chunk not in known:
                (plain if PLAIN_CHUNK(chunk) else latin if LATIN_CHUNK(chunk) else other).append(
                    chunk)
        # All words one behind the other, and a border behind the words of each chunk.
        words = ASCII_WORDS.findall("".join(f"{c}{BORDER}" for c in plain).lower())
        words += LATIN_WORDS.findall("".join(f"{c}{BORDER}" for c in latin).lower())
        for chunk in other:
            if BORDER in chunk:
                known[chunk] = self.whole(chunk)
            else:
                latin.append(chunk)
                words += [*self.slow(chunk), BORDER]
        ids = self.encoding.encode_to_numpy("\n".join([*words, ""]), disallowed_special=())
        last = np.flatnonzero(ids == self.border) * 4
        first = np.concatenate(([0], last[:-1] + 4))
        body = ids.astype("<u4").tobytes()
        parts = map(body.__getitem__, map(slice, first.tolist(), last.tolist()))
        known.update(zip(plain + latin, parts, strict=True))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for some in in_batches(texts):
            chunks = [None if any(map(text.__contains__, UNUSUAL)) else text.split()
                      for text in some]
            self.learn(set().union(*(c for c in chunks if c)))
            for text, parts in zip(some, chunks, strict=True):
                yield self.whole(text) if parts is None \
                    else b"".join(map(self.known.__getitem__, parts))


@cache
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)


def token_bytes(texts: list[str | None], path: str) -> Iterator[bytes]:
    end = np.array([END_ID], "<u4").tobytes()
    return (ids + end for ids in chunk_ids(path).encode([t or "" for t in texts]))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = SEQUENCE, vocabulary: Callable[[], str] = default_vocabulary
           ) -> DataFrame:
    """Pieces of at most `capacity` ids: doc_id, start, length, ids_crc32, doc_tokens."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary()
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(token_bytes(batch.column("text").to_pylist(), path)):
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at:at + 4 * capacity]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids) // 4)
            longs = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *longs],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return rows.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, "
                                "doc_tokens long")


def ranked(cut: DataFrame, largest: int) -> DataFrame:
    """The pieces with `rank`, counted from 0 within each length.

    A length may be that of a third of all pieces: rows are dealt into buckets by their content,
    numbered there, and start behind the counts of the buckets before. There are so many buckets that
    the largest length has BUCKET_PIECES rows in each.
    """
    buckets = max(1, -(-largest // BUCKET_PIECES))
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets))
    dealt = cut.withColumn("bucket", bucket)
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(
        "doc_id", "start", "ids_crc32", "doc_tokens"))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    starts = counts.select("length", "bucket", before.alias("before"))
    return dealt.withColumn("within", within - 1).join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.col("within")).drop("bucket", "before", "within")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = SEQUENCE, vocabulary: Callable[[], str] = default_vocabulary
         ) -> DataFrame:
    """Every piece with the sequence it goes to and its offset there."""
    cut = materialized(pieces(docs, id_col, text_col, capacity, vocabulary))
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # At most `capacity` rows come to the driver.
    plan = places(pack_histogram(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = place_of(plan, np.asarray(batch.column("length")),
                                        np.asarray(batch.column("rank")))
            keep = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), pa.array(sequence), pa.array(offset)],
                [*keep, "sequence_id", "offset"])

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    kind = dict(cut.dtypes)["doc_id"]
    return ranked(cut, max(histogram.values(), default=0)).select(*columns, "rank").mapInArrow(
        place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
               "sequence_id long, offset long")
