"""Aligns the tokens of two tokenizers by divide and conquer at shared cuts.

Both tokenizers cover the same bytes. In an interval of bytes a common end near the middle is
located: the interval's middle is found by bisection in the ends of A, and the ends of A around it,
nearest first, are looked up in the ends of B by bisection. The interval is cut there and both
halves are treated alike. An interval without a common end inside is a leaf: a group of tokens of A
that stands for a group of tokens of B. The intervals of one level, of all texts of a batch, are
treated together, so a level is a few array operations. An end is looked up a few times at most per
level and the depth is logarithmic, since the halves are cut near the middle.

At each end of a group one token of A and one of B end together: they are linked. Of two linked
tokens one is the end of the other, so the linkable pairs follow from the vocabularies alone:
at most one per suffix of each entry and each of its names, under 600,000 for the default ones.
Pair counts over the corpus have that bound whatever its size; they are added up per task before the
shuffle and sent to all tasks as two arrays. Texts are tokenized once, their links are kept in the
shared folder as a compressed table.

Edge cases
    null, empty text      no tokens: zeros and the digest ''
    texts that a tokenizer changes (such as U+2581, which B takes for a space)
                          joined token bytes differ from the text: zeros and ''
    special tokens        their strings are plain text
    very long text        memory in proportion to the text: one text is handled at once
    repeated rows         counted as often as they occur
    null doc_id           like any other row
    empty table           empty result
    other columns         ignored, whatever their names
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import byte_letters, in_batches, stored

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"

# The pattern that byte-level vocabularies split texts by (fixed value).
BYTE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                r"|\s+(?!\S)|\s+")


class ByteTokens:
    """A byte-level vocabulary of the tokenizers library's format."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        names = {token: bytes(map(letters.__getitem__, token))
                 for token in model["vocab"] if all(c in letters for c in token)}
        self.entries = [b""] * (max(model["vocab"].values()) + 1)
        for token, number in model["vocab"].items():
            self.entries[number] = names.get(token, b"")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in merges]
        if made != sorted(made):
            raise ValueError("the vocabulary's merges are not in the order of its ids")
        single = [number for token, number in model["vocab"].items() if len(token) == 1]
        self.encoding = tiktoken.Encoding(
            "a", pat_str=BYTE_PATTERN, special_tokens={},
            mergeable_ranks={self.entries[i]: i for i in {*single, *made}})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(t, disallowed_special=()).astype(np.int64)
                for t in (" " + t for t in texts)]


class PieceTokens:
    """A sentencepiece vocabulary with byte fallback; it puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
            else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.model.id_to_piece, range(len(self.model))))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


class Pair:
    """Two tokenizers, the pairs of entries that can be linked, and digits for the digest."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.size = [np.array(list(map(len, t.entries)), np.int64) for t in (self.a, self.b)]
        self.keys = self._linkable()
        self.of_b = self.keys % len(self.b.entries)
        # Every id followed by "," "|" or ";", padded with zero bytes.
        top = max(len(self.a.entries), len(self.b.entries))
        self.digits = np.array([f"{i}{mark}" for mark in ",|;" for i in range(top)], "S")
        self.top = top

    def _linkable(self) -> np.ndarray:
        """a * entries of B + b of all entries of which one is the end of the other, sorted."""
        names: list[dict[bytes, list[int]]] = []
        for entries in (self.a.entries, self.b.entries):
            by_bytes: dict[bytes, list[int]] = defaultdict(list)
            for i, entry in enumerate(entries):
                if entry:
                    by_bytes[entry].append(i)
            names.append(by_bytes)
        found = []
        for side, (own, other) in enumerate((names, names[::-1])):
            for entry, ids in own.items():
                for cut in range(side, len(entry)):
                    for there in other.get(entry[cut:], ()):
                        found += [(i, there) if side == 0 else (there, i) for i in ids]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return np.unique(pairs[:, 0] * len(self.b.entries) + pairs[:, 1])

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of pairs of ids among the linkable ones."""
        return np.searchsorted(self.keys, a * len(self.b.entries) + b)


@cache
def pair_of(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B)


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which ends of A are ends of B, too.

    Both are increasing; the intervals to begin with end at the positions `last` in A, which are
    common ends.
    """
    cut = np.zeros(len(a_ends), bool)
    cut[last] = True
    # Interval i holds the tokens lo[i]..hi[i] of A; its last end is a common one.
    lo, hi = np.concatenate(([0], last[:-1] + 1)), last.copy()
    while True:
        inside = hi > lo
        lo, hi = lo[inside], hi[inside]
        if not len(lo):
            return cut
        begin = np.where(lo > 0, a_ends[lo - 1], 0)
        middle = np.searchsorted(a_ends, (begin + a_ends[hi]) // 2)
        found = nearest_common(a_ends, b_ends, lo, hi - 1, np.clip(middle, lo, hi - 1))
        halved = found >= 0
        at = found[halved]
        cut[at] = True
        # In order, since neighbouring lookups are found faster.
        lo = np.column_stack((lo[halved], at + 1)).ravel()
        hi = np.column_stack((at, hi[halved])).ravel()


def nearest_common(a_ends: np.ndarray, b_ends: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                   middle: np.ndarray) -> np.ndarray:
    """For each interval of positions lo..hi in A the common end nearest to its middle, or -1.

    The ends around the middle are looked up in rings that double in width.
    """
    found = np.full(len(lo), -1)
    open_ = np.arange(len(lo))
    near = 0  # ends up to this distance have been looked up, but for the middle itself at first
    far = 0
    while len(open_):
        below_first = np.maximum(middle[open_] - far, lo[open_])
        below_last = np.minimum(middle[open_] - near, hi[open_])
        above_first = np.maximum(middle[open_] + max(near, 1), lo[open_])
        above_last = np.minimum(middle[open_] + far, hi[open_])
        first = np.concatenate((below_first, above_first))
        count = np.maximum(np.concatenate((below_last, above_last)) - first + 1, 0)
        whose = np.repeat(np.concatenate((open_, open_)), count)
        probe = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) \
            + np.repeat(first, count)
        # Bisection in the ends of B.
        value = a_ends[probe]
        common = b_ends[np.minimum(np.searchsorted(b_ends, value), len(b_ends) - 1)] == value
        whose, probe = whose[common], probe[common]
        # The farthest first, so that the nearest is written last.
        order = np.argsort(-np.abs(probe - middle[whose]), kind="stable")
        found[whose[order]] = probe[order]
        rest = (found[open_] < 0) & ((middle[open_] - far > lo[open_])
                                     | (middle[open_] + far < hi[open_]))
        open_ = open_[rest]
        near, far = far + 1, 2 * far + 1
    return found


def align(texts: list[str], pair: Pair) -> list[tuple | None]:
    """For each text (ids of A, ids of B, positions of the last tokens of the groups in A, in B);
    None for texts that the tokens do not give back."""
    out: list[tuple | None] = [None] * len(texts)
    ids_a, ids_b = pair.a.encode(texts), pair.b.encode(texts)
    kept = []
    for i, text in enumerate(texts):
        body = b" " + text.encode("utf-8", "surrogatepass")
        if text and all(b"".join(map(side.entries.__getitem__, ids.tolist())) == body
                        for side, ids in ((pair.a, ids_a[i]), (pair.b, ids_b[i]))):
            kept.append(i)
    if not kept:
        return out
    ends, counts = [], []
    for size, ids in zip(pair.size, (ids_a, ids_b), strict=True):
        # The texts one behind the other: ends grow over all of them.
        ends.append(np.cumsum(size[np.concatenate([ids[i] for i in kept])]))
        counts.append(np.cumsum([len(ids[i]) for i in kept]))
    cuts_a = np.flatnonzero(shared_cuts(ends[0], ends[1], counts[0] - 1))
    cuts_b = np.searchsorted(ends[1], ends[0][cuts_a])
    borders = np.searchsorted(cuts_a, counts[0] - 1, "right")
    begin, begin_a, begin_b = 0, 0, 0
    for i, border, upto_a, upto_b in zip(kept, borders, *counts, strict=True):
        out[i] = (ids_a[i], ids_b[i], cuts_a[begin:border] - begin_a,
                  cuts_b[begin:border] - begin_b)
        begin, begin_a, begin_b = border, upto_a, upto_b
    return out


def groups_text(found: tuple, pair: Pair) -> bytes:
    """`a1,a2|b1;a3|b2,b3`: the ids of every group."""
    ids_a, ids_b, last_a, last_b = found
    place_a = np.arange(len(ids_a)) + np.concatenate(([0], last_b + 1))[
        np.searchsorted(last_a, np.arange(len(ids_a)))]
    place_b = np.arange(len(ids_b)) + (last_a + 1)[np.searchsorted(last_b, np.arange(len(ids_b)))]
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[place_a], code[place_b] = ids_a, ids_b
    code[place_a[last_a]] += pair.top
    code[place_b[last_b]] += 2 * pair.top
    body = np.frombuffer(pair.digits[code].tobytes(), np.uint8)
    return body[body > 0].tobytes()[:-1]


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           paths: Callable[[], tuple[str, str]] = default_paths) -> DataFrame:
    """doc_id and the groups of every document: ids of A and B of each, in order."""
    kinds = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*paths())
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for found in (f for some in in_batches(texts) for f in align(some, pair)):
                if found is None:
                    rows.append([])
                    continue
                a = np.split(found[0], found[2][:-1] + 1)
                b = np.split(found[1], found[3][:-1] + 1)
                rows.append([{"a": x, "b": y} for x, y in zip(a, b, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, kinds)], ["doc_id", "groups"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(read, f"doc_id {kind}, groups array<struct<a: array<int>, b: array<int>>>")


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           paths: Callable[[], tuple[str, str]] = default_paths) -> DataFrame:
    """Counts and digest of every document's groups and the numbers of its linked pairs, sorted."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*paths())
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for found in (f for some in in_batches(texts) for f in align(some, pair)):
                if found is None:
                    rows.append((0, 0, 0, "", b""))
                    continue
                a, b, last_a, last_b = found
                links = np.sort(pair.numbers(a[last_a], b[last_b])).astype("<i4")
                rows.append((len(a), len(b), len(last_a),
                             hashlib.sha256(groups_text(found, pair)).hexdigest(),
                             links.tobytes()))
            n_a, n_b, n_groups, digest, links = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)),
                 pa.array(digest, pa.string()), pa.array(links, pa.binary())],
                ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(read, f"doc_id {kind}, n_a long, n_b long, n_groups long, "
                                 "groups_sha256 string, links binary")


def pair_counts(found: DataFrame, paths: Callable[[], tuple[str, str]] = default_paths
                ) -> DataFrame:
    """pair, n: how many links of the corpus hold each linkable pair; added up per task first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(pair_of(*paths()).keys), np.int64)
        for batch in batches:
            links = np.frombuffer(b"".join(batch.column("links").to_pylist()), "<i4")
            total += np.bincount(links, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["pair", "n"])

    return found.select("links").mapInArrow(add, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n"))


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               paths: Callable[[], tuple[str, str]] = default_paths) -> DataFrame:
    """Counts, digest and link statistics of every document.

    A link's count is that of its pair in the corpus; it is the best when no pair with the same
    token of B has a higher one.
    """
    spark = docs.sparkSession
    found = stored(linked(docs, id_col, text_col, paths))
    pair = pair_of(*paths())
    count = np.zeros(len(pair.keys), np.int64)
    # At most one row per linkable pair, a number that the vocabularies fix.
    rows = pair_counts(found, paths).toArrow()
    count[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    highest = np.zeros(len(pair.b.entries), np.int64)
    np.maximum.at(highest, pair.of_b, count)
    shared = spark.sparkContext.broadcast((count, count == highest[pair.of_b]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            links = [np.frombuffer(x, "<i4") for x in batch.column("links").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept]
                + [pa.array([f(x) for x in links], pa.int64())
                   for f in (len, lambda x: best[x].sum(), lambda x: counts[x].sum())],
                [*kept, "n_links", "n_best", "count_sum"])

    kept = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    kind = dict(found.dtypes)["doc_id"]
    return found.select(*kept, "links").mapInArrow(
        judge, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, "
               "n_links long, n_best long, count_sum long")
