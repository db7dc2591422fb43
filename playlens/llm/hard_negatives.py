"""Hard negatives by rotated one-bit codes with exact intervals.

Vectors are taken about the mean of their label in their block, which is added back exactly. Every one
is turned by a fixed pseudorandom rotation (signs, then a Hadamard transform). Its code is the signs
of the turned components, one bit each; beside the code stand its alignment a, the
inner product of the vector with the unit vector u of its code, and the length r of what is left of
the vector beyond a * u. An anchor q is turned alike and written as bit planes, so that <q, u>
follows from popcounts of the planes and the code, up to a rounding error e that is known exactly
from q. Then

    <q, x> = a <q, u> + <rest of q, rest of x>,  where by Cauchy and Schwarz the last term is
             at most r * sqrt(|q|^2 - <q, u>^2) either way

so every score lies in an interval that is certain, not likely. Rows whose interval cannot reach the
result are left out; all others get their integer inner product.

The anchors are a share of the rows and meet all of them, which no bound can spare, so both sides are
dealt into blocks of fixed size by their place, and every cell of a block of rows and a block of
anchors is one group of bounded size: `BLOCK_ROWS` and `BLOCK_ANCHORS` rows. Neither side is sent
whole to any task and no label or repeated vector makes a group larger. Cells send on at most
`positives` rows per anchor, then at most `negatives` rows per anchor and positive.

1. Of each anchor's rows of the same label the first `positives` are kept; a row is scored if its
   interval reaches the lower ends of the best intervals of its cell.
2. Each positive's score gives the bounds between which negatives must lie. A row of another label is
   scored if its interval meets the bounds of a positive and reaches the lower ends of the best
   intervals that certainly lie within them.

Edge cases
    null id, label, vector, null or non-finite component   the row takes no part
    components beyond any exact score (for 64: 2^28)       the row takes no part
    vectors of different length      shorter ones count as filled up with zeros
    ties                             the smaller id comes first
    repeated ids                     every row counts for itself, as row and as anchor; rows with the
                                     anchor's id are never its positives
    fewer rows than asked for        all of them
    empty table, no anchors          empty result
    other columns                    ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import mix, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
BLOCK_ROWS, BLOCK_ANCHORS = 2048, 4096
PLANES = 8  # bits that a component of an anchor is written with
SLACK = 1e-9  # of the product of the lengths, for rounding in the bounds
DENSE = 0.02  # share of survivors from which a block is scored by a matrix product
PAIRS = 1 << 20  # pairs of an anchor and a row that are held at once


def integers(vector: Column, scale: int = SCALE) -> Column:
    """Components x as floor(scale * x), in double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Whether there is a vector and all of its components are finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def rotated(vectors: np.ndarray) -> np.ndarray:
    """The rows turned: pseudorandom signs, then a Hadamard transform of the next power of two."""
    count, width = vectors.shape
    size = 1 << max(0, width - 1).bit_length()
    signs = 1 - 2 * (mix(np.arange(size, dtype=np.uint64)) >> np.uint64(63)).astype(float)
    out = np.zeros((count, size))
    out[:, :width] = vectors * signs[:width]
    half = 1
    while half < size:
        pairs = out.reshape(count, -1, 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]),
                       2).reshape(count, size)
        half *= 2
    return out / np.sqrt(size)


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    count, size = bits.shape
    full = np.zeros((count, -(-size // 64) * 64), bool)
    full[:, :size] = bits
    return np.packbits(full, axis=1).view(np.uint64)


def group_means(vectors: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """The mean of each group; the same rows in the same order give the same numbers."""
    order = np.argsort(groups, kind="stable")
    starts = np.flatnonzero(np.diff(groups[order], prepend=-1))
    counts = np.diff(starts, append=len(order))
    means = np.zeros((int(groups.max(initial=0)) + 1, vectors.shape[1]))
    means[groups[order][starts]] = np.add.reduceat(
        vectors[order].astype(float), starts, axis=0) / counts[:, None]
    return means


@dataclass
class Codes:
    """One-bit codes of vectors about the mean of their group, with alignments and residual lengths."""

    groups: np.ndarray
    means: np.ndarray
    words: np.ndarray
    alignment: np.ndarray
    rest: np.ndarray
    length: np.ndarray

    @property
    def size(self) -> int:
        return 1 << max(0, self.means.shape[1] - 1).bit_length()

    @classmethod
    def made(cls, vectors: np.ndarray, groups: np.ndarray | None = None) -> Codes:
        """`groups` numbers the group of each vector from 0; by default all are one."""
        if groups is None:
            groups = np.zeros(len(vectors), np.int64)
        means = group_means(vectors, groups)
        turned = rotated(vectors - means[groups])
        alignment = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
        rest = np.sqrt(np.maximum((turned ** 2).sum(axis=1) - alignment ** 2, 0))
        return cls(groups, means, packed(turned >= 0), alignment, rest, lengths(vectors))


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(float) ** 2).sum(axis=1))


class Planes:
    """Anchors as bit planes of their turned components."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors.astype(float)
        turned = rotated(vectors)
        self.length = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / (2 ** PLANES - 1), 1e-300)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.words = np.stack([packed((level >> p) & 1 == 1) for p in range(PLANES)], axis=1)
        self.total = level.sum(axis=1)
        written = self.low[:, None] + self.step[:, None] * level
        self.error = np.abs(turned - written).sum(axis=1) / np.sqrt(turned.shape[1])

    def intervals(self, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of the scores of all anchors (rows) with all vectors (columns)."""
        ones = np.bitwise_count(codes.words).sum(axis=1, dtype=np.int64)
        held = np.zeros((len(self.words), len(codes.words)), np.int64)
        for plane in range(PLANES):
            for word in range(codes.words.shape[1]):
                both = self.words[:, plane, word][:, None] & codes.words[:, word][None, :]
                held += np.bitwise_count(both).astype(np.int64) << plane
        along = (self.low[:, None] * (2 * ones - codes.size)[None, :]
                 + self.step[:, None] * (2 * held - self.total[:, None])) / np.sqrt(codes.size)
        least = np.maximum(np.abs(along) - self.error[:, None], 0)
        beyond = np.sqrt(np.maximum(self.length[:, None] ** 2 - least ** 2, 0))
        half = (codes.alignment[None, :] * self.error[:, None] + codes.rest[None, :] * beyond
                + SLACK * (self.length[:, None] * codes.length[None, :] + 1))
        middle = (self.vectors @ codes.means.T)[:, codes.groups] + codes.alignment[None, :] * along
        return middle - half, middle + half


def scores(anchors: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Integer inner products where `wanted`; other places hold anything."""
    most = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0))
    if most * anchors.shape[1] < 2 ** 52 and wanted.mean() > DENSE:
        # Whole numbers below 2^53 are exact in double.
        return np.rint(anchors.astype(float) @ rows.astype(float).T).astype(np.int64)
    out = np.zeros(wanted.shape, np.int64)
    at, row = np.nonzero(wanted)
    step = max(1, PAIRS // max(1, anchors.shape[1]))
    for first in range(0, len(at), step):
        i, j = at[first:first + step], row[first:first + step]
        out[i, j] = np.einsum("ij,ij->i", anchors[i], rows[j])
    return out


def first_by_score(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Positions of the first rows: higher scores first, ties by smaller id."""
    if len(score) > count:
        border = np.partition(score, len(score) - count)[len(score) - count]
        near = np.flatnonzero(score >= border)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))][:count]


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """Of every row the k-th largest value, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


class Side:
    """Rows of a block as arrays, in the order of their places."""

    def __init__(self, found: pa.Table, width: int):
        found = found.sort_by("place")
        self.found = found
        column = lambda name: found.column(name).to_numpy(zero_copy_only=False)
        self.ids, self.places = column("id"), column("place")
        self.labels = found.column("label").to_pylist()
        self.vectors = np.frombuffer(b"".join(found.column("vector").to_pylist()),
                                     "<i8").reshape(-1, width)

    def codes(self, groups: np.ndarray) -> Codes:
        """The stored codes; the means are those of the block again."""
        words = np.frombuffer(b"".join(self.found.column("code").to_pylist()), np.uint64)
        return Codes(groups, group_means(self.vectors, groups), words.reshape(len(self.ids), -1),
                     *(self.found.column(n).to_numpy() for n in ("alignment", "rest")),
                     lengths(self.vectors))


def numbered_labels(*sides: Side) -> tuple[np.ndarray, ...]:
    number: dict = {}
    return tuple(np.array([number.setdefault(x, len(number)) for x in side.labels], np.int64)
                 for side in sides)


def near_rows(anchors: Side, rows: Side, positives: int) -> tuple:
    """In a cell: places of anchors, ids and scores of each anchor's first rows of its label."""
    anchor_labels, row_labels = numbered_labels(rows, anchors)[::-1]
    codes = rows.codes(row_labels)
    out_place, out_id, out_score = [], [], []
    for some in _slices(len(anchors.ids), len(rows.ids)):
        own = (anchor_labels[some][:, None] == row_labels[None, :]) \
            & (anchors.ids[some][:, None] != rows.ids[None, :])
        low, high = Planes(anchors.vectors[some]).intervals(codes)
        border = kth_largest(np.where(own, low, -np.inf), positives)
        wanted = own & (high >= border[:, None])
        score = scores(anchors.vectors[some], rows.vectors, wanted)
        for i in np.flatnonzero(wanted.any(axis=1)):
            j = np.flatnonzero(wanted[i])
            j = j[first_by_score(score[i, j], rows.ids[j], positives)]
            out_place.append(np.full(len(j), anchors.places[some][i]))
            out_id.append(rows.ids[j])
            out_score.append(score[i, j])
    return _joined(out_place, out_id, out_score)


def far_rows(anchors: Side, limits: list[list[tuple[int, int]]], rows: Side,
             negatives: int) -> tuple:
    """In a cell: places of anchors, ranks of positives, ids and scores of their first rows of other
    labels within the positive's bounds (least and highest score)."""
    anchor_labels, row_labels = numbered_labels(rows, anchors)[::-1]
    codes = rows.codes(row_labels)
    out = ([], [], [], [])
    most = max(map(len, limits), default=0)
    # Bounds that nothing meets where an anchor has fewer positives.
    floor, ceiling = np.full((len(limits), most), np.inf), np.full((len(limits), most), -np.inf)
    for i, bounds in enumerate(limits):
        for k, bound in enumerate(bounds):
            floor[i, k], ceiling[i, k] = bound
    for some in _slices(len(anchors.ids), len(rows.ids)):
        other = anchor_labels[some][:, None] != row_labels[None, :]
        low, high = Planes(anchors.vectors[some]).intervals(codes)
        wanted = np.zeros(other.shape, bool)
        for k in range(most):
            least, top = floor[some, k][:, None], ceiling[some, k][:, None]
            sure = other & (low >= least) & (high <= top)
            border = kth_largest(np.where(sure, low, -np.inf), negatives)[:, None]
            wanted |= other & (high >= least) & (low <= top) & (high >= border)
        score = scores(anchors.vectors[some], rows.vectors, wanted)
        for i in np.flatnonzero(wanted.any(axis=1)):
            j = np.flatnonzero(wanted[i])
            for k, (least, top) in enumerate(limits[some.start + i]):
                inside = j[(score[i, j] >= least) & (score[i, j] <= top)]
                first = inside[first_by_score(score[i, inside], rows.ids[inside], negatives)]
                for column, value in zip(out, (
                        np.full(len(first), anchors.places[some][i]),
                        np.full(len(first), k + 1), rows.ids[first], score[i, first]),
                        strict=True):
                    column.append(value)
    return _joined(*out)


def _slices(anchors: int, rows: int) -> Iterator[slice]:
    step = max(1, PAIRS // max(1, rows))
    return (slice(at, min(at + step, anchors)) for at in range(0, anchors, step))


def _joined(*columns: list[np.ndarray]) -> tuple:
    return tuple(np.concatenate(c) if c else np.empty(0, np.int64) for c in columns)


def encoded(vectors: DataFrame, id_col: str, label_col: str, vector_col: str,
            scale: int = SCALE) -> tuple[DataFrame, int, int]:
    """The rows that take part: id, label, place (a number of their own), vector (integers), block and
    their code with alignment and residual length; the length of the vectors, the number of blocks."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).alias("raw"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("raw")))
    width = rows.agg(F.max(F.size("raw"))).head()[0] or 1
    # Sums of `width` products must fit into 63 bits.
    limit = 2 ** ((62 - max(0, width - 1).bit_length()) // 2)
    double = F.transform("raw", lambda x: F.abs(x.cast("double") * F.lit(float(scale))))
    rows = rows.filter(F.forall(double, lambda x: x < F.lit(float(limit)))).select(
        "id", "label", F.monotonically_increasing_id().alias("place"),
        integers(F.col("raw"), scale).alias("parts"))
    kind = dict(rows.dtypes)["label"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed_rows = []
            for parts in batch.column("parts").to_pylist():
                row = np.zeros(width, "<i8")
                row[:len(parts)] = parts
                packed_rows.append(row.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("id", "label", "place")),
                 pa.array(packed_rows, pa.binary())], ["id", "label", "place", "vector"])

    found = stored(rows.mapInArrow(
        pack, f"id long, label {kind}, place long, vector binary"))
    blocks = max(1, -(-found.count() // BLOCK_ROWS))

    def encode(block: pa.Table) -> pa.Table:
        side = Side(block, width)
        codes = Codes.made(side.vectors, numbered_labels(side)[0])
        columns = {"code": pa.array([w.tobytes() for w in codes.words], pa.binary()),
                   "alignment": pa.array(codes.alignment), "rest": pa.array(codes.rest)}
        return pa.table({name: side.found.column(name) for name in block.column_names} | columns)

    block = F.pmod(F.xxhash64("place"), F.lit(blocks)).alias("block")
    return stored(found.select("*", block).groupBy("block").applyInArrow(
        encode, f"id long, label {kind}, place long, vector binary, block long, code binary, "
                "alignment double, rest double")), width, blocks


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", scale: int = SCALE, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
         high_percent: int = HIGH_PERCENT) -> DataFrame:
    """The hard negatives of every anchor and positive; `is_anchor` speaks of the column `id`."""
    rows, width, row_blocks = encoded(vectors, id_col, label_col, vector_col, scale)
    anchors = rows.filter(is_anchor).select("id", "label", "place", "vector")
    anchor_blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"),
                                               F.lit(count - 1).cast("long")))
    dealt = rows.withColumnRenamed("block", "__row").select(
        "*", every(anchor_blocks).alias("__anchor"))
    spread = lambda frame: frame.select(
        "*", F.pmod(F.xxhash64("place"), F.lit(anchor_blocks)).alias("__anchor"),
        every(row_blocks).alias("__row"))

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, ["place", "near_id", "score"])
        got = near_rows(Side(left, width), Side(right, width), positives)
        return pa.table([pa.array(x, pa.int64()) for x in got], ["place", "near_id", "score"])

    by_cell = dealt.groupBy("__row", "__anchor")
    first = spread(anchors).groupBy("__row", "__anchor").cogroup(by_cell).applyInArrow(
        near, "place long, near_id long, score long")
    rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), "near_id"))
    chosen = first.withColumn("positive_rank", rank).filter(F.col("positive_rank") <= positives)
    bounds = F.struct("positive_rank", F.col("near_id").alias("positive_id"),
                      F.col("score").alias("positive_score"))
    limits = chosen.groupBy("place").agg(F.array_sort(F.collect_list(bounds)).alias("limits"))
    judged = stored(anchors.join(limits, "place"))

    def far(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["place", "positive_rank", "negative_id", "negative_score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names)
        # low * p <= 100 * n <= high * p, for whole numbers n.
        within = [[(-(-low_percent * x["positive_score"] // 100),
                    high_percent * x["positive_score"] // 100) for x in some]
                  for some in left.column("limits").to_pylist()]
        got = far_rows(Side(left, width), within, Side(right, width), negatives)
        return pa.table([pa.array(x, pa.int64()) for x in got], names)

    last = spread(judged).groupBy("__row", "__anchor").cogroup(by_cell).applyInArrow(
        far, "place long, positive_rank long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("place", "positive_rank").orderBy(
        F.desc("negative_score"), "negative_id"))
    found = last.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    names = judged.select("place", F.col("id").alias("anchor_id"), F.inline("limits"))
    return found.join(names.withColumn("positive_rank", F.col("positive_rank").cast("long")),
                      ["place", "positive_rank"]).select(
        "anchor_id", "positive_id", F.col("positive_rank").cast("int").alias("positive_rank"),
        F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
