"""Exact n-gram Jaccard join: prefix trees over ordered shingle sets, in blocks of near sets.

1. Documents with equal shingle sets form a class, named by its smallest id.
2. Routing. Two sets with Jaccard j or more differ in at most h = (|A| + |B|)(1 - j)/(1 + j)
   shingles. If shingles are dealt into k > h parts by a hash, at least k - h parts are equal in
   both. Of all equal parts the first in the order (larger first, then by number) is among the first
   h + 1 parts of either set, so every set emits those h + 1 part hashes, once for its own size band
   and once for the next. Sets that share a part hash are tied; ties make groups, and no pair that
   qualifies lies in two groups. Part hashes are shuffled once, packed, ten bytes each, and stored
   nowhere; where texts are read, only the smallest set of a part hash goes on. Hashes are cut short
   for it: equal ones of different parts tie sets that are not near, which costs time and no link.
3. In a group, shingles get one global order (frequent first), the ordered sets form a trie, and
   every set is traversed against it: sets with a common beginning share the count of their overlap,
   and a subtree is left as soon as the overlap so far and the shorter remaining length cannot reach
   the bound, the sizes in it cannot qualify, or all of it is linked with the set already. Qualifying
   pairs are decided by exact counts of 64-bit shingle hashes.
4. A group with more than BLOCK sets is cut into slices, with a few of its sets in every slice. When
   that links the whole group, it is done. The sets that are not in the group's largest class of
   links then meet every slice. That step is quadratic only in sets which share a part hash and
   still do not link.

The result is the connected components of the links; links between sets already connected are not
listed, since they change no component.

Edge cases
    null, empty text      an empty set, linked with nothing
    fewer words           the whole sequence is the one shingle
    null doc_id           takes no part; n_shingles is given, component_id is null; `keep_first`
                          links these rows with each other, under a hash of the text as id
    repeated doc_id       rows with one id are one document, linked with what either is linked with
    ties                  the smallest id names a component
    empty table           empty result
    very long text        its shingles are hashed in one pass; a task holds one text's set at a time
                          and a million part hashes when it reads, the sets of a block when it joins
    other columns         ignored by `join`, returned untouched by `keep_first`, whatever their names
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import (SPACES, bit_maps, materialized, mix, shingle_hashes,
                                 with_maybe, without, wrapped)
from playlens.llm.graph import components

SHINGLE_WORDS = 3
PERCENT = 90
BLOCK = 1000
SHARED_SETS = 16
BUCKETS = 1 << 12  # of part hashes, by their first bits
CHUNK_KEYS = 1 << 20  # part hashes that are packed together, and ties that are thinned together
SHORT = 5  # bytes of a set's name, and of a part hash beside its bucket
FLAT = 32  # subtrees with so few sets are compared side by side


@dataclass(frozen=True)
class Similarity:
    """100 * |A and B| >= percent * |A or B|, in whole numbers."""

    percent: int

    def overlap(self, a: int, b: int) -> int:
        """The smallest overlap with which sets of these sizes qualify."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def sizes_fit(self, a: int, b: int) -> bool:
        return 100 * min(a, b) >= self.percent * max(a, b)


@cache
def band_edges(percent: int, upto: int) -> tuple[int, ...]:
    """First sizes of the bands: a set and its larger partners lie in one band or neighbours."""
    edges = [1]
    while edges[-1] <= upto:
        edges.append(edges[-1] * 100 // percent + 1)
    return tuple(edges)


def part_hashes(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The part hashes a set is routed by, for its own size band and the next."""
    n = len(shingles)
    edges = band_edges(percent, 1 << max(12, int(n * 3).bit_length()))
    band = int(np.searchsorted(edges, n, "right")) - 1
    out = []
    for scheme in (band, band + 1):
        # Sizes in the scheme are below the edge after it.
        most = 2 * (edges[scheme + 1] - 1) * (100 - percent) // (100 + percent)
        if not most:
            continue  # only equal sets qualify
        extra = max(4, most // 4)
        parts = most + 1 + extra
        salt = np.uint64(scheme * 2 + 1)
        dealt = (mix(shingles + salt) % np.uint64(parts)).astype(np.int64)
        sizes = np.bincount(dealt, minlength=parts)
        order = np.argsort(dealt, kind="stable")
        filled = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[filled]
        sums = np.zeros(parts, np.uint64)
        sums[filled] = np.add.reduceat(mix(shingles ^ salt)[order], starts)
        # A set differs from its partners in no more parts than it can in shingles.
        largest = min(n * 100 // percent, edges[scheme + 1] - 1)
        differ = min(most, (n + largest) * (100 - percent) // (100 + percent))
        first = np.lexsort((np.arange(parts), -sizes))[:differ + 1]
        # Empty parts tie sets only if so many are empty that all equal parts may be.
        if parts - len(filled) <= extra:
            first = first[sizes[first] > 0]
        out.append(mix(sums[first] + mix((first + parts * scheme).astype(np.uint64))))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


@dataclass
class Branch:
    """A path of the trie without fork, for the sets low..high in lexicographic order."""

    low: int
    high: int
    segment: np.ndarray
    end: int  # shared tokens from the root to here
    least: int = 0  # sizes of the sets below
    most: int = 0
    longest: int = 0  # shared tokens of the longest set below
    children: list = field(default_factory=list)
    leaves: Leaves | None = None  # sets of children with few sets


@dataclass
class Leaves:
    """The last stretches of sets that branch off one place, side by side."""

    places: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray
    starts: np.ndarray


def grow(ordered: list[np.ndarray], sizes: np.ndarray) -> Branch:
    """The trie of token lists in lexicographic order."""
    lengths = np.array([len(s) for s in ordered])
    root = Branch(0, len(ordered), np.empty(0, np.int64), 0)
    todo = [(root, 0)]
    while todo:
        branch, start = todo.pop()
        first, last = ordered[branch.low], ordered[branch.high - 1]
        upto = min(len(first), len(last))
        different = np.flatnonzero(first[start:upto] != last[start:upto])
        branch.end = start + int(different[0]) if len(different) else upto
        branch.segment = first[start:branch.end]
        within = slice(branch.low, branch.high)
        branch.least, branch.most = int(sizes[within].min()), int(sizes[within].max())
        branch.longest = int(lengths[within].max())
        at, single = branch.low, []
        while at < branch.high and len(ordered[at]) == branch.end:
            at += 1  # sets that end here
        while at < branch.high:
            token, low = ordered[at][branch.end], at
            while at < branch.high and ordered[at][branch.end] == token:
                at += 1
            if at - low > FLAT:
                child = Branch(low, at, np.empty(0, np.int64), 0)
                branch.children.append(child)
                todo.append((child, branch.end))
            else:
                single.extend(range(low, at))
        if single:
            tails = [ordered[i][branch.end:] for i in single]
            ends = np.cumsum([len(t) for t in tails])
            branch.leaves = Leaves(np.array(single), sizes[single], np.concatenate(tails),
                                   np.concatenate([[0], ends[:-1]]))
    return root


def trie_links(sets: list[np.ndarray], like: Similarity, labels: list | None = None,
               probing: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links (positions) that connect what is similar among the sets.

    Sets with equal `labels` count as connected from the start; only sets with `probing` are
    traversed (all, if not given). Links inside what is already connected are left out.
    """
    if len(sets) < 2:
        return []
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True,
                                        return_counts=True)
    # Global order: frequent first. A token of one set only adds to no overlap and is left out.
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, -counts))] = np.arange(len(tokens))
    shared = counts > 1
    kept, at = [], 0
    for s in sets:
        own = inverse[at:at + len(s)]
        kept.append(np.sort(rank[own[shared[own]]]))
        at += len(s)
    order = sorted(range(len(sets)), key=lambda i: kept[i].astype(">i8").tobytes())
    ordered = [kept[i] for i in order]
    sizes = np.array([len(sets[i]) for i in order])
    if labels is None:
        group = np.arange(len(sets))
    else:
        group = np.unique(np.array([labels[i] for i in order]), return_inverse=True)[1]
    root, links = grow(ordered, sizes), []
    inside = np.zeros(len(tokens) + 1, bool)
    for probe in range(len(order)):
        if probing is not None and not probing[order[probe]]:
            continue
        own, size = ordered[probe], int(sizes[probe])
        inside[own] = True
        todo = [(root, 0)]
        while todo:
            branch, overlap = todo.pop()
            # Without a choice of probes every pair is met from its later set.
            high = min(branch.high, probe) if probing is None else branch.high
            if branch.low >= high or not like.sizes_fit(size, min(
                    max(size, branch.least), branch.most)):
                continue
            if (group[branch.low:high] == group[probe]).all():
                continue
            if len(branch.segment):
                overlap += int(np.count_nonzero(inside[branch.segment]))
                left = len(own) - int(np.searchsorted(own, branch.segment[-1], "right"))
            else:
                left = len(own)
            reach = overlap + min(left, branch.longest - branch.end)
            if reach < like.overlap(size, branch.least):
                continue
            hits, at = [], branch.low
            while at < high and len(ordered[at]) == branch.end:
                if overlap >= like.overlap(size, int(sizes[at])):
                    hits.append(at)
                at += 1
            if (leaves := branch.leaves) is not None and leaves.places[0] < high:
                overlaps = overlap + np.add.reduceat(inside[leaves.tokens], leaves.starts,
                                                     dtype=np.int64)
                fits = (overlaps >= like.overlap(size, leaves.sizes)) & (leaves.places < high)
                hits += leaves.places[fits].tolist()
            for at in hits:
                if group[at] != group[probe]:
                    links.append((order[probe], order[at]))
                    group[group == group[at]] = group[probe]
            todo.extend((child, overlap) for child in branch.children)
        inside[own] = False
    return links


def short_name(digest: bytes) -> int:
    """The first bytes of a set's digest, its name among ties."""
    return int.from_bytes(digest[:SHORT], "big")


def to_short(values: np.ndarray) -> np.ndarray:
    """Whole numbers as rows of SHORT bytes."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - SHORT:]


def from_short(rows: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, 8 - SHORT:] = rows
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def smallest_and_tied(keys: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order and the smallest name of each; keys in order and the pairs (name,
    smallest name) of the other names."""
    order = np.argsort(keys)
    keys, names = keys[order], names[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    hubs = np.minimum.reduceat(names, starts)
    each = np.repeat(hubs, np.diff(np.append(starts, len(keys))))
    other = names != each
    return keys[starts], hubs, keys[other], np.stack([names[other], each[other]])


def first_places(pairs: np.ndarray) -> np.ndarray:
    """Where each distinct pair comes first."""
    order = np.lexsort(pairs)
    both = pairs[:, order]
    changed = (both[:, 1:] != both[:, :-1]).any(axis=0)
    return order[np.concatenate([np.ones(min(1, len(order)), bool), changed])]


def as_stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Each linked node with the smallest node it is connected to."""
    top: dict[int, int] = {}

    def root(node: int) -> int:
        while top.setdefault(node, node) != node:
            top[node] = top[top[node]]
            node = top[node]
        return node

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        top[high] = low
    return [(node, root(node)) for node in list(top) if root(node) != node]


def thinned(pairs: list[np.ndarray]) -> np.ndarray:
    """Pairs that connect what the given ones connect, one per name at most."""
    together = np.concatenate(pairs, axis=1)
    together = together[:, first_places(together)]
    stars = as_stars(list(zip(*together.tolist(), strict=True)))
    return np.array(stars, np.int64).reshape(-1, 2).T


FACT = {"doc_id": pa.int64(), "n_shingles": pa.int64(), "same": pa.binary()}
TIE = {"a": pa.int64(), "b": pa.int64()}


def _rows(columns: dict[str, pa.DataType], values: dict) -> pa.RecordBatch:
    """Columns that are not given are null."""
    n = max(map(len, values.values()))
    return pa.RecordBatch.from_arrays([
        pa.array(values[name], kind) if name in values else pa.nulls(n, kind)
        for name, kind in columns.items()], list(columns))


def facts_and_ties(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Facts: doc_id, n_shingles, same (digest of the set, null if empty), a row per document.

    Ties: pairs (a, b) of short names of sets that share a part hash, enough of them to connect all
    such sets; rows without doc_id take no part.
    """
    packed = {"bucket": pa.int32(), **FACT, **TIE, "keys": pa.binary()}
    key_bits, short_bits = 64 - 8 * SHORT - (BUCKETS - 1).bit_length(), np.uint64(8 * SHORT)

    def chunk(keys: list[np.ndarray], names: list[int]) -> Iterator[pa.RecordBatch]:
        """A row for the part hashes of each bucket, and one for each tie found here.

        A tie is in the bucket of its smallest part hash: whichever rows a repeated task puts
        together, a bucket has all of its part hashes or ties that smaller ones make.
        """
        each = np.repeat(np.array(names, np.uint64), [len(k) for k in keys])
        joined, hubs, found_at, pairs = smallest_and_tied(
            np.concatenate(keys) >> np.uint64(key_bits), each)
        blob = np.hstack([to_short(joined), to_short(hubs)])
        buckets, starts = np.unique(joined >> short_bits, return_index=True)
        ends = [*starts[1:].tolist(), len(joined)]
        yield _rows(packed, {"bucket": buckets.astype(np.int32), "keys": [
            blob[low:high].tobytes() for low, high in zip(starts.tolist(), ends, strict=True)]})
        if len(found_at):
            first = first_places(pairs)
            a, b = pairs[:, first].astype(np.int64)
            yield _rows(packed, {"bucket": (found_at[first] >> short_bits).astype(np.int32),
                                 "a": a, "b": b})

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, names, held = [], [], 0
        for batch in batches:
            sizes, digests, ids = [], [], batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                shingles = shingle_hashes(text, words)
                sizes.append(len(shingles))
                digests.append(hashlib.sha256(shingles.tobytes()).digest()[:16] if len(shingles)
                               else None)
                if doc_id is None or not len(shingles):
                    continue
                keys.append(part_hashes(shingles, percent))
                names.append(short_name(digests[-1]))
                held += len(keys[-1])
                if held >= CHUNK_KEYS:
                    yield from chunk(keys, names)
                    keys, names, held = [], [], 0
            # By what they hold: a repeated task may meet its rows in another order.
            places = mix(np.array([short_name(digest or b"") if doc_id is None else doc_id
                                   for doc_id, digest in zip(ids, digests, strict=True)],
                                  np.int64).view(np.uint64)) % np.uint64(BUCKETS)
            yield _rows(packed, {"bucket": places.astype(np.int32), "doc_id": ids,
                                 "n_shingles": sizes, "same": digests})
        if held:
            yield from chunk(keys, names)

    def ties_of(bucket: list[bytes]) -> np.ndarray:
        rows = np.frombuffer(b"".join(bucket), np.uint8).reshape(-1, 2 * SHORT)
        return smallest_and_tied(from_short(rows[:, :SHORT]), from_short(rows[:, SHORT:]))[3]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {**FACT, **TIE}
        current, bucket, pairs, held = None, [], [], 0
        for batch in batches:
            known = batch.column("keys").is_null()
            yield batch.filter(known).select(list(out))
            rest = batch.filter(batch.column("keys").is_valid())
            columns = [rest.column(n).to_pylist() for n in ("bucket", "keys")]
            for name, blob in zip(*columns, strict=True):
                if name != current and bucket:
                    pairs.append(ties_of(bucket))
                    bucket, held = [], held + pairs[-1].shape[1]
                    if held >= CHUNK_KEYS:
                        a, b = thinned(pairs)
                        yield _rows(out, {"a": a, "b": b})
                        pairs, held = [], 0
                current = name
                bucket.append(blob)
        if bucket:
            pairs.append(ties_of(bucket))
        if any(p.size for p in pairs):
            a, b = thinned(pairs)
            yield _rows(out, {"a": a, "b": b})

    fact, tie = "doc_id long, n_shingles long, same binary", "a long, b long"
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = materialized(
        docs.mapInArrow(describe, f"bucket int, {fact}, {tie}, keys binary")
        .repartition(width, "bucket").sortWithinPartitions("bucket")
        .mapInArrow(meet, f"{fact}, {tie}"))
    return met.filter("a IS NULL").select(*FACT), met.filter("a IS NOT NULL").select(*TIE)


def linked_in_blocks(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) found in each block; rows have block, rep, label, probing, text.

    Rows of a block arrive one after another; a task holds one block at a time.
    """
    like = Similarity(percent)

    def solve(block: list[tuple]) -> list[tuple[int, int]]:
        sets = [shingle_hashes(text, words) for *_, text in block]
        choice = [probing for _, _, probing, _ in block]
        found = trie_links(sets, like, [label for _, label, _, _ in block],
                           None if all(choice) else choice)
        return as_stars([(block[i][0], block[j][0]) for i, j in found])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, []
        for batch in batches:
            links = []
            columns = [batch.column(n).to_pylist() for n in
                       ("block", "rep", "label", "probing", "text")]
            for name, *row in zip(*columns, strict=True):
                if name != current:
                    links += solve(block)
                    current, block = name, []
                block.append(tuple(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])
        links = solve(block)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    # Blocks cost by their pairs, not by their bytes: a fixed width keeps them apart.
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, "block").sortWithinPartitions("block").mapInArrow(
        walk, "a long, b long")


def _slices(count: str):
    return F.ceil(F.col(count) / BLOCK).cast("int")


def _slice_of(count: str):
    return F.pmod(F.xxhash64("rep", F.lit(1)), _slices(count)).cast("int")


def tied_classes(ties: DataFrame, classes: DataFrame) -> DataFrame:
    """rep, tied: the classes that are tied to others, and the name of their group.

    Classes with one short name are in one group.
    """
    name = F.conv(F.hex(F.substring("same", 1, SHORT)), 16, 10).cast("long")
    named = classes.select("rep", name.alias("node"))
    twins = named.groupBy("node").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter(
        "low < high").select("node", F.col("node").alias("component"))
    groups = components(ties).unionByName(twins).groupBy("node").agg(
        F.min("component").alias("tied"))
    return named.join(groups, "node").select("rep", "tied").distinct()


def near_links(docs: DataFrame, ties: DataFrame, classes: DataFrame, words: int, percent: int
               ) -> DataFrame:
    """Links (a, b) between classes.

    `docs` has doc_id and text, `ties` the pairs of short names, `classes` rep and same.
    """
    grouped = materialized(tied_classes(ties, classes))
    counts = grouped.groupBy("tied").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialized(grouped.join(counts, "tied"))
    texts = with_maybe(docs.select(F.col("doc_id").alias("rep"), "text"),
                       bit_maps(members, "rep"), "rep").filter("__maybe").drop("__maybe")
    small = F.col("n") <= BLOCK
    everywhere = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("n")) < SHARED_SETS
    places = F.when(small, F.array(F.lit(0))).when(
        everywhere, F.sequence(F.lit(0), _slices("n") - 1)).otherwise(F.array(_slice_of("n")))
    first = members.select("rep", "tied", F.explode(places).alias("slice"))
    links = materialized(linked_in_blocks(
        first.join(texts, "rep").select(
            F.struct("tied", F.lit(0).alias("other"), "slice").cast("string").alias("block"),
            "rep", F.col("rep").alias("label"), F.lit(True).alias("probing"), "text"),
        words, percent))
    large = members.filter(~small)
    if large.isEmpty():
        return links
    named = components(links).withColumnsRenamed({"node": "rep", "component": "label"})
    labelled = materialized(large.join(named, "rep", "left").withColumn(
        "label", F.coalesce("label", "rep")))
    main = (labelled.groupBy("tied", "label").agg(F.count("*").alias("size"))
            .groupBy("tied").agg(F.max_by("label", F.struct("size", "label")).alias("main"),
                                 (F.sum("size") - F.max("size")).alias("rest"))
            .filter("rest > 0"))
    open_ = materialized(labelled.join(main, "tied"))
    if open_.isEmpty():
        return links
    outside = F.col("label") != F.col("main")
    # Slices of the sets outside the main class (rows) meet slices of all sets (columns).
    probes = open_.filter(outside).select("*", F.lit(True).alias("probing"), F.explode(F.sequence(
        F.lit(0), _slices("n") - 1)).alias("slice")).withColumn("other", _slice_of("rest"))
    rest = open_.select("*", F.lit(False).alias("probing"), F.explode(F.sequence(
        F.lit(0), _slices("rest") - 1)).alias("other")).withColumn("slice", _slice_of("n"))
    second = probes.unionByName(rest).select(
        F.struct("tied", "other", "slice").cast("string").alias("block"), "rep", "label",
        "probing")
    return links.unionByName(materialized(linked_in_blocks(
        second.join(texts, "rep"), words, percent)))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) per document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    facts, ties = facts_and_ties(rows, words, percent)
    classes = materialized(facts.filter("same IS NOT NULL AND doc_id IS NOT NULL").groupBy(
        "same").agg(F.min("doc_id").alias("rep")))
    members = facts.select("doc_id", "same").join(classes, "same")
    links = near_links(rows, ties, classes, words, percent)
    # Rows of one id in several classes tie these classes.
    several = members.groupBy("doc_id").agg(
        F.min("rep").alias("b"), F.max("rep").alias("far")).filter("b < far").drop("far")
    repeated = members.select("doc_id", "rep").join(several, "doc_id").select(
        F.col("rep").alias("a"), "b")
    found = components(links.unionByName(repeated))
    placed = facts.select("doc_id", "n_shingles", "same").join(classes, "same", "left")
    return placed.join(found, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.when(
            F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
        .alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns.

    Only the ids that go are joined with the documents. Rows without an id are linked with each
    other only; a hash of the text is their id, equal texts stay once, rows without words all.
    """
    def kept(rows: DataFrame) -> DataFrame:
        gone = join(rows.select("key", F.col("doc")[text_col].alias("text")), "key", "text", words,
                    percent).filter("component_id <> doc_id").select("doc_id").distinct()
        return without(rows, gone, "key")

    rows = wrapped(docs, id_col)
    nameless = rows.filter("key IS NULL")
    if nameless.isEmpty():
        return kept(rows).select("doc.*")
    text = F.col("doc")[text_col]
    blank = F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "") == ""
    keyed = nameless.filter(~blank).withColumn("key", F.xxhash64(text))
    return kept(rows.filter("key IS NOT NULL")).select("doc.*").unionByName(
        nameless.filter(blank).select("doc.*")).unionByName(
        kept(keyed).dropDuplicates(["key"]).select("doc.*"))
