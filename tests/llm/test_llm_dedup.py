"""Exact dedup, n-gram join and MinHash against brute force and on odd rows."""

import hashlib
import re
from pathlib import Path

import numpy as np
import pytest

from pyspark.sql import functions as F

from playlens.llm import exact_dedup, minhash, mixing, ngram_join
from playlens.llm.common import shared_folder, shingle_hashes
from playlens.llm.graph import components

SCHEMA = "doc_id long, text string, keep_id string, label int"
SMALL = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "other", 1) for i, t in rows], SCHEMA)


def random_texts(n, seed=0):
    """Texts with groups of near copies, an often repeated passage, and short ones."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(words, 30))
    texts = []
    while len(texts) < n:
        base = list(rng.choice(words, rng.integers(1, 90)))
        if rng.random() < 0.3:
            base = passage + base
        for _ in range(rng.integers(1, 6)):
            copy = list(base)
            for _ in range(rng.integers(0, 4)):
                copy[rng.integers(len(copy))] = str(rng.choice(words))
            texts.append(" ".join(copy))
    return texts[:n]


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute_components(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                common = len(sets[x] & sets[y])
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                    low, high = sorted((root(x), root(y)))
                    top[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


# --- exact dedup --------------------------------------------------------------------------

def test_refine_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(
        ["a  b", "a\tb", "", None, " ", "a b ", "x" * 5000, "x" * 5000, "x" * 4999 + "y", "é", "e"])]
    got = {r.doc_id: r for r in exact_dedup.refine(frame(spark, rows), hash_all=True).collect()}
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    for body, ids in groups.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (ids[0], len(ids),
                                                                        i == ids[0])
            assert got[i].full_hash == hashlib.sha256(body.encode()).hexdigest()


def test_full_hash_is_taken_for_survivors_only(spark):
    got = exact_dedup.refine(frame(spark, [(1, "alone here"), (2, "twin"), (3, "twin")])).collect()
    assert {r.doc_id: r.full_hash is not None for r in got} == {1: False, 2: True, 3: True}


def test_deduplicate_odd_rows(spark):
    docs = frame(spark, [(5, "t"), (2, "t"), (2, "t"), (None, "n"), (7, None), (8, ""), (9, "z")])
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 2), (False, 7), (False, 9), (True, 0)]
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0
    assert exact_dedup.refine(docs.limit(0)).count() == 0


def test_deduplicate_rows_without_id(spark):
    rows = [(None, "t"), (4, "t"), (4, "t"), (None, "u  v"), (None, "u v"), (None, "u v"),
            (None, None), (None, ""), (None, "alone")]
    kept = exact_dedup.deduplicate(frame(spark, rows)).collect()
    found = sorted((str(r.doc_id), " ".join((r.text or "").split())) for r in kept)
    assert found == [("4", "t"), ("None", ""), ("None", "alone"), ("None", "u v")]


def test_null_id_in_a_group(spark):
    got = exact_dedup.refine(frame(spark, [(None, "t"), (4, "t"), (None, "u"), (None, "u")]))
    assert sorted((str(r.doc_id), str(r.keep_id), r.kept) for r in got.collect()) == [
        ("4", "4", True), ("None", "4", False), ("None", "None", False), ("None", "None", True)]


# --- n-gram join --------------------------------------------------------------------------

@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_join_against_brute_force(spark, size, percent):
    rows = list(enumerate(random_texts(220, seed=percent)))
    rows += [(1000, None), (1001, ""), (1002, " \t "), (1003, "One TWO"), (1004, "one two")]
    got = ngram_join.join(frame(spark, rows), words=size, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == \
        brute_components(rows, size, percent)


def test_sliced_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "SHARED_SETS", 1)
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.integers(0, 5)):
            copy[rng.integers(60)] = f"n{rng.integers(1000)}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    got = ngram_join.join(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 3, 90)


def groups(links):
    top = {}

    def root(i):
        while top.setdefault(i, i) != i:
            i = top[i]
        return i

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        top[high] = low
    return {i: root(i) for i in list(top)}


@pytest.mark.parametrize("chunk", [1, 1000, 1 << 20])
def test_ties_connect_sets_that_share_a_part_hash(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK_KEYS", chunk)
    rows = [*enumerate(random_texts(150, seed=3)), (7, "a b c"), (1000, None), (1001, ""),
            (None, "w1 w2 w3 w4 w5 w6 w7 w8"), (1002, "w1 w2 w3 w4 w5 w6 w7 w8")]
    docs = frame(spark, rows).select("doc_id", "text").repartition(3)
    facts, ties = ngram_join.facts_and_ties(docs, 5, 80)
    sets = [(i, shingle_hashes(t, 5)) for i, t in rows]
    digests = [hashlib.sha256(s.tobytes()).digest()[:16] if len(s) else None for _, s in sets]
    want = sorted(((i, len(s), d) for (i, s), d in zip(sets, digests, strict=True)), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.same and bytes(r.same)) for r in facts.collect()),
                  key=str) == want
    holders = {}
    for (i, s), digest in zip(sets, digests, strict=True):
        for key in ngram_join.part_hashes(s, 80).tolist() if i is not None and len(s) else ():
            holders.setdefault(key, set()).add(ngram_join.short_name(digest))
    links = [(min(names), n) for names in holders.values() for n in names if len(names) > 1]
    assert groups((r.a, r.b) for r in ties.collect()) == groups(links) != {}


def test_classes_with_one_short_name_meet(spark):
    name, other = b"12345", b"54321"
    classes = spark.createDataFrame(
        [(1, name + b"x"), (2, name + b"y"), (3, other), (4, b"alone"), (5, name + b"z")],
        "rep long, same binary")
    a, b = sorted(map(ngram_join.short_name, (name, other)))
    none, one = [spark.createDataFrame(rows, "a long, b long") for rows in ([], [(a, b)])]
    assert sorted(r.rep for r in ngram_join.tied_classes(none, classes).collect()) == [1, 2, 5]
    tied = ngram_join.tied_classes(one, classes).collect()
    assert sorted(r.rep for r in tied) == [1, 2, 3, 5] and {r.tied for r in tied} == {a}


def test_part_hashes_are_on_disk_once(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(map(str, rng.integers(1 << 30, size=3000)))) for i in range(300)]
    keys = sum(len(ngram_join.part_hashes(shingle_hashes(t, 3), 90)) for _, t in rows)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def on_disk():
        files = blocks.diskBlockManager().getAllFiles()
        return {files.apply(i).getName(): files.apply(i).length() for i in range(files.size())} | {
            str(p): p.stat().st_size for p in folder.rglob("part-*")}

    before, most = set(on_disk()), []

    def measured(df, plain=ngram_join.materialized):
        df = plain(df)
        most.append(sum(size for name, size in on_disk().items() if name not in before))
        return df

    monkeypatch.setattr(ngram_join, "materialized", measured)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_join.join(docs).filter("component_id = doc_id").count() == 300
    # Ten bytes each, and what names the rows that hold them.
    assert 8 * keys < max(most) < 16 * keys


def test_trie_links_with_deep_branches(monkeypatch):
    monkeypatch.setattr(ngram_join, "FLAT", 1)
    texts = random_texts(120, seed=9)
    sets = [shingle_hashes(t, 3) for t in texts]
    found = ngram_join.trie_links(sets, ngram_join.Similarity(70))
    top = dict(enumerate(range(len(sets))))

    def root(i):
        return i if top[i] == i else root(top[i])

    for a, b in found:
        low, high = sorted((root(a), root(b)))
        top[high] = low
    want = brute_components(list(enumerate(texts)), 3, 70)
    assert {i: root(i) for i in top} == {i: c for i, (_, c) in want.items()}


def test_keep_first_without_ids(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(None, text), (None, text), (None, f"{text} more"), (None, "quite different from it"),
            (None, None), (None, " "), (5, "a row with an id"), (6, "a row with an id")]
    docs = frame(spark, rows)
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(kept) == 5 and sum("t59" in (t or "") for _, t in kept) == 1
    assert {rows[3], rows[4], rows[5], rows[6]} < set(kept)


def test_join_odd_rows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(3, text), (None, text), (8, text), (8, "something quite different here"),
            (1, "something quite different here"), (3, text)]
    docs = frame(spark, rows)
    got = sorted((str(r.doc_id), str(r.component_id)) for r in ngram_join.join(docs).collect())
    assert got == [("1", "1"), ("3", "1"), ("3", "1"), ("8", "1"), ("8", "1"), ("None", "None")]
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]
    assert ngram_join.join(docs.limit(0)).count() == 0
    assert ngram_join.keep_first(docs.limit(0)).count() == 0


def test_long_text_meets_its_copy(spark):
    words = [f"v{i}" for i in range(30_000)]
    edited = list(words)
    edited[100] = edited[20_000] = "new"
    got = ngram_join.join(frame(spark, [(1, " ".join(words)), (2, " ".join(edited))])).collect()
    assert {r.component_id for r in got} == {1}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (102, 100)]
    got = {r.node: r.component for r in
           components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- MinHash ------------------------------------------------------------------------------

def brute_edit(rows):
    ordered = sorted(rows)
    out = {}
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1] or ""
        text = text or ""
        half = len(text) // 2
        out[i] = (len(text), text[:len(text) - half] + following[:half])
    return out


@pytest.mark.parametrize("ranges", [1, 7])
def test_fingerprints_of_edited_texts(spark, ranges):
    rows = list(enumerate([*random_texts(60), None, "", "é" * 9, "ab"]))
    got = minhash.fingerprints(frame(spark, rows), ranges=ranges).collect()
    want = brute_edit(rows)
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        n, edited = want[r.doc_id]
        assert r.n_chars == n
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        mark = minhash.fingerprint(texts[r.doc_id])
        assert r.fingerprint == mark.astype(">u4").tobytes().hex()
        a, b = shingles(texts[r.doc_id], 5), shingles(edited, 5)
        exact = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(r.near_edited - exact) < 0.25


def test_fingerprints_odd_rows(spark):
    docs = frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, None)])
    got = minhash.fingerprints(docs).collect()
    assert len(got) == 3 and len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert minhash.fingerprints(docs.limit(0)).count() == 0
    assert len(minhash.fingerprints(frame(spark, [(4, "one")])).collect()) == 1


def test_search_finds_similar_classes(spark):
    rows = list(enumerate(random_texts(150, seed=2)))
    docs = frame(spark, rows)
    members, links = minhash.search(docs, docs.filter("doc_id % 10 = 0"))
    sets = {i: shingles(t, 5) for i, t in rows}
    of = {r.doc_id: r.class_id for r in members.collect()}
    got = {(r.query_class, r.class_id) for r in links.collect()}
    want = {(of[x], of[y]) for x in sets for y in sets if x % 10 == 0 and of[x] != of[y]
            and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])}
    assert got <= want and len(got) >= 0.9 * len(want)


def sizes_of(frame, column="__range"):
    return sorted(r["count"] for r in frame.groupBy(column).count().collect())


def test_null_and_repeated_ids_spread_over_ranges(spark):
    rows = [(None if i % 2 else 7, f"text number {i} of many words " * 5) for i in range(800)]
    docs = frame(spark, rows).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = minhash.in_order(docs, 8)
    sizes = sizes_of(ordered.filter("NOT __head"))
    assert len(sizes) >= 6 and max(sizes) < 250
    got = minhash.fingerprints(frame(spark, rows), ranges=8).collect()
    assert len(got) == 800 and sum(r.doc_id is None for r in got) == 400
    texts = {hashlib.sha256(r.fingerprint.encode()).hexdigest() for r in got}
    assert len(texts) > 700


def test_ranges_hold_about_equal_bytes(spark):
    rows = [(i, "w" * (4000 if i < 100 else 20)) for i in range(1000)]
    docs = frame(spark, rows).select("doc_id", "text")
    bytes_ = [r["b"] for r in minhash.in_order(docs, 4).filter("NOT __head").groupBy("__range").agg(
        F.sum(F.length("text")).alias("b")).collect()]
    assert len(bytes_) == 4 and max(bytes_) < 1.6 * sum(bytes_) / 4


def test_search_recall_on_the_given_table(spark):
    """The registered query against all pairs of shingle sets, whole table."""
    from playlens.llm import queries

    links = {(r.query_class, r.class_id) for r in queries.minhash_search(
        spark, "/root/testdata/sf0.1").collect()}
    sets = {r.doc_id: shingles(r.text, 5) for r in spark.read.parquet(
        "/root/testdata/sf0.1/documents.parquet").collect()}
    first, of = {}, {}
    for i in sorted(sets):
        of[i] = first.setdefault(sets[i], i) if sets[i] else i
    want = set()
    for x in (i for i in sets if i % 100 == 0 and sets[i]):
        for y in first.values():
            a, b = len(sets[x]), len(sets[y])
            if of[x] != y and 5 * min(a, b) >= 4 * max(a, b):
                both = len(sets[x] & sets[y])
                if both >= 0.8 * (a + b - both):
                    want.add((of[x], y))
    assert want and links <= want and len(links) >= 0.9 * len(want)


CLASHING = ("__length", "__prefix", "__maybe", "__bits", "__bucket", "__id", "key", "doc", "__row",
            "__key", "hash", "body", "number", "n", "first", "taken", "lap", "__runs", "text_key")


def clashing(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    return docs.withColumns({name: F.lit(i) for i, name in enumerate(CLASHING)})


def test_columns_that_clash_with_working_names(spark):
    rows = [(1, "a b c d e f g", "x", 1), (2, "a  b c d e f g", "x", 1), (3, None, "y", 0),
            (None, "p q r s t u v", "x", 1), (None, "p q r s t u v", "x", 1), (4, "h i j k l", None, 1),
            (4, "h i j k l", None, 1), (5, " ".join(["long"] * 50_000), "y", 1)]
    docs = clashing(spark, rows)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "None"]
    near = ngram_join.keep_first(docs)
    assert near.columns == docs.columns and near.count() >= 5
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {tuple(r[name] for name in CLASHING) for r in mixed.collect()} == {
        tuple(range(len(CLASHING)))}


def test_rows_set_apart_meet_no_join(spark):
    """Most rows have no full hash; they must not meet in one task as null keys."""
    docs = frame(spark, [(i, f"text {i} " + "x" * i) for i in range(300)] + [(400, "same")] * 2)
    found = exact_dedup.refine(docs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__maybe" in plan.split("Join LeftOuter")[1]
    assert sorted((r.doc_id, r.kept, r.group_size) for r in found.collect())[:2] == [
        (0, True, 1), (1, True, 1)]
    assert sum(r.full_hash is None for r in found.collect()) == 300
