"""Mixing, packing, WARC packages and the pipeline."""

import hashlib
import io
import struct
import zipfile
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from playlens.llm import mixing, packing, warc

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, number int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1) for i, t, s in rows], SCHEMA)


# --- mixing -------------------------------------------------------------------------------

def brute_targets(sizes):
    """Excess is reshared by weight until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        rest = budget - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
        free -= over


def mix_rows():
    rng = np.random.default_rng(8)
    rows = []
    for i in range(400):
        source = ["b", "a", None, "é", "z", "hot"][min(5, int(rng.exponential(2.5)))]
        rows.append((i, " ".join(["w"] * int(rng.integers(0, 400))), source))
    return [*rows, (400, None, "a"), (401, " \t ", "empty"), (None, "one two", "b"), (5, "x y", "b")]


def test_targets_and_taken(spark):
    rows = mix_rows()
    got = mixing.taken_words(frame(spark, rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = brute_targets(dict(sizes))
    assert len(got) == len(rows)
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_target[round(r.target, 6), r.source_size] += r.taken
    for source, size in sizes.items():
        assert abs(by_target[round(want[source], 6), size] - want[source]) <= 2 * mixing.BLOCK_WORDS
    again = mixing.taken_words(frame(spark, rows).repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_of_empty_and_wordless(spark):
    docs = frame(spark, [(1, None, None), (2, "", "a")])
    assert all(r.taken == 0 and r.target == 0 for r in mixing.taken_words(docs).collect())
    assert mixing.taken_words(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_mixed_documents_hold_the_taken_words(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(n)), s) for i, (n, s) in enumerate(
        [(500, "a"), (70, "b"), (900, "c"), (3, "b"), (0, "a"), (200, None)])]
    rows.append((1, rows[1][1], "b"))  # repeated row
    docs = frame(spark, rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    for r in mixed.collect():
        assert set(r.text.split()) <= set(dict((i, t) for i, t, _ in rows)[r.doc_id].split())
        assert r.n_chars == len(r.text)
        got[r.doc_id] += len(r.text.split())
    want = {r.doc_id: r.taken for r in mixing.taken_words(docs).collect() if r.doc_id != 1}
    assert {i: n for i, n in got.items() if i != 1} == {i: n for i, n in want.items() if n}


def test_permutation_is_one():
    for n in (1, 2, 7, 1000, 4097):
        out = mixing.permuted(np.arange(n), n, 3)
        assert sorted(out.tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), 1000, 3).tolist() != list(range(1000))


def test_shard_counts_vary_as_drawn(spark):
    targets = spark.createDataFrame([(0, 640_000, 640_000.0), (1, 320_000, 320_000.0)],
                                    "number long, source_size long, target double")
    rows = mixing.slots(targets).groupBy("shard", "number").count().collect()
    first = [r["count"] for r in rows if r.number == 0]
    assert sum(first) == 10_000 and np.std(first[:-1]) > 0


# --- packing ------------------------------------------------------------------------------

def test_histogram_packing_is_whole_and_tight():
    rng = np.random.default_rng(0)
    histogram = {int(n): int(rng.integers(1, 900)) for n in rng.integers(1, 4097, 700)}
    patterns = packing.pack_histogram(histogram, 4096)
    got = defaultdict(int)
    for pattern, count in patterns.items():
        assert sum(n * k for n, k in pattern) <= 4096
        for n, k in pattern:
            got[n] += k * count
    assert dict(got) == histogram
    tokens = sum(n * c for n, c in histogram.items())
    assert tokens / (4096 * sum(patterns.values())) > 0.95


def test_packed_pieces(spark):
    texts = ["Hello, World! <|endoftext|> it's", None, "", "a\x1cb", "é 😀 ß", "word " * 9000,
             "again", "again", " \t\n"]
    docs = frame(spark, [(i if i != 6 else None, t, "s") for i, t in enumerate(texts)])
    got = packing.pack(docs).collect()
    plain = Tokenizer.from_file(packing.default_vocabulary())
    ids = {i if i != 6 else None: plain.encode(t or "", add_special_tokens=False).ids + [2]
           for i, t in enumerate(texts)}
    rebuilt, filled = defaultdict(list), defaultdict(list)
    for r in got:
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
        rebuilt[r.doc_id].append((r.start, r.length))
        filled[r.sequence_id].append((r.offset, r.length))
    for i, parts in rebuilt.items():
        assert [s for s, _ in sorted(parts)] == list(np.cumsum([0, *(n for _, n in sorted(parts))])[:-1])
        assert sum(n for _, n in parts) == len(ids[i])
    assert set(rebuilt) == set(ids)
    for parts in filled.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 4096
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    assert packing.pack(docs.limit(0)).count() == 0


def test_repeated_rows_are_all_packed(spark):
    docs = frame(spark, [(1, "same text", "s")] * 5)
    got = packing.pack(docs).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 5


# --- WARC ---------------------------------------------------------------------------------

def test_round_trip_with_odd_rows(spark):
    big = "<p>é</p>" * 300
    rows = [(1, "http://a/ b", big, "x"), (9, None, big, "x"), (9, "u", big, "x"), (3, "u", None, "x"),
            (4, "u", "", "x"), (None, "u", "tiny", "x"), (5, "u", "tiny", "x"), (7, "u\r\nv", "\r\n\r\n", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        html = big if r.page_id in (1, 9) else {3: "", 4: "", None: "tiny", 5: "tiny",
                                                 7: "\r\n\r\n"}[r.page_id]
        assert r.payload_bytes == len(html.encode())
        assert r.payload_digest == hashlib.sha1(html.encode()).hexdigest()
        assert (r.record_type, r.refers_to) == (("revisit", 9) if r.page_id == 1
                                                else ("response", None))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_payloads_come_back(spark, scratch):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    packages = warc.materialized(warc.write(warc.decide(pages), f"file://{scratch}/p", 20_000))
    assert packages.count() > 3
    html = {r.page_id: r.html for r in pages.collect()}
    got = warc.read(packages).filter("record_type = 'response'").collect()
    assert all(bytes(r.payload).decode() == (html[r.page_id] or "") for r in got)


def test_records_are_read_by_many_tasks(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_RECORDS", 7)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    packages = warc.materialized(warc.write(warc.decide(pages), f"file://{scratch}/p", 20_000))
    found = warc.read(packages, payloads=False)
    ranges = sum(-(-r.records // 7) for r in packages.collect())
    assert found.rdd.getNumPartitions() == ranges > packages.count()
    got = [r.page_id for r in found.collect()]
    assert sorted(got) == sorted(r.page_id for r in pages.collect())


def test_taken_words_do_not_depend_on_the_order_of_rows(spark):
    """Repeated ids with different texts: only rows with equal texts may change places."""
    rng = np.random.default_rng(4)
    rows = [(int(i % 40), " ".join(["w"] * int(rng.integers(1, 300))) + f" {i}", "a") for i in range(200)]
    def taken(some):
        return sorted((r.doc_id, r.size, r.taken) for r in
                      mixing.taken_words(frame(spark, some)).collect())
    assert taken(rows) == taken(rows[::-1])


def test_targets_of_many_sources_in_pieces(spark, monkeypatch):
    from playlens.llm import common
    monkeypatch.setattr(common, "PIECE_ROWS", 13)
    rng = np.random.default_rng(2)
    sizes = {f"s{i}": int(rng.integers(0, 2000)) for i in range(150)} | {None: 77, "é": 5}
    rows = [(s, n) for s, n in sizes.items()]
    found = mixing.source_targets(spark.createDataFrame(rows, "source string, size long"))
    assert "SinglePartition" not in str(found._jdf.queryExecution().optimizedPlan())
    got = {r.source: r.target for r in found.collect()}
    assert got == pytest.approx(brute_targets(sizes))


@pytest.mark.parametrize("streamed", [False, True])
def test_directory_agrees_with_zipfile(streamed):
    raw = io.BytesIO()
    with zipfile.ZipFile(warc.Forward(raw) if streamed else raw, "w") as z:
        with z.open("archive/a.warc", "w", force_zip64=True) as member:
            member.write(b"x" * 1000)
        z.writestr("indexes/i", b"hello", zipfile.ZIP_DEFLATED)
        z.writestr("é", b"abc")
    found = warc.members(raw, len(raw.getvalue()))
    assert warc.read_at(raw, found["archive/a.warc"].offset, 1000) == b"x" * 1000
    assert warc.read_at(raw, found["é"].offset, 3) == b"abc"
    with pytest.raises(ValueError, match="compressed"):
        warc.stored(found, "indexes/i")
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.members(io.BytesIO(b"no"), 2)


def test_zip64_directory():
    """A package whose end record and entry refer to the 64-bit forms."""
    name, body = b"archive/data.warc", b"payload"
    local = struct.pack("<4sHHHHHIIIHH", warc.LOCAL, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF,
                        len(name), 0) + name + body
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", warc.ENTRY, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF,
                        0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end_64 = struct.pack("<4sQHHIIQQQQ", warc.END_64, 44, 45, 45, 0, 0, 1, 1, len(entry),
                         len(local))
    locator = struct.pack("<4sIQI", warc.LOCATOR_64, 0, len(local) + len(entry), 1)
    end = struct.pack("<4sHHHHIIH", warc.END, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = local + entry + end_64 + locator + end
    member = warc.members(io.BytesIO(data), len(data))["archive/data.warc"]
    assert data[member.offset:member.offset + member.size] == body


# --- pipeline -----------------------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join",
                                                      "mixing", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns
        assert kept.count() <= before
    packed = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(packed.columns)
    assert packed.count() > 0
