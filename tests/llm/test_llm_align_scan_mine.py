"""Cross-tokenizer alignment, license scans and hard negatives."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playlens.llm import alignment, common, hard_negatives, license_scan, queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, links string, place int, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0, "y") for i, t in rows], SCHEMA)


# --- alignment ----------------------------------------------------------------------------

def brute_tokens(texts):
    """Ids and bytes of the tokens of A and B, straight from the two libraries."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letter = common.byte_letters()
    name = {i: bytes(letter[c] for c in t) for t, i in a.get_vocab().items()
            if all(c in letter for c in t)}

    def piece(i):
        text = b.id_to_piece(i)
        found = re.fullmatch("<0x(..)>", text)
        return bytes([int(found[1], 16)]) if found else text.replace("▁", " ").encode()

    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        yield ids_a, [name[i] for i in ids_a], ids_b, [piece(i) for i in ids_b]


def brute_alignment(rows):
    linked, pairs = [], Counter()
    for (_, text), (ids_a, parts_a, ids_b, parts_b) in zip(
            rows, brute_tokens([t for _, t in rows]), strict=True):
        body = (" " + (text or "")).encode()
        if not text or b"".join(parts_a) != body or b"".join(parts_b) != body:
            linked.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]), np.cumsum([len(p) for p in parts_b])
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, links, at_a, at_b = [], [], 0, 0
        for cut in cuts:
            past_a, past_b = at_a, at_b
            while at_a < len(ids_a) and ends_a[at_a] <= cut:
                at_a += 1
            while at_b < len(ids_b) and ends_b[at_b] <= cut:
                at_b += 1
            groups.append(",".join(map(str, ids_a[past_a:at_a])) + "|"
                          + ",".join(map(str, ids_b[past_b:at_b])))
            links.append((ids_a[at_a - 1], ids_b[at_b - 1]))
        pairs.update(links)
        linked.append((len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), found in zip(rows, linked, strict=True):
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        out.append((i, n_a, n_b, len(groups), len(links),
                    sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = [*rows[:60], (900, None), (901, ""), (902, " "), (903, "  two  spaces "), (904, "a ▁ b"),
            (905, "<|endoftext|> <s></s> <unk>"), (906, "日本語 🎉é ﬁ\x00\t\n"), (907, "a" * 3000),
            (908, "the the"), (908, "the the"), (None, "no id"), (909, "x" + "\n" * 50), (910, "é"),
            (911, " ".join(["word", "längere", "mots"] * 20_000))]
    got = alignment.alignments(frame(spark, rows)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute_alignment(rows)


def test_alignment_of_no_rows_and_groups(spark):
    assert alignment.alignments(frame(spark, [])).count() == 0
    rows = [(1, "hello unbelievable wörld"), (2, None)]
    got = {r.doc_id: r.groups for r in alignment.groups(frame(spark, rows)).collect()}
    assert got[2] == []
    ids_a, parts_a, ids_b, parts_b = next(iter(brute_tokens([rows[0][1]])))
    assert [i for g in got[1] for i in g.a] == ids_a and [i for g in got[1] for i in g.b] == ids_b
    size_a, size_b = dict(zip(ids_a, map(len, parts_a))), dict(zip(ids_b, map(len, parts_b)))
    assert all(sum(size_a[i] for i in g.a) == sum(size_b[i] for i in g.b) for g in got[1])


@pytest.mark.parametrize("seed", range(5))
def test_shared_cuts(seed):
    """Dense, sparse, one-sided and missing common ends, several texts side by side."""
    rng = np.random.default_rng(seed)
    a_ends, b_ends, last, begin = [], [], [], 0
    for share in (0.0, 0.02, 0.3, 0.9, 1.0, 0.0):
        length = int(rng.integers(1, 4000))
        inner = np.arange(1, length)
        a = inner[rng.random(len(inner)) < 0.5]
        b = np.where(rng.random(len(a)) < share * (np.arange(len(a)) < len(a) / 2), a, a + 0.5)
        a_ends += [*(a * 2 + begin), begin + 2 * length]
        b_ends += [*np.unique((b * 2).astype(int) + begin), begin + 2 * length]
        last.append(len(a_ends) - 1)
        begin += 2 * length
    a_ends, b_ends = np.array(a_ends), np.array(b_ends)
    got = alignment.shared_cuts(a_ends, b_ends, np.array(last))
    assert (got == np.isin(a_ends, b_ends)).all()


def test_links_are_suffixes():
    pair = alignment.pair_of(*alignment.default_paths())
    assert len(pair.keys) < 600_000
    for key in random.Random(2).sample(pair.keys.tolist(), 2000):
        a, b = divmod(key, len(pair.b.entries))
        left, right = pair.a.entries[a], pair.b.entries[b]
        assert left.endswith(right) or right.endswith(left)


# --- license scans ------------------------------------------------------------------------

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_base(text):
    words = WORDS.findall(lower(text))
    places = [(i, label) for phrase, label in license_scan.BASE.items()
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


MIT = """The MIT License (MIT). Copyright (c) 2020 Someone. Permission is hereby granted, free of charge,
to any person obtaining a copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software."""


def test_base_places_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(-1, None), (-2, ""), (None, "MIT-license, mit License; apache\nlicense"), (-3, "éMIT license"),
             (-4, "general general public license public license"), (-4, "mit license"),
             (-5, "mit " * 50_000 + "license"), (-6, "MIT license" * 3)]
    found = license_scan.digest(license_scan.scan(frame(spark, rows)))
    got = sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                  for r in found.collect()], key=str)
    assert got == sorted([(i, *brute_base(t)) for i, t in rows], key=str)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
               for r in found.collect())
    assert sum(r.score >= 0.9 for r in found.collect()) > 5


def test_templates_accept_only_their_wording(spark):
    body = MIT[MIT.index("Permission"):]
    rows = [(1, MIT), (2, body), (3, body.replace("free of charge", "for a fee")),
            (4, body.replace("and this permission notice", "and this permission notice "
                             "(including the next paragraph)")),
            (5, "Licensed under the Apache License, Version 2.0"),
            (6, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                "file except in compliance with the License."),
            (7, "licensed under the apache license version two"),
            (8, "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License, or (at your option) any later version."),
            (9, "SPDX-License-Identifier: BSD-3-Clause")]
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, rows)).collect()}
    own = {i: {p.label for p in r.places if not p.base} for i, r in got.items()}
    assert own == {1: {"mit-text"}, 2: {"mit-text"}, 3: set(), 4: {"mit-text"},
                   5: {"apache-2.0-notice"}, 6: {"apache-2.0-notice"}, 7: set(), 8: {"gpl-notice"},
                   9: {"spdx-tag"}}
    place = next(p for p in got[6].places if not p.base)
    assert (place.start, place.end) == (0, 22)
    assert license_scan.scan(frame(spark, [])).count() == 0


def regex_of(template):
    """The same template as a regular expression over words joined by spaces, each with one behind."""
    out = ""
    for m in license_scan.MARKUP.finditer(template):
        if m[3]:
            out += re.escape(m[3]) + " "
        elif m[1]:
            out += rf"(?:\S+ ){{{m[1]},{m[2]}}}"
        else:
            out += "(?:" if m[0] == "[[" else ")?"
    return re.compile(out)


@pytest.mark.parametrize("seed", range(30))
def test_automata_against_regular_expressions(seed):
    """Random templates over three words against every start of random texts; ends are the longest."""
    rng = random.Random(seed)

    def template(depth):
        parts = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if kind < 0.25 and depth:
                parts.append(f"[[{template(depth - 1)}]]")
            elif kind < 0.4:
                low = rng.randint(0, 2)
                parts.append(f"<<x:{low}-{low + rng.randint(0, 3)}>>")
            else:
                parts.append(rng.choice("abc"))
        return " ".join(parts)

    text = f"a {template(2)} b"
    automaton, regex = license_scan.Automaton(text), regex_of(text)
    for _ in range(20):
        words = [rng.choice("abcd") for _ in range(14)]
        for start in range(len(words)):
            ends = [n for n in range(start + 1, len(words) + 1)
                    if regex.fullmatch("".join(w + " " for w in words[start:n]))]
            got = automaton.end([w.encode() for w in words], start) \
                if words[start] == "a" else None
            assert got == (max(ends) if ends else None)


# --- hard negatives -----------------------------------------------------------------------

def brute_negatives(rows):
    """rows: (id, label, list); ids divisible by 50 are anchors."""
    width = max((len(v) for _, _, v in rows if v), default=0)
    clean = [(i, y, [int(np.floor(256 * float(x))) for x in v] + [0] * (width - len(v)))
             for i, y, v in rows if i is not None and y is not None and v is not None
             and all(x is not None and np.isfinite(x) and abs(x) < 2 ** 20 for x in v)]
    out = []
    for a, label, q in clean:
        if a % 50:
            continue
        scored = sorted(((-sum(x * z for x, z in zip(q, v, strict=True)), i, y) for i, y, v in clean))
        near = [(-s, i) for s, i, y in scored if y == label and i != a][:5]
        for k, (score, i) in enumerate(near):
            far = [(-s, j) for s, j, y in scored
                   if y != label and 50 * score <= -100 * s <= 95 * score][:3]
            out += [(a, i, k + 1, r + 1, j, score, s) for r, (s, j) in enumerate(far)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns(
        {"place": F.lit(1), "id": F.lit("x"), "vector": F.lit(2.0)})


def test_negatives_against_brute_force(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 20))
    rows = [(i, int(y), (centre[y % 4] + rng.normal(size=20) * (0.2 + y % 3)).astype("f4").tolist())
            for i, y in enumerate(rng.integers(0, 7, 500))]
    hot = rows[0][2]
    rows += [(500 + i, 3 + i % 2, hot) for i in range(60)]             # equal vectors: ties
    rows += [rows[10], rows[50], rows[50], (100, 1, hot)]              # repeated rows and ids
    rows += [(None, 1, hot), (601, None, hot), (602, 1, None), (603, 2, [None] * 20),
             (604, 2, [float("nan")] * 20), (605, 2, [float("inf")] * 20), (650, 2, [1.0, 2.0]),
             (606, 2, []), (607, 1, [0.0] * 20), (700, 99, hot), (608, 2, [1e12] * 20)]
    got = hard_negatives.mine(vectors(spark, rows), F.col("id") % 50 == 0).select(
        "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score",
        "negative_score").collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows)
    assert hard_negatives.mine(vectors(spark, []), F.col("id") % 50 == 0).count() == 0
    assert hard_negatives.mine(vectors(spark, rows[:9]), F.col("id") % 50 == 49).count() == 0


def test_blocks_of_any_size_agree(spark, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    whole = hard_negatives.mine(rows, F.col("id") % 10 == 0).collect()
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 11)
    monkeypatch.setattr(hard_negatives, "PAIRS", 64)
    small = hard_negatives.mine(rows, F.col("id") % 10 == 0).collect()
    assert len(whole) > 500 and sorted(whole) == sorted(small)


@pytest.mark.parametrize("width", [1, 3, 64, 100])
def test_intervals_hold_every_score(width):
    rng = np.random.default_rng(width)
    rows = rng.integers(-300, 300, (400, width))
    rows[0], rows[1] = 0, rows[2]
    anchors = np.concatenate((rows[:20], rng.integers(-5, 2 ** 27, (5, width))))
    exact = anchors.astype(object) @ rows.T.astype(object)
    codes = hard_negatives.Codes.made(rows, rng.integers(0, 9, 400) if width > 3 else None)
    low, high = hard_negatives.Planes(anchors).intervals(codes)
    assert (low <= exact.astype(float)).all() and (exact.astype(float) <= high).all()


def test_intervals_leave_far_rows_out():
    """In clustered vectors most rows need no exact score."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(20, 64)) * 200
    group = rng.integers(0, 20, 4000)
    rows = np.rint(centre[group] + rng.normal(size=(4000, 64)) * 20).astype(int)
    low, high = hard_negatives.Planes(rows[:50]).intervals(hard_negatives.Codes.made(rows, group))
    kept = high >= hard_negatives.kth_largest(low, 5)[:, None]
    assert kept.mean() < 0.5
    exact = rows[:50] @ rows.T
    for i in range(50):
        assert kept[i, np.argsort(-exact[i], kind="stable")[:5]].all()


def test_sql_of_hard_negatives(spark):
    got = queries.op13_hard_negatives(spark, SMALL)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = connection.execute(queries.ORACLE_SQL["op13_hard_negatives"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
