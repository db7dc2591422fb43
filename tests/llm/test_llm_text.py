"""Toxicity, quality, PII and HTML extraction."""

import hashlib
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from playlens.llm import common, html_text, pii, quality, toxicity

SMALL = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score string, spans int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)


# --- toxicity -----------------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    rows = [(got[r.doc_id], r.toxic) for r in labels.filter("toxic IS NOT NULL").collect()
            if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = np.mean([(s >= 0.5) == bool(y) for s, y in rows])
    assert right > 0.96
    toxic, clean = [s for s, y in rows if y], [s for s, y in rows if not y]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.9
    assert 0 <= min(got.values()) and max(got.values()) <= 1


def test_pairs_beyond_additive_weights():
    """Two terms, harmless alone, are toxic together: only their interaction tells."""
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        rows.append(np.array(sorted({*rng.integers(100, 130, 3), *([1] if a else []),
                                     *([2] if b else [])}), np.int32))
        labels.append(float(a and b))
    model = toxicity.fit(rows, np.array(labels))
    both, first, second = (model.logits([np.array(x, np.int32)])[0] for x in ([1, 2], [1], [2]))
    assert both - first - second + model.bias > 0.5
    assert both > first and both > second


def neutral_rows(count, seed):
    """Every term occurs as often in toxic as in clean rows; only the pairs (1, 2) and (3, 4) tell."""
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for _ in range(count):
        toxic, side = rng.random() < 0.5, rng.integers(0, 2)
        pair = ({1, 2}, {3, 4})[side] if toxic else ({1, 3}, {2, 4})[side]
        rest = rng.integers(100, 160, int(rng.integers(3, 12))).tolist()
        rows.append(np.array(sorted({*pair, *rest}), np.int32))
        labels.append(float(toxic))
    return rows, np.array(labels)


def test_pairs_of_terms_neutral_alone():
    rows, labels = neutral_rows(8000, 1)
    assert not toxicity.association(rows, labels)[:5].any()
    model = toxicity.fit(rows, labels)
    fresh, truth = neutral_rows(1000, 2)
    assert np.mean((model.scores(fresh) >= 0.5) == (truth > 0)) > 0.95


def test_near_copies_count_once_and_others_stay():
    rng = np.random.default_rng(6)
    base = np.arange(1000, dtype=np.int32)
    lowest = np.sort(toxicity.mix(base.astype(np.uint64)))[:toxicity.COPY_TERMS]
    key = base[np.isin(toxicity.mix(base.astype(np.uint64)), lowest)]
    far = np.unique(np.concatenate((key, rng.choice(base, 100)))).astype(np.int32)
    rows = [base, base[base != 999] if 999 not in key else base, far]
    kept, labels = toxicity.distinct(rows, np.array([1.0, 1.0, 1.0]))
    assert [len(r) for r in kept] == [1000, len(far)] and len(labels) == 2


def test_repeated_rows_are_learned_from_once(spark, monkeypatch):
    texts = [f"word{i} word{i + 1} " + ("insult" if i % 2 else "praise") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    once = frame(spark, list(enumerate(texts)))
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, labels: seen.append(
        [(r.tobytes(), y) for r, y in zip(rows, labels, strict=True)]))
    toxicity.train(once, labels)
    toxicity.train(once.union(once).union(once), labels)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 200)
    toxicity.train(once, labels)
    assert seen[0] == seen[1] and 20 < len(seen[0]) <= 40
    assert seen[2] == seen[0][:len(seen[2])] and sum(len(t) for t, _ in seen[2]) <= 200 and seen[2]


def test_sample_reaches_the_driver_in_pieces(spark, monkeypatch):
    """The sample came as one result, which the driver's JVM held several times over."""
    texts = [" ".join(f"word{n}" for n in range(i, i + 20)) + (" insult" if i % 2 else " praise")
             for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    docs = frame(spark, list(enumerate(texts)))
    seen, at_once = [], []
    monkeypatch.setattr(toxicity, "fit", lambda rows, labels: seen.append(
        [(r.tobytes(), y) for r, y in zip(rows, labels, strict=True)]))
    toxicity.train(docs, labels)
    kind = type(docs)
    plain = kind.toLocalIterator

    def noted(self, *args, **kwargs):
        at_once.extend(r.n for r in self.groupBy(F.spark_partition_id()).agg(
            F.sum(F.length("terms")).alias("n")).collect())
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(kind, "toLocalIterator", noted)
    monkeypatch.setattr(kind, "toPandas", lambda self: pytest.fail("the sample came at once"))
    monkeypatch.setattr(common, "FETCHED_BYTES", 2000, raising=False)
    toxicity.train(docs, labels)
    assert seen[0] == seen[1] and 60 < len(seen[0]) <= 120
    assert sum(at_once) == sum(len(t) for t, _ in seen[0])
    assert len(at_once) >= sum(at_once) // 2000 > 5 and max(at_once) < 4000
    toxicity.train(docs.limit(0), labels)
    assert seen[2] == []


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 0)],
                                   "doc_id long, toxic int")
    docs = frame(spark, [(1, "you scum"), (2, None), (3, ""), (3, "fine words"), (None, "x"),
                         (4, "w " * 30_000)])
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = toxicity.train(docs, labels.limit(0))
    assert all(r.score < 1e-9 for r in toxicity.score(docs, none).collect())
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.reject(docs, docs, labels).columns == docs.columns
    assert toxicity.reject(docs, docs, labels.limit(0)).count() == 6


# --- quality ------------------------------------------------------------------------------

def test_scores_of_a_batch_take_bounded_memory(monkeypatch):
    """Workers of the pipeline held all terms of 10,000 texts and their factors at once."""
    rng = np.random.default_rng(3)
    model = toxicity.Model(-0.5, rng.normal(0, 0.1, toxicity.DIMENSIONS).astype(np.float32),
                           rng.normal(0, 0.1, (toxicity.DIMENSIONS, 4)).astype(np.float32))
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 5000, rng.integers(0, 80)))
             for _ in range(500)] + [None, "", " ".join(f"long{i}" for i in range(3000)), "end"]
    whole = model.scores([toxicity.terms_of(t) for t in texts])
    held = []
    plain = toxicity.Model.logits
    monkeypatch.setattr(toxicity.Model, "logits", lambda self, rows: (
        held.append((len(rows), sum(map(len, rows)))), plain(self, rows))[1])
    monkeypatch.setattr(toxicity, "SLICE_TERMS", 1000)
    got = toxicity.text_scores(pa.array(texts), model)
    assert np.array_equal(got.to_numpy(zero_copy_only=False), whole)
    assert sum(n for n, _ in held) == len(texts)
    assert len(held) > 20 and all(size <= 1000 or n == 1 for n, size in held)
    assert len(toxicity.text_scores(pa.array([], pa.string()), model)) == 0


def test_reject_scores_as_score_does(spark):
    docs = frame(spark, [(i, "you scum " * (i % 2) + f"word{i} fine words") for i in range(60)]
                 + [(60, None), (None, ""), (60, "you scum")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    low = toxicity.score(docs, model).filter("score < 0.5").groupBy("doc_id").count().collect()
    kept = toxicity.reject(docs, docs, labels).groupBy("doc_id").count().collect()
    assert 20 < len(kept) < 62 and sorted(low, key=str) == sorted(kept, key=str)


def test_counts_by_blocks_of_rows():
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 90, rng.integers(0, 30))).astype(np.int32) for _ in range(700)]
    counts = toxicity.row_counts(rows)
    assert len(counts) == toxicity.DIMENSIONS
    assert counts[:90].tolist() == [sum(t in set(r.tolist()) for r in rows) for t in range(90)]


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    votes = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.expectation_maximisation(patterns, counts.astype(float))
    assert abs(model.share - 0.7) < 0.03
    assert np.abs(model.accuracies.mean(axis=1) - right).max() < 0.05


def test_quality_tells_labels_apart(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = quality.score(docs).collect()
    good = [r.score for r in got if labels.get(r.doc_id) == 1]
    bad = [r.score for r in got if labels.get(r.doc_id) == 0]
    assert np.mean([g > b for g in good[:2000] for b in bad]) > 0.85
    assert np.mean([r.kept for r in got if labels.get(r.doc_id) == 1]) > 0.95


def test_expectation_maximisation_against_plain_loops():
    """The same steps row by row, with dictionaries."""
    rng = np.random.default_rng(9)
    rows = [tuple(int(v) for v in rng.integers(-1, 2, 4)) for _ in range(300)]
    patterns, counts = np.unique(np.array(rows), axis=0, return_counts=True)
    model = quality.expectation_maximisation(patterns, counts.astype(float), steps=6)
    good = [sum(v == 1 for v in row) / sum(v >= 0 for v in row) if any(v >= 0 for v in row) else 0.5
            for row in rows]
    share = before = -1.0
    for _ in range(6):
        chance = {(j, c, v): 1.0 + sum((g if c else 1 - g) for row, g in zip(rows, good, strict=True)
                                       if row[j] == v)
                  for j in range(4) for c in (0, 1) for v in (0, 1, -1)}
        total = {(j, c): sum(chance[j, c, v] for v in (0, 1, -1)) for j in range(4) for c in (0, 1)}
        share, before = (sum(good) + 1) / (len(rows) + 2), share
        good = []
        for row in rows:
            odds = [1 - share, share]
            for j, v in enumerate(row):
                odds = [o * chance[j, c, v] / total[j, c] for c, o in enumerate(odds)]
            good.append(odds[1] / sum(odds))
        if abs(before - share) < 1e-9:
            break
    assert model.share == pytest.approx(share)
    assert model.posterior(np.array(rows)) == pytest.approx(good)


def test_quality_sample_is_bounded_in_bytes(spark, monkeypatch):
    seen = []
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, soft: seen.append(
        sum(r.nbytes for r in rows)) or plain(rows, soft))
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 3000)
    docs = frame(spark, [(i, f"the word {i} and the other words of it " * 3 + "x y z " * i)
                         for i in range(60)])
    assert quality.score(docs).count() == 60 and 0 < seen[0] <= 3000


def test_quality_odd_rows(spark):
    docs = frame(spark, [(1, None), (2, ""), (3, "the cat is on the mat " * 9), (3, "###"),
                         (None, "a of the"), (4, "long " * 50_000)])
    got = quality.score(docs).collect()
    assert len(got) == 6
    assert not any(r.kept for r in got if r.doc_id in (1, 2))
    assert quality.score(docs.limit(0)).count() == 0


def test_quality_repeated_ids_and_texts(spark):
    rows = [(1, "the cat sat on the mat and it was warm there " * 5)] * 40
    rows += [(1, f"the text {i} of this id is on its own line " * 6) for i in range(20)]
    rows += [(None, "$$$$ %%%% 1111 !!!!")] * 30 + [(None, None), (2, ""), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality.score(docs, sample_rows=5).collect()
    assert len(got) == len(rows)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in got) == [-1] * 31 + [1] * 60 + [2] * 2
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)



# --- PII ----------------------------------------------------------------------------------

def brute_spans(text):
    found = []
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
                "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    for rank, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip"
                  else True, "card": 12 <= len(digits) <= 19
                  and sum(d // 10 + d % 10 for d in doubled) % 10 == 0,
                  "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


PII_TEXTS = [
    None, "", "mail a@b.com_x@y.org now", "x@y@z.com", "a@b", "1.2.3.4.5.6.7.8 256.1.1.1 010.0.0.255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (555) 010-9999 +49 30 1", "é 😀 me@é.com q@w.de",
    "..@a.b %+-@x-y.z--.q", "12345678901234567890123", "+4111111111111111", "1.1.1.1@2.2.2.2",
    "a.b+c@d.e.f. 9.9.9.9, 0.0.0.0000001", "+1 2.3.4.5 +9999999999", "@@a@b.c@d.e"]


def test_base_spans_against_the_plain_patterns(spark):
    got = {r.doc_id: r for r in pii.digest(pii.find(
        frame(spark, list(enumerate(PII_TEXTS))))).collect()}
    for i, text in enumerate(PII_TEXTS):
        want = brute_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [s for s in got[i].spans.split(",") if s and not s.startswith(("iban", "ssn"))] \
            == want
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(
            sum(s.startswith(k) for s in want) for k in ("email", "ip", "card", "phone"))


def test_added_spans_need_checksum_or_context():
    kinds = lambda t: [s["kind"] for s in pii.spans_of(t)]
    assert "iban" in kinds("pay to GB82 WEST 1234 5698 7654 32 please")
    assert "iban" not in kinds("pay to GB82 WEST 1234 5698 7654 33 please")
    assert kinds("her ssn 123-45-6789") == ["ssn"]
    assert kinds("part no 123-45-6789") == []
    alone, named = pii.spans_of("5500005555555559")[0], pii.spans_of("visa 5500005555555559")[0]
    assert named["score"] > alone["score"]


def test_pii_long_and_repeated(spark):
    text = "a" * 300_000 + " x@y.z " + "1" * 100_000
    got = pii.find(frame(spark, [(1, text), (1, text), (None, text)])).collect()
    assert [[s.kind for s in r.spans] for r in got] == [["email"]] * 3
    assert pii.find(frame(spark, []).limit(0)).count() == 0
    assert pii.redact("me@x.y, ok", pii.spans_of("me@x.y, ok")) == "[EMAIL], ok"
    assert pii.redact(None, []) is None


# --- HTML ---------------------------------------------------------------------------------

@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"),
    ("<div>1 < 2 and <b>bo</b>ld</div>", "1 < 2 and bold"),
    ("<p>a\n  b&nbsp;c<br>d</p>", "a b c d"),
    ("<script>var a='<p>x</p>';</script><!-- <p>no</p> --><p>yes, it is.</p>", "yes, it is."),
    ("<nav><a>Home</a></nav><article><h1>T</h1><p>Body, text. More.</p><aside>ad</aside>"
     "<p>z</p></article><footer>f</footer>", "T\nBody, text. More.\nz"),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_main_text_without_article_tag():
    body = "".join(f"<p>Sentence {i}, with words; and more of them. Then another one.</p>"
                   for i in range(5))
    furniture = "<ul><li><a>One</a></li><li><a>Two</a></li></ul>"
    html = (f"<html><head><title>t</title></head><body><div id='top-nav'>{furniture}</div>"
            f"<div class='wrap'><div class='post'><h2>Head</h2>{body}<ul><li>x<li>y</ul></div>"
            f"<div class='sidebar'>{furniture}<p>Buy, now.</p></div>"
            "<div id='comments'><p>I, a reader, object. Strongly, too.</p></div></div>"
            "<div class='cookie-notice'>We use cookies.</div><form><input>Mail</form></body>")
    lines = html_text.main_text(html).split("\n")
    assert lines[0] == "Head" and lines[-2:] == ["x", "y"] and len(lines) == 8


SENTENCES = "A sentence, with words; and more of them. Then another one. " * 10


@pytest.mark.parametrize("html", [
    f"<div id=post><div id=lead><p>Lead, it is.</div><div id=body><p>{SENTENCES}</div></div>",
    f"<body><article><p>Lead, it is. {SENTENCES}</article><main><p>{SENTENCES * 2}</main></body>",
    *[f"<body><{w}><nav>Home</nav><article><p>Lead, it is. {SENTENCES}</article></{w[:4].strip()}>"
      for w in ("div class='has-sidebar'", "div class='page with-sidebar'", "div class='nav-open'",
                "form action='x'", "div id=comments", "div aria-hidden=true")],
    f"<body><form><div class='nav-open'><p>Lead, it is.<p>{SENTENCES}</div></form><p>x</body>",
    f"<body><form><p>Lead, it is. {SENTENCES}</form><form><p>{SENTENCES}</form></body>",
    f"<body><form><article><p>Lead, it is. {SENTENCES}</article></form><main>{SENTENCES}</main>",
    f"<p>Lead, it is. {SENTENCES}</p>" + "<div>" * 5000 + SENTENCES,
])
def test_main_text_is_whole(html):
    text = html_text.main_text(html)
    written = html.count(SENTENCES.strip())
    assert "Lead, it is." in text and text.count(SENTENCES.strip()) == written
    assert "Home" not in text


def test_furniture_beside_an_article_stays_out():
    page = ("<body><article><p>Body, text. More.</article><div id='comments'><article><p>"
            f"{SENTENCES}</article></div><form><p>{SENTENCES[:15]}</form>")
    assert html_text.main_text(page) == "Body, text. More."


@pytest.mark.parametrize("name", [
    "div class=share-price", "p class='legal-analysis'", "div id=menu-reform",
    "section class='alert-fatigue'", "p class=notice", "div class='related'", "p class='legal menu'"])
def test_names_hide_nothing_of_an_article(name):
    tag = name.split()[0]
    page = f"<body><article><h1>T</h1><p>{SENTENCES}</p><{name}>Kept, it is.</{tag}></article></body>"
    assert html_text.main_text(page).split("\n")[-1] == "Kept, it is."


@pytest.mark.parametrize("part", [
    "<div class='ad'>Buy, now.</div>", "<nav><a>Home</a></nav>", "<aside>By the way.</aside>",
    "<form><input>Mail</form>", "<footer>Printed here.</footer>", "<div role=navigation>x</div>",
    "<div id=comments><p>I, a reader, object.</p></div>", "<div class='box sidebar'>y</div>",
    "<button>Send</button>", "<script>z</script>", "<style>z</style>", "<!-- z -->"])
def test_furniture_within_an_article(part):
    page = f"<body><main><h1>T</h1>{part}<p>Body, text. More.</p>{part}</main></body>"
    assert html_text.main_text(page) == "T\nBody, text. More."


def test_loose_names_without_an_article_follow_the_ratios():
    page = (f"<body><div class='page-menu'><a>One</a> <a>Two</a></div><div class='nav-open'>"
            f"<p>{SENTENCES}</p><p>{SENTENCES}</p></div></body>")
    assert html_text.main_text(page) == "\n".join([SENTENCES.strip()] * 2)


@pytest.mark.parametrize("html", [
    "<b " * 100_000, "<div>" * 100_000, "<b \"x" * 100_000, "<b \"x" * 100_001 + ">", "<!" * 100_000,
    "<p><td>" + "<div>" * 100_000, "<div>" * 50_000 + "</z>" * 50_000, "<p>" * 100_000, "<!--" * 100_000,
    "<li><ul>" * 50_000, "<tr><td>" * 50_000, "<![CDATA[" * 50_000, "<script>" * 50_000, "<" * 100_000,
    "<div class='ad x" + " y" * 100_000 + "'>a", "</p>" * 100_000, "<a><b>" * 50_000 + "</a>" * 50_000])
def test_long_and_deep_pages_take_linear_time(html):
    started = time.process_time()
    html_text.main_text(html + "end, it is.")
    assert time.process_time() - started < 10


def random_page(rng):
    """A page put together from blocks, and the text its article must have, written apart from it."""
    words = ["Fünf", "tests", "a &amp; b", "x&lt;y", "<b>bold</b>", "<a href='#'>lin<i>k</i></a>",
             "caf&eacute;", "end.", "so,", "<span class='share'>kept</span>", "1&nbsp;2", "&#8364;"]
    shown = ["Fünf", "tests", "a & b", "x<y", "bold", "link", "café", "end.", "so,", "kept", "1 2", "€"]

    def run():
        picks = rng.integers(0, len(words), int(rng.integers(1, 25)))
        gap = [" ", "\n", "\t ", "  "][int(rng.integers(0, 4))]
        return gap.join(words[i] for i in picks), " ".join(shown[i] for i in picks)

    html, text = [], []
    for _ in range(int(rng.integers(1, 12))):
        kind = rng.choice(["p", "h2", "li", "quote", "table", "div", "advert", "form", "aside", "script"])
        source, plain = run()
        if kind in ("p", "h2", "div"):
            html.append(f"<{kind} class='x-share legal-y'>{source}</{kind}>")
            text.append(plain)
        elif kind == "li":
            second, more = run()
            html.append(f"<ul><li>{source}<li>{second}</ul>")
            text += [plain, more]
        elif kind == "quote":
            html.append(f"<blockquote><p>{source}</blockquote>")
            text.append(plain)
        elif kind == "table":
            second, more = run()
            html.append(f"<table><tr><td>{source}<td>{second}</table>")
            text += [plain, more]
        else:
            html.append({"advert": f"<div class='ad'>{source}</div>",
                         "form": f"<form><p>{source}<input></form>",
                         "aside": f"<aside><p>{source}</p></aside>",
                         "script": f"<script>var x = '<p>{plain}</p>';</script>"}[kind])
    tag = rng.choice(["article", "main"])
    around = [f"<nav><ul><li>{run()[0]}</ul></nav>", f"<header><h1>{run()[0]}</h1></header>",
              f"<div class='sidebar'><p>{run()[0]}</p></div>", f"<footer>{run()[0]}</footer>",
              f"<div id='comments'><article><p>{run()[0]}</p></article></div>",
              f"<div class='cookie-notice'>{run()[0]}</div>", f"<form>{run()[0]}</form>",
              f"<!-- <article>{run()[0]}</article> -->"]
    rng.shuffle(around)
    cut = int(rng.integers(0, len(around)))
    body = "".join([*around[:cut], f"<{tag}>", *html, f"</{tag}>", *around[cut:]])
    return f"<html><head><title>t</title></head><body>{body}</body></html>", "\n".join(text)


@pytest.mark.parametrize("seed", range(60))
def test_articles_put_together_from_blocks(seed):
    html, text = random_page(np.random.default_rng(seed))
    if text:
        assert html_text.main_text(html) == text


def test_unclosed_markup_is_text():
    assert html_text.main_text("<p>1 <b and 2") == "1 <b and 2"
    assert html_text.main_text("a <!-- b") == "a"
    assert html_text.main_text("<p title='x>y'>z") == "z"


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", 7), (None, None, None, 8), (1, "u",
                                   "<p>a</p>", 9), (2, "v", "<div>" * 5000 + "deep", 1)],
                                  "page_id long, url string, html string, text int")
    got = html_text.extract(pages).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [
        ("1", "a", 1), ("1", "a", 1), ("2", "deep", 4), ("None", "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0
