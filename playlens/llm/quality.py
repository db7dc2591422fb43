"""Quality without labels: heuristic labellers, their accuracies by expectation-maximisation, and a
hashed linear scorer trained on the posterior labels.

Every labeller looks at one property of a text and votes good (1), bad (0) or abstains (-1). Votes
are computed by Spark functions, once per text, and kept beside the id and a 64-bit hash of the
text. Documents with the same votes are counted together, so the corpus reaches the driver as at
most 3^8 = 6,561 patterns with counts. Expectation-maximisation finds each labeller's accuracies and
the share of good documents from those counts, over all documents. The posterior of its pattern is a
document's soft label; a logistic scorer over hashed words and word pairs is fitted to the soft
labels of at most SAMPLE_ROWS documents, the first by a hash of the id, and scores every document.

Edge cases
    null, empty text   no words: votes bad where a labeller needs words, never kept
    repeated rows      scored alike, sampled once; other texts under one id are other documents
    null doc_id        voted on and scored, not sampled
    empty table        empty result
    other columns      ignored
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bounded, materialized, stored, WORD

DIMENSIONS = 1 << 18
SAMPLE_ROWS = 10_000
SAMPLE_BYTES = 64_000_000
EM_STEPS = 200
EPOCHS, BATCH, RATE, DECAY = 4, 256, 0.1, 1e-4
TOKEN = re.compile(r"\w+|[^\w\s]+")

# Frequent short words of the languages at hand (fixed values).
FREQUENT = ("the of and to in is that it for on with as was by this be at or from are "
            "de la le et les des en un une du que dans qui pour sur est par au "
            "der die das und ist von zu den mit ein eine nicht auf für dem "
            "el los las una por con no se del es lo y a").split()


def properties(text: Column) -> dict[str, Column]:
    """What the labellers look at; JVM functions over the whole text."""
    body = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(body), F.lit(1))
    words = F.greatest(F.regexp_count(body, F.lit(WORD)), F.lit(1))
    solid = F.length(F.regexp_replace(body, r"\s+", ""))
    letters = F.length(F.regexp_replace(body, r"\P{L}+", ""))
    marks = F.regexp_count(body, F.lit(r"[^\p{L}\p{N}\s]"))
    lines = F.filter(F.split(body, "\n"), lambda line: F.length(F.trim(line)) > 0)
    frequent = F.size(F.filter(F.split(F.lower(body), r"\P{L}+"),
                               lambda word: word.isin(*FREQUENT)))
    return {
        "words": F.regexp_count(body, F.lit(WORD)).cast("double"),
        "word_length": solid / words,
        "letters": letters / F.greatest(solid, F.lit(1)),
        "marks": marks / words,
        "frequent": frequent / words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "runs": F.regexp_count(body, F.lit(r"([^\w\s])\1\1")) / words,
        "digits": F.regexp_count(body, F.lit(r"\p{Nd}")) / chars,
    }


# Labeller: property, good from, good to, bad below, bad above; between the bounds it abstains.
LABELLERS = {
    "length": ("words", 40, 1e9, 8, 1e12),
    "word_length": ("word_length", 3, 9, 2, 14),
    "letters": ("letters", 0.85, 1.1, 0.65, 2.0),
    "marks": ("marks", 0, 0.5, -1, 1.2),
    "frequent": ("frequent", 0.12, 2, 0.03, 9),
    "lines": ("distinct_lines", 0.9, 1.1, 0.6, 9),
    "runs": ("runs", 0, 0.01, -1, 0.08),
    "digits": ("digits", 0, 0.05, -1, 0.2),
}


def votes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, mark (a hash of the text), votes: one of 1, 0, -1 per labeller."""
    measured = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                           F.struct(*[c.cast("double").alias(name) for name, c in
                                      properties(F.col(text_col)).items()]).alias("p"))
    cast = []
    for name, low, high, worst_low, worst_high in LABELLERS.values():
        value = F.col(f"p.{name}")
        cast.append(F.when(value.between(low, high), 1)
                    .when((value < worst_low) | (value > worst_high), 0).otherwise(-1))
    return measured.select("doc_id", "mark", F.array(*cast).alias("votes"))


@dataclass
class Labellers:
    """Share of good documents; for each labeller the chance of each vote given bad and good."""

    share: float
    chances: np.ndarray  # labellers x classes x votes (bad, good, abstains)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        column = np.where(patterns < 0, 2, patterns)
        logs = np.log(self.chances)
        each = logs[np.arange(patterns.shape[1]), :, column]  # rows x labellers x classes
        total = each.sum(axis=1) + np.log([1 - self.share, self.share])
        total -= total.max(axis=1, keepdims=True)
        likely = np.exp(total)
        return likely[:, 1] / likely.sum(axis=1)

    @property
    def accuracies(self) -> np.ndarray:
        """Chance that a vote cast is right, for bad and good documents."""
        cast = self.chances[:, :, :2]
        right = np.stack([cast[:, 0, 0], cast[:, 1, 1]], axis=1)
        return right / cast.sum(axis=2)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray,
                             steps: int = EM_STEPS) -> Labellers:
    """From the majority vote on, until the share settles; counts are smoothed by one vote."""
    cast = (patterns >= 0).sum(axis=1)
    good = np.where(cast > 0, (patterns == 1).sum(axis=1) / np.maximum(cast, 1), 0.5)
    found = None
    for _ in range(steps):
        weight = np.stack([counts * (1 - good), counts * good])  # classes x patterns
        chances = np.ones((patterns.shape[1], 2, 3))
        for vote, value in enumerate((0, 1, -1)):
            chances[:, :, vote] += (weight @ (patterns == value)).T
        chances /= chances.sum(axis=2, keepdims=True)
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
        before = found.share if found else -1.0
        found = Labellers(float(share), chances)
        good = found.posterior(patterns)
        if abs(before - share) < 1e-9:
            break
    return found


def hashed(text: str | None) -> np.ndarray:
    """Distinct hashed words and neighbouring word pairs of a text."""
    tokens = TOKEN.findall(text.lower()) if text else []
    marks = [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in tokens]
    if not marks:
        return np.empty(0, np.int32)
    single = np.array(marks, np.uint64)
    pairs = (single[:-1] * np.uint64(0x9E3779B1) + single[1:]) >> np.uint64(7)
    return np.unique(np.concatenate([single, pairs]) % np.uint64(DIMENSIONS)).astype(np.int32)


@dataclass
class Scorer:
    bias: float
    weights: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        sums = np.array([self.weights[r].sum() / np.sqrt(len(r)) if len(r) else 0.0
                         for r in rows])
        return 1 / (1 + np.exp(-np.clip(self.bias + sums, -30, 30)))


def fit(rows: list[np.ndarray], soft: np.ndarray, seed: int = 3) -> Scorer:
    """Adagrad on the cross entropy with soft labels."""
    weights, past, bias = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-3), 0.0
    random = np.random.default_rng(seed)
    usable = np.flatnonzero([len(r) for r in rows])
    for _ in range(EPOCHS):
        order = random.permutation(usable)
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            lengths = np.array([len(rows[i]) for i in batch])
            terms = np.concatenate([rows[i] for i in batch])
            scale = np.repeat(1 / np.sqrt(lengths), lengths)
            sums = np.add.reduceat(weights[terms] * scale, np.cumsum(lengths) - lengths)
            wrong = 1 / (1 + np.exp(-np.clip(bias + sums, -30, 30))) - soft[batch]
            grad = np.bincount(terms, np.repeat(wrong, lengths) * scale, DIMENSIONS)
            seen = np.flatnonzero(grad)
            past[seen] += grad[seen] ** 2
            weights[seen] -= RATE * (grad[seen] / np.sqrt(past[seen]) + DECAY * weights[seen])
            bias -= RATE * wrong.mean()
    return Scorer(float(bias), weights.astype(np.float32))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, votes, posterior, score, kept (score of one half or more) of every document."""
    # Labellers look at every text once; what they say is narrow and kept.
    voted = materialized(votes(docs, id_col, text_col))
    # At most 3^8 patterns come to the driver.
    found = voted.groupBy("votes").agg(F.count("*").alias("n")).collect()
    kind = dict(voted.dtypes)["doc_id"]
    if not found:
        return voted.select("doc_id", "votes", F.lit(0.0).alias("posterior"),
                            F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    model = expectation_maximisation(np.array([r["votes"] for r in found]),
                                     np.array([r["n"] for r in found], float))
    # Rows with one id and one text vote alike.
    distinct = voted.groupBy("doc_id", "mark").agg(F.first("votes").alias("votes"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(text_col).alias("mark"))
    chosen = distinct.filter("doc_id IS NOT NULL").orderBy(
        F.xxhash64("doc_id"), "doc_id", "mark").limit(sample_rows)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns = np.array(batch.column("votes").to_pylist(), np.int64).reshape(
                -1, len(LABELLERS))
            terms = [hashed(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(terms, pa.binary()),
                 pa.array(model.posterior(patterns))], ["doc_id", "terms", "soft"])

    # Repeats of a chosen row go before they are collected: sample_rows rows at most, and of these as
    # many as have SAMPLE_BYTES of terms together.
    sample = bounded(stored(texts.join(F.broadcast(chosen), ["doc_id", "mark"]).dropDuplicates(
        ["doc_id", "mark"]).mapInArrow(
        features, f"doc_id {kind}, terms binary, soft double").withColumn(
        "place", F.xxhash64("doc_id", "terms"))), SAMPLE_BYTES).toPandas()
    sample = sample.sort_values(["doc_id", "terms"], kind="stable")
    scorer = fit([np.frombuffer(t, np.int32) for t in sample["terms"]],
                 sample["soft"].to_numpy(float))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [hashed(t) for t in batch.column("text").to_pylist()]
            got = shared.value.scores(rows)
            kept = (got >= 0.5) & np.array([len(r) > 0 for r in rows], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(got), pa.array(kept)],
                ["doc_id", "mark", "score", "kept"])

    scored = texts.mapInArrow(judge, f"doc_id {kind}, mark long, score double, kept boolean")
    # As many patterns as were collected, with their posteriors.
    posteriors = docs.sparkSession.createDataFrame(
        [(r["votes"], float(p)) for r, p in zip(
            found, model.posterior(np.array([r["votes"] for r in found])), strict=True)],
        "votes array<int>, posterior double")
    said = distinct.join(F.broadcast(posteriors), "votes").withColumnsRenamed(
        {"doc_id": "__id", "mark": "__mark"})
    return scored.join(said, F.col("doc_id").eqNullSafe(F.col("__id"))
                       & (F.col("mark") == F.col("__mark"))).select(
        "doc_id", "votes", "posterior", "score", "kept")
