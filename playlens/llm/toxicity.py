"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: words in lower case and, so that inflected and compound forms of an
insult meet, their first four, five and six letters. The score is the logistic function of

    bias + sum of the weights of the terms + sum over pairs of terms of <v_i, v_j>

so a pair such as an insult beside the name of a group can count more than its parts; the pair sum
takes time linear in the number of terms.

Every term with at least `SUPPORT` training rows takes part, with a weight and factors of its own, so
that a pair of terms that say nothing alone can still tell. Terms that say something alone enter with
their log odds as value and so learn faster; all others with the small value `PLAIN`.

The model is fitted on at most `SAMPLE_ROWS` labelled ids, the first by a hash of the id, and of these
as many as have `SAMPLE_BYTES` of terms together; of an id with several texts the one with the
smallest terms is taken, and of near copies with one label (Jaccard 0.8 or more among those that agree
in their `COPY_TERMS` smallest mixed terms) one row. These are the only bounded steps. Every document
is scored, over its whole text.

Edge cases
    null, empty text   no terms: the score of the bias
    repeated rows      scored alike, learned from once
    very long text     one set of terms, at most 2^19 numbers
    null label or id   not learned from, still scored
    label conflicts    a document with several labels is toxic if one of them says so
    no labels at all   every score is 0
    one label only     scores follow the smoothed share of toxic labels
    other columns      ignored; `reject` returns them untouched
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import REMEMBERED_WORDS, bounded, fetched, mix, stored

DIMENSIONS = 1 << 19
FACTORS = 4
STEMS = (4, 5, 6)
SAMPLE_ROWS = 12_000
SAMPLE_BYTES = 64_000_000
FOLDS = 5
SUPPORT = 30  # training rows a term needs unless it is telling alone
SIGNIFICANT = 3.3  # root of the likelihood ratio from which a term enters with its log odds
PLAIN = 0.3  # value of all other terms
COPY_TERMS, COPY_SHARE = 4, 0.8
EPOCHS, BATCH, RATE, DECAY, START = 8, 256, 0.05, 0.01, 0.2
SLICE_TERMS = 1 << 16  # terms that are scored together; a larger text comes alone

WORD = re.compile(r"\w+")


class TermIds(dict):
    """Remembers the hashed terms of each word."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED_WORDS // 2:
            self.clear()
        terms = [word] + [f"{n}:{word[:n]}" for n in STEMS if len(word) >= n]
        value = tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) % DIMENSIONS for t in terms)
        self[word] = value
        return value


_TERMS = TermIds()


def terms_of(text: str | None) -> np.ndarray:
    """Sorted distinct hashed terms of a text."""
    words = set(WORD.findall(text.lower())) if text else ()
    found = set(chain.from_iterable(map(_TERMS.__getitem__, words)))
    return np.sort(np.fromiter(found, np.int32, len(found)))


@dataclass
class Model:
    """Bias, weights and factors by hashed term; 10 MB whatever the corpus."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -30, 30)))

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias, np.float64)
        filled = np.flatnonzero([len(r) for r in rows])
        if len(filled):
            ids = np.concatenate([rows[i] for i in filled])
            starts = np.cumsum([0, *(len(rows[i]) for i in filled[:-1])])
            out[filled] += pair_scores(self.weights[ids], self.factors[ids], starts)[0]
        return out


def pair_scores(weights: np.ndarray, factors: np.ndarray, starts: np.ndarray) -> tuple:
    """Linear and pairwise score of each row (terms from starts[i] on), and its factor sums."""
    sums = np.add.reduceat(factors, starts, axis=0)
    squares = np.add.reduceat((factors * factors).sum(axis=1), starts)
    linear = np.add.reduceat(weights, starts)
    return linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def row_counts(rows: list[np.ndarray]) -> np.ndarray:
    """The number of rows with each term, added up over some rows at a time."""
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(rows), BATCH):
        counts += np.bincount(np.concatenate(rows[at:at + BATCH]), minlength=DIMENSIONS)
    return counts


def association(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log odds of every term between toxic and other rows; 0 where chance explains them.

    Significance is the signed root of the likelihood ratio of the term's two rates.
    """
    toxic = labels > 0
    sizes = np.array([toxic.sum(), (~toxic).sum()], float)
    counts = np.stack([row_counts([r for r, t in zip(rows, toxic, strict=True) if t == side])
                       for side in (True, False)]).astype(float)
    expected = counts.sum(axis=0) * (sizes / sizes.sum())[:, None]
    parts = counts * np.log(np.maximum(counts, 1e-9) / np.maximum(expected, 1e-9))
    root = np.sqrt(2 * np.maximum(parts.sum(axis=0), 0))
    odds = np.log((counts[0] + 0.5) / (sizes[0] + 1)) - np.log((counts[1] + 0.5) / (sizes[1] + 1))
    return np.where(root >= SIGNIFICANT, odds, 0.0)


def distinct(rows: list[np.ndarray], labels: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """One row of each group of near copies with one label; copies of one text would make its plain
    words look telling."""
    seen: dict[tuple, list[int]] = {}
    chosen = []
    for i, row in enumerate(rows):
        lowest = np.sort(mix(row.astype(np.uint64)))[:COPY_TERMS].tobytes()
        like = seen.setdefault((lowest, labels[i]), [])
        if not any(similar(row, rows[j]) for j in like):
            like.append(i)
            chosen.append(i)
    return [rows[i] for i in chosen], labels[chosen]


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both >= COPY_SHARE * (len(left) + len(right) - both)


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Adagrad over all terms with support; values are folded into weights and factors at the end."""
    model = Model(-30.0, np.zeros(DIMENSIONS, np.float32),
                  np.zeros((DIMENSIONS, FACTORS), np.float32))
    if not len(rows):
        return model
    rows, labels = distinct(rows, labels)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model.bias = float(np.log(share / (1 - share)))
    if labels.min() == labels.max() or not any(map(len, rows)):
        return model
    odds = association(rows, labels)
    support = row_counts(rows)
    kept = np.flatnonzero((odds != 0) | (support >= SUPPORT))
    dense = np.full(DIMENSIONS, -1, np.int32)
    dense[kept] = np.arange(len(kept))
    telling = odds[kept] != 0
    value = np.where(telling, odds[kept], PLAIN)
    rows = [d[d >= 0] for d in (dense[r] for r in rows)]
    random = np.random.default_rng(seed)
    weights = np.where(telling, START, 0.0)
    factors = random.normal(0, 0.01, (len(kept), FACTORS))
    past_w, past_f = np.full(len(kept), 1.0), np.full((len(kept), FACTORS), 1.0)
    bias, past_b = model.bias, 1.0
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            lengths = np.array([len(rows[i]) for i in batch])
            wrong = np.full(len(batch), bias)
            filled = lengths > 0
            if filled.any():
                terms = np.concatenate([rows[i] for i in batch])
                starts = (np.cumsum(lengths) - lengths)[filled]
                v = factors[terms] * value[terms, None]
                score, sums = pair_scores(weights[terms] * value[terms], v, starts)
                wrong[filled] += score
            wrong = 1 / (1 + np.exp(-np.clip(wrong, -30, 30))) - labels[batch]
            if filled.any():
                of_term = np.repeat(wrong[filled], lengths[filled]) * value[terms]
                pulls = of_term[:, None] * (np.repeat(sums, lengths[filled], axis=0) - v)
                seen, where = np.unique(terms, return_inverse=True)
                grad_w = np.bincount(where, of_term) + DECAY * weights[seen]
                grad_f = np.stack([np.bincount(where, pulls[:, k]) for k in range(FACTORS)], 1)
                grad_f += DECAY * factors[seen]
                past_w[seen] += grad_w * grad_w
                past_f[seen] += grad_f * grad_f
                weights[seen] -= RATE * grad_w / np.sqrt(past_w[seen])
                factors[seen] -= RATE * grad_f / np.sqrt(past_f[seen])
            past_b += wrong.sum() ** 2
            bias -= RATE * wrong.sum() / np.sqrt(past_b)
    model.bias = float(bias)
    model.weights[kept], model.factors[kept] = weights * value, factors * value[:, None]
    return model


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model of a bounded sample of the labelled rows outside the held-out fold."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
                           & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).alias("__label")))
    sample = known.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    # At most `sample_rows` ids are sent to the documents, so no text is shuffled.
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), "__id").select("__id", "text", F.col("__label").cast("double"))
    kind = dict(rows.dtypes)["__id"]

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), pa.array(found, pa.binary()), batch.column("__label")],
                ["id", "terms", "label"])

    # One row per id, so that repeated rows of a document do not reach the driver.
    found = stored(rows.mapInArrow(terms, f"id {kind}, terms binary, label double")
                   .groupBy("id").agg(F.min("terms").alias("terms"), F.max("label").alias("label"))
                   .withColumn("place", F.xxhash64("id")))
    got = sorted(fetched(bounded(found, SAMPLE_BYTES)), key=lambda r: (r["place"], r["id"]))
    return fit([np.frombuffer(r["terms"], np.int32) for r in got],
               (np.array([r["label"] for r in got], float) > 0).astype(float))


def text_scores(texts: pa.Array, model: Model) -> pa.Array:
    """The score of each text. Texts leave Arrow one at a time and their terms are scored in slices of
    SLICE_TERMS, so that a worker's memory does not grow with the rows or terms of a batch."""
    out, rows, size = [], [], 0
    for text in texts:
        terms = terms_of(text.as_py())
        if rows and size + len(terms) > SLICE_TERMS:
            out.append(model.scores(rows))
            rows, size = [], 0
        rows.append(terms)
        size += len(terms)
    if rows:
        out.append(model.scores(rows))
    return pa.array(np.concatenate(out) if out else np.empty(0))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = text_scores(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), got], ["doc_id", "score"])

    return rows.mapInArrow(judge, f"doc_id {kind}, score double")


def reject(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, text_col: str = "text",
           threshold: float = 0.5) -> DataFrame:
    """The documents scored under the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(train(labelled_docs, labels))

    @F.arrow_udf("double")
    def judge(texts: pa.Array) -> pa.Array:
        return text_scores(texts, shared.value)

    return docs.filter(judge(text_col) < threshold)
