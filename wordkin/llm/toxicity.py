"""Toxicity by a factorization machine over hashed terms.

``score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)`` over a text's distinct terms, which are hashed to a table of ``2 ** TERM_BITS``.
The pairs let a term that is harmless alone count beside another. ``x_i`` is how much a term tells about the label in the labelled rows, up to
a bound: every term counts, and those that tell no more than chance would count for little, which keeps the many rare terms of the
training rows from being learned by heart. The model has a fixed size; it is fitted on a bounded sample of labelled rows and scores whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordkin.llm.kernels import ship_package, words
from wordkin.storage import pin

#: labelled rows that a model is fitted on at most, those with the smallest hashes of their ids, and the terms they may have together
TRAIN_ROWS, TRAIN_TERMS = 20_000, 8_000_000
TERM_BITS = 18
FACTORS = 4
EPOCHS = 8
BATCH = 256
RATE = 0.1
DECAY = 1e-5
#: a term's evidence (its G statistic) counts in units of this, up to so many
EVIDENCE_UNIT, MOST_EVIDENCE = 20.0, 3.0

_U = np.uint64
#: punctuation around a word that is no part of its term
_STRIP = ".,;:!?\"'()[]{}*$%&#-_"


@dataclass
class FactorizationMachine:
    """Weights and factors with the evidence of their terms multiplied in."""

    bias: float
    weights: np.ndarray  # (2 ** TERM_BITS,)
    factors: np.ndarray  # (2 ** TERM_BITS, FACTORS)

    def score(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` texts; ``terms`` are distinct within each text of ``rows``."""
        return _sigmoid(_raw(self.bias, self.weights[terms], self.factors[terms], rows, n)[0])


def _raw(bias: float, weights: np.ndarray, factors: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The machine's sums before the sigmoid, and the sums of the factors of each text."""
    linear = np.bincount(rows, weights, n)
    sums = np.stack([np.bincount(rows, factors[:, f], n) for f in range(factors.shape[1])], 1)
    squares = np.bincount(rows, (factors * factors).sum(1), n)
    return bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def evidence(n: np.ndarray, k: np.ndarray, rows: int, marked: int) -> np.ndarray:
    """What having a term (``n`` rows, ``k`` of them marked) tells about the mark (``marked`` of ``rows``), in units and bounded."""
    cells = [(k, n, marked), (n - k, n, rows - marked), (marked - k, rows - n, marked), (rows - marked - n + k, rows - n, rows - marked)]
    g = 2 * sum(c * np.log(np.maximum(c, 1e-9) * rows / np.maximum(a * b, 1e-9)) for c, a, b in cells)
    return np.where(n > 0, np.clip(g / EVIDENCE_UNIT, 0, MOST_EVIDENCE), 0)


def fit(rows: np.ndarray, terms: np.ndarray, labels: np.ndarray, told: np.ndarray, seed: int = 7) -> FactorizationMachine:
    """Adagrad on the logistic loss. ``terms`` are the distinct terms of each text, ``rows`` their texts, ascending; ``told`` is the
    evidence of every term."""
    size = len(told)
    rate = float(labels.mean()) if len(labels) else 0.5
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    rng = np.random.default_rng(seed)
    bias, weights, factors = float(np.log(rate / (1 - rate))), np.zeros(size), rng.normal(0, 0.01, (size, FACTORS))
    cuts = np.searchsorted(rows, np.arange(len(labels) + 1))
    texts = [terms[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    sum_w, sum_v, sum_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            picked = order[at:at + BATCH]
            where = np.repeat(np.arange(len(picked)), [len(texts[i]) for i in picked])
            features = np.concatenate([texts[i] for i in picked])
            x = told[features]
            scaled = factors[features] * x[:, None]
            raw, sums = _raw(bias, weights[features] * x, scaled, where, len(picked))
            error = _sigmoid(raw) - labels[picked]
            used, slot = np.unique(features, return_inverse=True)
            # gradients of the features in this batch, per row of the batch
            step = error[where] / len(picked) * x
            grad_w = np.bincount(slot, step, len(used)) + DECAY * weights[used]
            pull = step[:, None] * (sums[where] - scaled)
            grad_v = np.stack([np.bincount(slot, pull[:, f], len(used)) for f in range(FACTORS)], 1) + DECAY * factors[used]
            sum_w[used] += grad_w ** 2
            sum_v[used] += grad_v ** 2
            grad_b = float(error.mean())
            sum_b += grad_b ** 2
            weights[used] -= RATE * grad_w / np.sqrt(sum_w[used])
            factors[used] -= 0.5 * RATE * grad_v / np.sqrt(sum_v[used])
            bias -= RATE * grad_b / np.sqrt(sum_b)
    return FactorizationMachine(bias, (weights * told).astype(np.float32), (factors * told[:, None]).astype(np.float32))


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``words``, with the distinct hashed terms of each row."""
    for first, last, rows, hashes in words(column, strip=_STRIP):
        keys = np.unique((rows.astype(_U) << _U(TERM_BITS)) | (hashes >> _U(64 - TERM_BITS)))
        yield first, last, (keys >> _U(TERM_BITS)).astype(np.int64), (keys & _U((1 << TERM_BITS) - 1)).astype(np.int64)


def _emit_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, rows, terms in _terms(batch.column(0)):
            offsets = np.searchsorted(rows, np.arange(last - first + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(terms.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, *(batch.column(i).slice(first, last - first) for i in (1, 2))], ["terms", "toxic", "rank"])


def is_held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit_toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_terms: int = TRAIN_TERMS) -> FactorizationMachine:
    """A model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``), without the held-out rows.

    Fitted on up to ``train_rows`` labelled rows, and of these, in the order of their hashes, on as many as have ``train_terms`` distinct terms
    together, so that what comes to the driver is bounded: numbers of terms, never texts. What terms tell is counted on
    Spark, over all of the rows. Rows with a null label or id are not used. Without any labelled row the model says 0.5.
    """
    ship_package(docs.sparkSession)
    chosen = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", F.xxhash64("doc_id").alias("rank"))
    sample = pin(sample.mapInArrow(_emit_terms, "terms array<int>, toxic int, rank bigint"), "toxicity-terms")
    counted = sample.select(F.explode("terms").alias("term"), "toxic").groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")).toArrow()
    n, k = np.zeros(1 << TERM_BITS), np.zeros(1 << TERM_BITS)
    for counts, name in ((n, "n"), (k, "k")):
        counts[counted.column("term").to_numpy()] = counted.column(name).to_numpy()
    rows, marked = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    told = evidence(n, k, max(rows, 1), marked)
    sizes = sorted(map(tuple, sample.select("rank", F.size("terms")).collect()))
    fits = np.cumsum([size for _, size in sizes]) <= train_terms
    if len(sizes) and not fits.all():
        # rows of one id stay or go together
        sample = sample.where(F.col("rank") < sizes[int(np.argmin(fits))][0])
    table = sample.select("terms", "toxic").toArrow()
    texts = [np.asarray(x.values) for x in table.column("terms")]
    marks = table.column("toxic").to_numpy().astype(float)
    # the rows come in no fixed order, and the fit depends on it
    order = sorted(range(len(texts)), key=lambda i: (texts[i].tobytes(), marks[i]))
    rows = np.repeat(np.arange(len(texts)), [len(texts[i]) for i in order])
    return fit(rows, np.concatenate([np.empty(0, np.int32), *[texts[i] for i in order]]), marks[order], told)


def score_toxicity(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """``doc_id, score`` of every row of ``docs`` (``doc_id, text``), 0 to 1, higher for toxic.

    The score reads the whole text and nothing else. Null and empty texts score by the model's bias alone.
    """
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.value.score(rows, terms, last - first) for first, last, rows, terms in _terms(batch.column(1))]
            scores = np.concatenate([np.empty(0), *scores])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def rate_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``), by a model fitted on ``labels``.

    Null and empty texts score by the model's bias; very long texts are scored whole. Repeated rows have the same score, and count as often as
    they come in the fit; of several labels of an id the larger counts. Extra columns are not read. An empty table has no rows.
    """
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
