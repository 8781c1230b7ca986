"""Quality by pairwise ranking (Bradley-Terry).

A document is a short vector of how it is written: shares of capitals, digits, signs and
blanks, how often words and word pairs repeat, lengths. From labelled documents pairs of a
good and a bad one are drawn; the model gives each document the score ``w . x`` and says that
the good one wins with probability ``sigmoid(w . (x_good - x_bad))``. The weights minimise the logistic loss
of all pairs plus a ridge. A document's place is then judged against a quantile of the training scores: the one
below which lies the share of documents labelled bad. Scores are shifted so that this
quantile has the probability ``cut``, so ``score >= cut`` is the threshold by quantile.

The fit uses at most ``TRAIN_DOCS`` labelled documents (by a digest of their ids) and ``PAIRS`` pairs,
on the driver; both are parameters. Scoring covers every text in full.

Results: every row has a score from 0 to 1; null is scored as the empty text. Repeated rows score alike. With no
labels of one class every document scores 1. An empty table gives an empty result; labels
that are null are not used, and an id labelled twice has the higher label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.llm.toxicity import training_rows

TRAIN_DOCS = 20_000
PAIRS = 60_000
N_FEATURES = 18
_BLANK, _UPPER, _LOWER, _DIGIT, _HIGH, _POINT = range(1, 7)
_KINDS = np.zeros(256, np.uint8)
_KINDS[[0x20, *range(0x09, 0x0E)]] = _BLANK
_KINDS[0x41:0x5B], _KINDS[0x61:0x7B], _KINDS[0x30:0x3A] = _UPPER, _LOWER, _DIGIT
_KINDS[0x80:] = _HIGH
_KINDS[[ord(c) for c in ".,;:'\"-"]] = _POINT


def describe(text: str) -> list[float]:
    """The features of a text; each moves little once it is far from usual."""
    raw = text.encode()
    size = max(len(raw), 1)
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=7)
    words = raw.split()
    n = max(len(words), 1)
    distinct = len(set(words)) / n
    pairs = list(zip(words, words[1:]))
    new_pairs = len(set(pairs)) / max(len(pairs), 1)
    stays = sum(a == b for a, b in pairs) / n
    odd = kinds[0] / n  # signs that prose has few of
    upper = kinds[_UPPER] / max(kinds[_UPPER] + kinds[_LOWER], 1)
    lines = raw.count(b"\n") / n
    return [upper, min(upper, 0.1), kinds[_DIGIT] / size, kinds[_BLANK] / size,
            min(odd, 2.0), min(odd, 0.1), kinds[_POINT] / n, kinds[_HIGH] / size,
            distinct, min(distinct, 0.5), new_pairs, min(new_pairs, 0.7), stays, min(stays, 0.1),
            min(size / n, 20.0), lines, np.log1p(n), float(n < 5)]


@dataclass
class Ranking:
    weights: np.ndarray
    middle: np.ndarray
    spread: np.ndarray
    shift: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.spread, -6, 6) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) + self.shift, -500, 500)))


def fit(x: np.ndarray, labels: np.ndarray, cut: float, pairs: int = PAIRS, ridge: float = 1e-3,
        rounds: int = 300, seed: int = 9) -> Ranking:
    """Bradley-Terry weights from pairs of a good and a bad document (Adam)."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(N_FEATURES), np.zeros(N_FEATURES), np.ones(N_FEATURES), np.inf)
    middle = np.median(x, axis=0)
    spread = np.maximum(x.std(axis=0), 1e-6)
    scaled = np.clip((x - middle) / spread, -6, 6)
    draw = np.random.default_rng(seed)
    pairs = min(pairs, 20 * len(x))
    ahead = scaled[draw.choice(good, pairs)] - scaled[draw.choice(bad, pairs)]
    weight = np.zeros(x.shape[1])
    mean, square = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, rounds + 1):
        lost = 1 / (1 + np.exp(np.clip(ahead @ weight, -30, 30)))
        grad = -(lost @ ahead) / pairs + 2 * ridge * weight
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad ** 2
        weight = weight - 0.05 * mean / (1 - 0.9 ** step) \
            / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-10)
    found = Ranking(weight, middle, spread, 0.0)
    threshold = float(np.quantile(found.logits(x), len(bad) / len(x)))
    found.shift = float(np.log(cut / (1 - cut)) - threshold)
    return found


def train(docs: DataFrame, labels: DataFrame, learn: Column, cut: float = 0.3,
          most: int = TRAIN_DOCS) -> Ranking:
    """Fit to the labelled documents whose ``doc_id`` meets ``learn``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [describe(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))],
                ["doc_id", "label", "x"])

    rows = training_rows(docs, labels, "quality", learn, most) \
        .mapInArrow(gather, "doc_id bigint, label int, x array<double>").toArrow().sort_by("doc_id")
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, N_FEATURES)
    return fit(x, rows["label"].to_numpy(), cut)


def score_quality(docs: DataFrame, ranking: Ranking, cut: float = 0.3) -> DataFrame:
    """``doc_id score predicted`` of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([describe(t) for t in batch.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ranking.scores(x.reshape(-1, N_FEATURES)), pa.float64())],
                ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(scored, "doc_id bigint, score double") \
        .withColumn("predicted", (F.col("score") >= cut).cast("int"))
