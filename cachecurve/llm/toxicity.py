"""Toxicity by a counterfactually regularised classifier.

A document is the set of its words and of their first 4, 5 and 6 bytes (stems), in lower case.
A logistic model over the most telling of these features is fitted to labelled documents.
For every labelled sentence that names a group (``IDENTITY_TERMS``), counterfactuals swap
the term for others of its list; the loss adds ``penalty`` times the mean squared change of
the score that a swap makes. A term that merely occurs in toxic sentences so gets no weight
of its own, and neutral mentions of a group are not held against a document.

The fit uses at most ``TRAIN_DOCS`` labelled documents (chosen by a digest of their ids),
on the driver; the bound is a parameter. Scoring covers every text in full and needs a
dictionary of at most ``MAX_FEATURES`` weights.

Results: every row has a score from 0 to 1; a null, empty or wordless text has the score
of a document without any feature. Repeated rows are scored alike. Where no label of
either class is given, all documents score 0. Ids that are labelled more than once count
as toxic if any label says so; labels that are null are not used. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.scratch import save

#: Bound of the training sample, and of the features that the model keeps.
TRAIN_DOCS = 10_000
MAX_FEATURES = 4_000
#: Log-likelihood ratio below which a feature may be chance.
LEAST_GAIN = 8.0
#: Features of a sample too small for any to pass.
FEW_FEATURES = 40
STEMS = (4, 5, 6)
#: Group terms that stand for one another, by language; a parameter, not a finding.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"), ("woman", "man"), ("gay", "straight", "lesbian", "transgender"),
    ("black", "white", "asian", "latino"), ("immigrant", "native"), ("young", "old"),
    ("christen", "muslime", "juden"), ("frauen", "männer"), ("chrétiens", "musulmans", "juifs"),
    ("femmes", "hommes"), ("cristianos", "musulmanes", "judíos"), ("mujeres", "hombres"))
_SPLIT = re.compile(rb"[.!?\n]+")
#: Lower-cases nothing; turns ASCII signs other than letters into blanks.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode().translate(_LETTERS).split()


def word_features(word: bytes) -> list[bytes]:
    """The word and its stems; a stem ends with a sign that no word has."""
    return [word, *(word[:n] + b"-" for n in STEMS if len(word) >= n)]


def features(found: set[bytes]) -> set[bytes]:
    return {f for word in found for f in word_features(word)}


def swaps(text: str, groups: tuple[tuple[str, ...], ...]) -> list[tuple[bytes, bytes, set[bytes]]]:
    """For each sentence with a group term: the term, its replacement, the sentence's words."""
    near = {term.encode(): [t.encode() for t in group if t != term]
            for group in groups for term in group}
    out = []
    for sentence in _SPLIT.split(text.lower().encode()):
        own = set(sentence.translate(_LETTERS).split())
        out += [(term, other, own) for term in sorted(own & near.keys()) for other in near[term]]
    return out


def logistic(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def score(self, found: set[bytes]) -> float:
        z = self.bias + sum(self.weights.get(f, 0.0) for f in features(found))
        return logistic(z)


def select_features(found: DataFrame, least: float = LEAST_GAIN) -> list[bytes]:
    """Features of two or more of the documents (``label words``), the most telling first.

    Among many rare words some are only in toxic documents by chance; ``least``, a
    log-likelihood ratio, keeps them out.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names = sorted(features(set(own.split())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array([label] * len(names), pa.int32())],
                    ["feature", "label"])

    bad, good = found.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    counts = found.select("label", "words").mapInArrow(listed, "feature binary, label int") \
        .groupBy("feature").agg(F.sum("label").alias("bad"), F.count("*").alias("all")).where("all > 1")
    share = F.col("all") / float(bad + good)

    def part(n: Column, total: int) -> Column:
        rate = (n + 0.5) / float(total + 1)
        return n * F.log(rate / share) \
            + (float(total) - n) * F.log((1 - rate) / F.greatest(1 - share, F.lit(1e-9)))

    gain = part(F.col("bad"), bad) + part(F.col("all") - F.col("bad"), good)
    ranked = counts.select("feature", gain.alias("gain")) \
        .orderBy(F.desc("gain"), "feature").limit(MAX_FEATURES).collect()
    telling = [bytes(r.feature) for r in ranked if r.gain >= least]
    return telling or [bytes(r.feature) for r in ranked[:FEW_FEATURES]]


def fit(own: list[np.ndarray], labels: np.ndarray, chosen: list[bytes],
        changed: list[tuple[bytes, bytes]], penalty: float = 10.0, ridge: float = 2e-4,
        rounds: int = 400) -> Model:
    """Weights by gradient steps (Adam) on logistic loss, ridge and the swap penalty.

    ``own`` has the places in ``chosen`` of each document's features, ``changed`` the (term,
    replacement) of every swap. A swap takes all features of one word from a sentence and adds
    all of another, so the change of its logit is the difference of the sums of their weights.
    """
    place = {f: i for i, f in enumerate(chosen)}
    rows = np.repeat(np.arange(len(own)), [len(x) for x in own])
    columns = np.concatenate([np.empty(0, np.int64), *own]).astype(np.int64)
    distinct = sorted(Counter(changed).items())
    times = np.array([n for _, n in distinct], np.float64)
    # one sparse row a distinct swap: -1 for a feature that goes, 1 for one that comes
    signs = [(swap, place[f], sign) for swap, (pair, _) in enumerate(distinct)
             for word, sign in zip(pair, (-1, 1)) for f in word_features(word)]
    swap, touched, sign = np.array(signs, np.int64).reshape(-1, 3).T
    times = times / max(1, times.sum())
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    weight, bias = np.zeros(len(chosen)), 0.0
    mean, square = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(rows, weight[columns], len(own))
        off = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(own)
        grad = np.bincount(columns, off[rows], len(chosen)) + 2 * ridge * weight
        change = 2 * penalty * times * np.bincount(swap, sign * weight[touched], len(times))
        grad += np.bincount(touched, sign * change[swap], len(chosen))
        grad = np.append(grad, off.sum())
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad ** 2
        move = 0.1 * mean / (1 - 0.9 ** step) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-10)
        weight, bias = weight - move[:-1], bias - move[-1]
    return Model({f: float(w) for f, w in zip(chosen, weight) if abs(w) > 1e-3}, float(bias))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column,
                  most: int) -> DataFrame:
    """``text label`` of about ``most`` labelled documents at most, by a digest of the id."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                          F.col(label).cast("int").alias("label")) \
        .where(F.col("label").isin(0, 1) & learn).groupBy("doc_id").agg(F.max("label").alias("label"))
    apart = max(1, -(-known.count() // most))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(apart)) == 0)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id")


def train(docs: DataFrame, labels: DataFrame, learn: Column, most: int = TRAIN_DOCS,
          groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, penalty: float = 10.0) -> Model:
    """Fit to the labelled documents whose ``doc_id`` meets ``learn``."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [set(words(t)) for t in texts]
            # near copies would make each other's words telling; they share their least digests
            keys = [" ".join(map(str, sorted(map(zlib.crc32, own))[:3])) for own in found]
            changed = [b" ".join(b"|".join(s[:2]) for s in swaps(t, groups)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys),
                 pa.array([b" ".join(sorted(own)) for own in found], pa.binary()),
                 pa.array(changed, pa.binary())], ["doc_id", "label", "key", "words", "swaps"])

    rows = training_rows(docs, labels, "toxic", learn, most).mapInArrow(
        gather, "doc_id bigint, label int, key string, words binary, swaps binary")
    rows = save(rows.groupBy("label", "key").agg(
        F.min_by(F.struct("doc_id", "words", "swaps"), "doc_id").alias("row"))
        .select("label", "row.doc_id", "row.words", "row.swaps"), "labelled")
    if rows.select("label").distinct().count() < 2:
        return Model({}, -np.inf)
    changed = [tuple(pair.split(b"|")) for row in rows.where("swaps <> ''").select("swaps").collect()
               for pair in bytes(row.swaps).split()]
    terms = sorted({f for pair in changed for word in pair for f in word_features(word)})
    chosen = list(dict.fromkeys([*select_features(rows), *terms]))
    place = {f: i for i, f in enumerate(chosen)}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(place[f] for f in features(set(w.split())) if f in place)
                   for w in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int32()))],
                ["doc_id", "label", "own"])

    fitted = rows.select("doc_id", "label", "words") \
        .mapInArrow(placed, "doc_id bigint, label int, own array<int>").toArrow().sort_by("doc_id")
    own = [np.array(x, np.int64) for x in fitted["own"].to_pylist()]
    return fit(own, fitted["label"].to_numpy(), chosen, changed, penalty)


class Scorer:
    """Sums of weights by word, remembered for words that come again."""

    def __init__(self, model: Model, most: int = 500_000):
        self.model, self.most = model, most
        self.known: dict[bytes, tuple[bytes, ...]] = {}

    def __call__(self, text: str) -> float:
        known, weights = self.known, self.model.weights
        if len(known) > self.most:
            known.clear()
        hit: set[bytes] = set()
        for word in set(words(text)):
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(f for f in word_features(word) if f in weights)
            if own:
                hit.update(own)
        z = self.model.bias + sum(sorted(weights[f] for f in hit))
        return logistic(z)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id score predicted`` of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer(t.as_py()) for t in batch.column(1)]  # one text at a time
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(scored, "doc_id bigint, score double") \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
