"""Repeated rows, equal and null ids, very long texts, empty tables; the two models against plain versions."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cachecurve.llm import mixing, quality, repeats, token_files, toxicity
from cachecurve.llm.decontaminate import contained_items, drop_contaminated
from tests.llm import brute
from tests.llm.test_operators import PATH, by_id, frame, library_ids, prose

LABELS = "doc_id bigint, quality int, toxic int"


def labelled(spark, n=160):
    rng = random.Random(12)
    terms = ["women", "men", "young", "old", "muslim"]
    rows = [(i, prose(rng, 30) + f" the {rng.choice(terms)} {'vilename' if i % 4 == 0 else 'neighbours'} here. " + prose(rng, 9))
            for i in range(n)]
    return rows, frame(spark, rows), spark.createDataFrame([(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(n)], LABELS)


# op4

def dense_fit(own, labels, chosen, changed, penalty=10.0, ridge=2e-4, rounds=400):
    """The same steps on full matrices."""
    x = np.zeros((len(own), len(chosen)))
    for i, columns in enumerate(own):
        x[i, columns] = 1
    pairs = sorted(Counter(changed).items())
    swap = np.zeros((len(pairs), len(chosen)))
    for i, ((gone, come), _) in enumerate(pairs):
        for word, sign in ((gone, -1), (come, 1)):
            for feature in toxicity.word_features(word):
                swap[i, chosen.index(feature)] += sign
    times = np.array([n for _, n in pairs], float)
    times /= max(1, times.sum())
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    weight = np.zeros(len(chosen) + 1)
    mean, square = np.zeros_like(weight), np.zeros_like(weight)
    for step in range(1, rounds + 1):
        off = balance * (1 / (1 + np.exp(-np.clip(x @ weight[:-1] + weight[-1], -30, 30))) - labels) / len(own)
        grad = np.append(x.T @ off + 2 * ridge * weight[:-1]
                         + 2 * penalty * swap.T @ (times * (swap @ weight[:-1])), off.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad ** 2
        weight = weight - 0.1 * mean / (1 - 0.9 ** step) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-10)
    return weight


def test_toxicity_fit_equals_full_matrices():
    rng = np.random.default_rng(4)
    changed = [(b"women", b"men")] * 5 + [(b"men", b"women")] * 2 + [(b"young", b"old")] * 3
    words = [b"vile", b"kind", b"women", b"men", b"young", b"old", b"day"]
    chosen = list(dict.fromkeys(f for w in words for f in toxicity.word_features(w)))
    own = [np.flatnonzero(rng.random(len(chosen)) < 0.4) for _ in range(60)]
    labels = (np.array([0 in x for x in own]) ^ (rng.random(60) < 0.1)).astype(int)
    weight = dense_fit(own, labels, chosen, changed)
    model = toxicity.fit(own, labels, chosen, changed)
    assert model.bias == pytest.approx(weight[-1], abs=1e-6)
    for feature, w in zip(chosen, weight):
        assert model.weights.get(feature, 0.0) == pytest.approx(w, abs=2e-3)


def test_toxicity_scores_equal_a_plain_scorer(spark):
    rows, docs, labels = labelled(spark)
    model = toxicity.train(docs, labels, F.lit(True))
    for doc_id, (score,) in by_id(toxicity.score_toxicity(docs, model), "score").items():
        text = rows[doc_id][1]
        found = {f for w in text.lower().split() for f in toxicity.word_features(w.strip(".").encode())}
        z = model.bias + sum(model.weights.get(f, 0.0) for f in found)
        assert score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


# op9

def test_quality_weights_are_the_least_loss():
    """No step in any direction lowers the loss of the same pairs."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, quality.N_FEATURES))
    labels = (x[:, 0] - x[:, 3] + rng.normal(size=80) > 0).astype(int)
    found = quality.fit(x, labels, 0.3, pairs=2000, rounds=3000)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    scaled = np.clip((x - found.middle) / found.spread, -6, 6)
    draw = np.random.default_rng(9)
    n = min(2000, 20 * len(x))
    ahead = scaled[draw.choice(good, n)] - scaled[draw.choice(bad, n)]

    def loss(w):
        return np.logaddexp(0, -ahead @ w).mean() + 1e-3 * w @ w

    least = loss(found.weights)
    for k in range(quality.N_FEATURES):
        for step in (-0.05, 0.05):
            moved = found.weights.copy()
            moved[k] += step
            assert loss(moved) > least
    below = (found.scores(x) < 0.3).mean()  # the quantile of the documents labelled bad
    assert below == pytest.approx(len(bad) / len(x), abs=0.02)


def test_quality_scores_equal_a_plain_scorer(spark):
    rows, docs, labels = labelled(spark)
    ranking = quality.train(docs, labels, F.lit(True))
    for doc_id, (score,) in by_id(quality.score_quality(docs, ranking), "score").items():
        z = ranking.shift
        for value, middle, spread, weight in zip(quality.describe(rows[doc_id][1]), ranking.middle, ranking.spread,
                                                 ranking.weights):
            z += max(-6.0, min(6.0, (value - middle) / spread)) * weight
        assert score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


@pytest.mark.parametrize("train, score", [(toxicity.train, toxicity.score_toxicity), (quality.train, quality.score_quality)])
def test_models_on_empty_repeated_and_long_rows(spark, train, score):
    rows, docs, labels = labelled(spark, 80)
    nothing = frame(spark, [])
    model = train(docs, labels, F.lit(True))
    assert score(nothing, model).count() == 0
    assert score(docs, train(nothing, labels, F.lit(True))).count() == 80
    assert score(docs, train(docs, labels.limit(0), F.lit(True))).count() == 80
    long = "kind words " * 200_000 + "vilename"
    odd = score(frame(spark, [(4, rows[4][1]), (4, rows[4][1]), (None, rows[4][1]), (7, long), (8, None)]), model).collect()
    assert len({r.score for r in odd if r.doc_id in (4, None)}) == 1 and len(odd) == 5
    assert all(0 <= r.score <= 1 for r in odd)


# op3, op7, op8, op10

def test_mix_of_repeated_rows_and_null_ids(spark):
    rng = random.Random(6)
    rows = [(i % 40, prose(rng, 20)) for i in range(120)] + [(1, "same words here")] * 6 + [(None, prose(rng, 9))] * 4
    docs = frame(spark, rows)
    found = mixing.taken_words(mixing.mix_sources(docs, block_words=8, shard_blocks=20)).collect()
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(d), len(t.split())) for d, t in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    sizes: Counter = Counter()
    for r in docs.select("source", F.size(F.split("text", " ")).alias("n")).collect():
        sizes[r.source] += r.n
    goal = brute.targets(dict(sizes), (5, 2, 1), 3)
    assert sum(r.taken for r in found) == pytest.approx(sum(goal.values()), abs=40)


def test_token_files_of_equal_and_null_ids(spark, tmp_path):
    rows = [(5, "b c"), (5, "a"), (5, "a"), (None, "first of all"), (None, None), (2, "x " * 40_000)]
    folder = str(tmp_path / "files")
    token_files.write_token_files(frame(spark, rows), folder, PATH, 2)
    found = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32)
             for r in token_files.read_token_files(spark, folder).orderBy("start").collect()]
    start, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library_ids(t), 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == want
    assert [x.tolist() for x in token_files.read_document(spark, folder, 5)] == \
        [[*library_ids(t), 2] for t in ("a", "a", "b c")]


def test_leaks_of_repeated_and_null_ids_and_long_texts(spark):
    rng = random.Random(3)
    item, other = prose(rng, 20), prose(rng, 12)
    items = spark.createDataFrame([(1, item), (1, item), (2, other), (None, other)], "item_id bigint, text string")
    long = prose(rng, 60_000)
    rows = [(1, "x " + item), (1, "x " + item), (1, "clean"), (None, other), (3, long[:200_000] + " " + item + " " + long[200_000:]), (4, long)]
    docs = frame(spark, rows)
    found = {(r.doc_id, r.item_id) for r in contained_items(docs, items).collect()}
    assert {p for p in found if p[1] is not None} == {(1, 1), (None, 2), (3, 1)}
    kept = [r.doc_id for r in drop_contaminated(docs, items.where("item_id is not null")).collect()]
    assert kept == [4]  # all rows of an id go if one leaks


def test_repeats_in_a_text_above_a_chunk(spark):
    rng = random.Random(2)
    alphabet = [prose(rng, 1) for _ in range(5000)]
    long = " ".join(rng.choices(alphabet, k=260_000))
    assert len(long) > repeats.CHUNK_BYTES
    part = long[700_000:700_200]
    rows = [(1, long), (2, "before " + part + " after"), (3, long[:100]), (4, prose(rng, 50))]
    found = {r.doc_id: r for r in repeats.repeated_spans(frame(spark, rows), 50).collect()}
    assert found[1].spans == [] and found[4].spans == []
    assert bytes(found[1].kept) == long.encode()
    assert [(s.start, s.stop) for s in found[3].spans] == [(0, 100)]
    (span,) = found[2].spans
    assert span.start <= 7 and span.stop >= 207
