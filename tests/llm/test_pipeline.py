"""The stages of the pipeline, each on its own input, and the run."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import library_ids, prose

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, gone string, score double"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with toxic documents, near copies and a benchmark item, and odd rows."""
    rng = random.Random(11)
    item = prose(rng, 25)
    rows, toxic = [], {}
    base = prose(rng, 120)
    for i in range(160):
        text = prose(rng, 50)
        if i % 8 == 0:
            text += " you vilename fool"
        elif i % 8 == 1:
            text = base + " " + prose(rng, 2)
        elif i == 10:
            text += " " + item + " end"
        toxic[i] = int(i % 8 == 0)
        rows.append((i, text, "en", "src" + str(i % 3), len(text), "a", 0.5))
    rows += [(200, None, None, None, None, None, None), (201, "", "en", "src1", 0, None, None),
             (None, "lone words here", None, "src2", 15, None, None)]
    out = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id bigint, quality int, toxic int") \
        .write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near copies", "benchmark leaks", "source mix", "token files"]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    every = ids(docs)

    clean = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert clean.columns == docs.columns
    assert every - ids(clean) == {i for i in range(160) if i % 8 == 0}

    single = corpus_pipeline.drop_near_copies(spark, docs, folder)
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id is not null").collect()]
    want = {d for d, (_, c) in brute.link_classes(rows, 5, 80).items() if d == c}
    assert ids(single) == want | {None} and single.columns == docs.columns

    assert every - ids(corpus_pipeline.drop_leaks(spark, docs, folder)) == {10}

    mixed = corpus_pipeline.mix(spark, docs, folder)
    assert mixed.columns == docs.columns
    assert mixed.where(F.col("n_chars") != F.length("text")).isEmpty()


def test_run(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    rows = found.orderBy("start").collect()
    assert {10} & {r.doc_id for r in rows} == set()
    assert all(r.doc_id is None or r.doc_id % 8 for r in rows)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    again = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in rows]


def test_run_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_tokens_are_of_the_mix(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = {r.doc_id: r.n_tokens for r in corpus_pipeline.tokenize(spark, docs, folder).collect()}
    assert found == {r.doc_id: len(library_ids(r.text)) + 1 for r in docs.collect()}
