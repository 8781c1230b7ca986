"""A training corpus from ``documents``, stage by stage.

``run`` applies STAGES to the documents of a folder: toxic documents go, one document of each group
of near copies stays, documents with benchmark items go, the sources are mixed to their weights,
and the mix is written as token files. Every stage but the last returns the columns of
``documents``; each is written as Parquet to the shared folder and reread as the next one's input,
so a lost executor costs a re-read. The modules of ``cachecurve`` must be importable on the executors.

Stages take rows with any nulls: a null text counts as empty, is not toxic unless an empty text is, has
no near copies, holds no benchmark item, and is not in the mix, as it has no words. Of a
group of near copies the least document id stays; rows that repeat this id all stay,
and null ids stay. Extra columns are carried along. Empty input gives empty output.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cachecurve.llm import toxicity
from cachecurve.llm.decontaminate import drop_contaminated
from cachecurve.llm.jaccard_join import link_classes
from cachecurve.llm.mixing import mix_sources, mixed_documents
from cachecurve.llm.token_files import read_token_files, write_token_files
from cachecurve.scratch import save, scratch_root

#: The end of a document in the token files, and the score from which a document is toxic.
END_ID = 2
TOXIC = 0.7
#: Words of a near-copy shingle and the similarity (per cent) that makes near copies.
GRAM, PERCENT = 5, 80
#: Weights of the sources in the order of their names, repeating, and words of a block.
WEIGHTS, BLOCK_WORDS = (5, 2, 1), 256


def _fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in df.columns:
        name += "_"
    return name


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` is not among ``ids``."""
    other = _fresh(docs, "gone")
    ids = ids.select(F.col("doc_id").alias(other)).distinct()
    return docs.join(ids, F.col("doc_id").cast("bigint") == F.col(other), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from all labels of the folder; documents scored toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, F.lit(True))
    return _without(docs, toxicity.score_toxicity(docs, model, TOXIC).where("predicted = 1"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents the least id stays."""
    classes = save(link_classes(docs, GRAM, PERCENT), "classes")
    return _without(docs, classes.where("doc_id <> component_id"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each document and pass."""
    return mixed_documents(docs, mix_sources(docs, WEIGHTS, block_words=BLOCK_WORDS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what is read back from them for each document."""
    folder = f"{scratch_root(spark)}/cachecurve/{uuid.uuid4().hex}/corpus"
    write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return read_token_files(spark, folder)


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies),
          ("benchmark leaks", drop_leaks), ("source mix", mix), ("token files", tokenize)]
#: The toxicity model is trained, which SQL cannot express; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
