"""Mixing sources to target weights, by fixed-length blocks.

The words of every source are packed, document after document, into blocks of
``block_words``. Output shards hold ``shard_blocks`` slots each. For every shard a
multinomial draw says how many of its slots each source gets; slots that a source draws
beyond its share of all slots go to sources below theirs, so that the totals are the
targets to within half a block. The slots of a source are numbered through all shards;
slot ``j`` takes block ``permutation(j mod blocks)`` of pass ``j div blocks``, where each
pass has its own pseudorandom permutation of the block numbers. Slots and blocks are then
joined by (source, block number).

A third of all rows in one source is no matter: documents are placed in their source's
stream by two sums (over hash buckets of bounded size, then over the buckets), and slots
and blocks are joined by block number. Only tables with one row a source are collected:
a mix names its sources and weights, so they fit the driver by intent.

Results: a null or blank text has no words and is never taken. A null source is a source
of its own and comes last. Repeated rows are placed one after another and each has its own
share. An empty table gives empty results. Reruns agree: every draw depends on the seed,
shard, source and pass alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cachecurve.scratch import save

WORD = r"[^\x20\x09-\x0D]+"
SPACED_WORD = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"
#: Rows of one running sum.
BUCKET_ROWS = 50_000
#: Slots that one task makes.
TASK_SLOTS = 500_000
_MASK = (1 << 64) - 1


@dataclass
class Mix:
    """``sizes``: one row a document (``doc_id source text_hash size source_no start``).
    ``sources``: one row a source (``source_no source source_size target blocks slots``).
    ``placed``: the words each slot takes of a document (``shard slot pass block`` and the
    document's key with ``first`` and ``words``)."""

    sizes: DataFrame
    sources: DataFrame
    placed: DataFrame


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """Words to take of each source: shares by weight, none above ``cap`` times its size.

    In the order of cap to weight, a source is at its cap if the level that remains for it
    and all later ones reaches the cap; the others share what is left by weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # one row a source
    totals = totals.withColumn("source_no", F.row_number().over(by_name) - 1)
    totals = totals.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("source_no") % len(weights) + 1).cast("int")))
    totals = totals.withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole)
             - F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap")) \
        / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    totals = totals.withColumn("level", level)
    capped = F.col("cap") <= F.col("level") * F.col("weight")
    shared = F.max(F.when(~capped, F.col("level"))).over(whole) * F.col("weight")
    return totals.withColumn("target", F.when(capped, F.col("cap")).otherwise(shared))


def block_quota(sources: DataFrame, block_words: int, cap: float) -> DataFrame:
    """``blocks`` of a source and the ``slots`` it gets: whole passes, and of a last pass
    as many blocks as hold the rest."""
    blocks = F.ceil(F.col("source_size") / block_words)
    passes = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.when(F.col("source_size") > 0,
                  F.round((F.col("target") / F.col("source_size") - passes) * blocks)).otherwise(0)
    return sources.withColumn("blocks", blocks).withColumn(
        "slots", F.least(passes * blocks + rest, F.floor(F.lit(float(cap))) * blocks).cast("bigint"))


def place_documents(sizes: DataFrame, rows: int) -> DataFrame:
    """``start`` of each document in the word stream of its source."""
    buckets = max(1, math.ceil(rows / BUCKET_ROWS))
    sizes = sizes.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)))
    inside = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "text_hash", "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    sums = sizes.groupBy("source_no", "bucket").agg(F.sum("size").alias("bucket_size"))
    along = Window.partitionBy("source_no").orderBy("bucket")
    offset = F.sum("bucket_size").over(along.rowsBetween(Window.unboundedPreceding, 0)) \
        - F.col("bucket_size")
    sums = sums.select("source_no", "bucket", offset.alias("offset"))
    return sizes.withColumn("inside", running - F.col("size")) \
        .join(sums, ["source_no", "bucket"]) \
        .withColumn("start", F.col("inside") + F.col("offset")).drop("inside", "offset", "bucket")


def draw_shards(spark, quota: np.ndarray, shard_blocks: int, seed: int) -> DataFrame:
    """``shard source_no first taken``: how many slots of a shard go to a source, and the
    number of the first one along that source."""
    total = int(quota.sum())
    shards = math.ceil(total / shard_blocks)
    chance = quota / max(total, 1)

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                slots = min(shard_blocks, total - shard * shard_blocks)
                drawn = np.random.default_rng([seed, shard]).multinomial(slots, chance)
                found = np.flatnonzero(drawn)
                yield pd.DataFrame({"shard": shard, "source_no": found.astype(np.int32),
                                    "drawn": drawn[found]})

    drawn = save(spark.range(shards).mapInPandas(draw, "shard long, source_no int, drawn long"),
                 "drawn")
    quotas = spark.createDataFrame(
        pd.DataFrame({"source_no": np.arange(len(quota), dtype=np.int32), "slots": quota}),
        "source_no int, slots long")
    along = Window.partitionBy("source_no").orderBy("shard") \
        .rowsBetween(Window.unboundedPreceding, 0)
    kept = drawn.join(quotas, "source_no").withColumn("upto", F.sum("drawn").over(along)) \
        .withColumn("over", F.greatest(F.lit(0), F.least(
            F.col("drawn"), F.col("upto") - F.col("slots")))) \
        .withColumn("taken", F.col("drawn") - F.col("over"))
    kept = save(kept.select("shard", "source_no", "taken", "over"), "kept")

    # slots beyond a source's quota, numbered through the shards, fill what others lack
    have = dict(kept.groupBy("source_no").agg(F.sum("taken")).collect())
    lack = np.array([q - have.get(i, 0) for i, q in enumerate(quota.tolist())], np.int64)
    edges = np.concatenate(([0], np.cumsum(lack)))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)  # a row a shard
    spare = kept.groupBy("shard").agg(F.sum("over").alias("over")).where("over > 0") \
        .withColumn("upto", F.sum("over").over(order))

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, over, upto in frame.itertuples(index=False):
                low, high = np.maximum(edges[:-1], upto - over), np.minimum(edges[1:], upto)
                found = np.flatnonzero(high > low)
                yield pd.DataFrame({"shard": shard, "source_no": found.astype(np.int32),
                                    "taken": (high - low)[found]})

    filled = spare.select("shard", "over", "upto") \
        .mapInPandas(fill, "shard long, source_no int, taken long")
    counts = kept.select("shard", "source_no", "taken").unionByName(filled) \
        .groupBy("shard", "source_no").agg(F.sum("taken").alias("taken")).where("taken > 0")
    return counts.withColumn("first", F.sum("taken").over(along) - F.col("taken"))


def permute(index: np.ndarray, size: int, key: tuple[int, ...]) -> np.ndarray:
    """A pseudorandom permutation of ``range(size)``: a four-round Feistel network over the
    next even power of two, walked until the value is in range."""
    half = max(1, ((max(size - 1, 1)).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    rounds = np.random.default_rng(list(key)).integers(0, _MASK, 4, np.uint64, endpoint=True)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for salt in rounds:
            mixed = (right + salt) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(33)) & low)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (outside := np.flatnonzero(out >= size)).size:
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def slot_blocks(counts: DataFrame, blocks: np.ndarray, seed: int) -> DataFrame:
    """``shard slot source_no pass block`` of every slot."""

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, no, first, taken in frame.itertuples(index=False):
                number = np.arange(first, first + taken)
                turn, inside = np.divmod(number, blocks[no])
                block = np.empty(taken, np.int64)
                for t in np.unique(turn):
                    own = turn == t
                    block[own] = permute(inside[own], int(blocks[no]), (seed, int(no), int(t)))
                yield pd.DataFrame({"shard": shard, "slot": number, "source_no": np.int32(no),
                                    "pass": turn.astype(np.int32), "block": block})

    return counts.select("shard", "source_no", "first", "taken").mapInPandas(
        spread, "shard long, slot long, source_no int, pass int, block long")


def document_blocks(sizes: DataFrame, block_words: int) -> DataFrame:
    """The part of each block that a document fills."""
    pieces = sizes.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block_words),
        F.floor((F.col("start") + F.col("size") - 1) / block_words))))
    first = F.greatest(F.col("start"), F.col("block") * block_words)
    last = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return pieces.select("source_no", "block", "start", "doc_id", "text_hash", "size",
                         (first - F.col("start")).alias("first"), (last - first).alias("words"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3,
                block_words: int = 2048, shard_blocks: int = 4096, seed: int = 20) -> Mix:
    """Mix the documents (``doc_id text source``) to the weights, repeating in the order of
    the source names; no source is taken more than ``cap`` (a whole number) times."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    sizes = save(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("text_hash"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size")), "sizes")
    sources = save(block_quota(source_targets(sizes, weights, cap), block_words, cap), "sources")
    numbers = sources.select("source_no", "blocks", "slots").orderBy("source_no").toPandas()
    sizes = sizes.join(sources.select("source", "source_no"),
                       sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    sizes = save(place_documents(sizes, sizes.count()), "placed_sizes")
    quota = numbers["slots"].to_numpy(np.int64)
    counts = draw_shards(spark, quota, shard_blocks, seed) \
        .repartition(max(1, math.ceil(quota.sum() / TASK_SLOTS)), "shard", "source_no")
    slots = save(slot_blocks(counts, numbers["blocks"].to_numpy(np.int64), seed), "slots")
    placed = slots.join(document_blocks(sizes, block_words), ["source_no", "block"])
    return Mix(sizes, sources, placed)


def taken_words(mix: Mix) -> DataFrame:
    """``doc_id size source_size target taken`` of every document."""
    taken = mix.placed.groupBy("source_no", "start").agg(F.sum("words").alias("taken"))
    sizes = mix.sizes.withColumn("at", F.when(F.col("size") > 0, F.col("start")))
    taken = taken.withColumnRenamed("start", "at")
    return sizes.join(taken, ["source_no", "at"], "left") \
        .join(mix.sources.select("source_no", "source_size", "target"), "source_no") \
        .select("doc_id", "size", "source_size", "target",
                F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix as rows of the documents' columns: a row for each document and pass that
    takes words of it, with those words (and the white space before each) as its text and
    ``n_chars`` of that text. Documents without words are not in the mix."""
    columns = docs.columns
    spans = mix.placed.groupBy("source_no", "start", "doc_id", "text_hash", "size", "pass") \
        .agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("spans"))
    parts = spans.groupBy("doc_id", "text_hash", "start").agg(
        F.sort_array(F.collect_list(F.struct("pass", "spans"))).alias("passes"))
    # repeated rows have equal keys; the n-th row of a key takes the n-th place
    key = Window.partitionBy("key_id", "key_hash")
    parts = parts.select(F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash"),
                         F.row_number().over(Window.partitionBy("doc_id", "text_hash")
                                             .orderBy("start")).alias("key_no"), "passes")
    rows = docs.select(F.struct(*columns).alias("row"),
                       F.col("doc_id").cast("bigint").alias("key_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("key_hash"))
    rows = rows.withColumn("key_no", F.row_number().over(
        key.orderBy(F.xxhash64(*[F.col("row")[c] for c in columns]))))
    joined = rows.join(parts, [rows["key_id"].eqNullSafe(parts["key_id"]),
                               rows["key_hash"] == parts["key_hash"],
                               rows["key_no"] == parts["key_no"]])
    words = F.regexp_extract_all(F.col("row")["text"], F.lit(SPACED_WORD), F.lit(1))
    text = F.array_join(F.flatten(F.transform(
        F.col("part")["spans"],
        lambda s: F.slice(F.col("words"), (s["first"] + 1).cast("int"), s["words"].cast("int")))), "")
    out = joined.select("row", words.alias("words"), F.explode("passes").alias("part")) \
        .select("row", text.alias("text"))
    made = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return out.select(*[made.get(c, F.col("row")[c]).alias(c) for c in columns])
