"""Exact duplicates by an extendible-hash index on shared files.

Texts are equal when they are the same without white space. The index has

* a ``directory``: one row a bucket, with the bits of the hash that all its keys share
  (``prefix`` of ``depth`` bits). It starts as one bucket; a bucket with more than
  ``bucket_bytes`` of keys is split, which doubles the directory when the bucket was as deep
  as the directory. The sizes of all possible buckets come from one pass over the
  hashes, so the doublings are one aggregation and no loop over the data. A bucket whose
  keys share all ``MAX_DEPTH`` bits is not split further: its keys form a chain.
* ``entries``: one row a distinct text (``bucket hash chain text_sha256 keep_id group_size``
  and the text), written by owner tasks. Every task owns a range of buckets, reads the keys
  in hash order, and chains keys of equal hash: a key joins the entry whose bytes equal its
  own, or becomes the next entry of the chain.

Before the keys go to their owners, each task combines the copies it has seen, so that a text that
a third of all rows repeat arrives once a task and not once a row. Rows find their entry by
hash and digest; Spark splits that join where one text is hot.

Results: null and blank texts are equal to each other. Of equal texts the longest original
stays (in code points), then the smallest ``doc_id``; a null ``doc_id`` is larger than any. Repeated
rows are copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.scratch import save

#: Bytes of keys that a bucket holds before it is split.
BUCKET_BYTES = 8 << 20
MAX_DEPTH = 24
#: Characters of keys that a task combines before it passes them on.
COMBINE_CHARS = 32 << 20

ENTRY = ("hash bigint, text string, best_chars bigint, best_id bigint, copies bigint")


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", "")


def build_directory(keys: DataFrame, bucket_bytes: int) -> DataFrame:
    """``prefix depth bytes`` of every bucket, from ``hash bytes`` of the distinct keys.

    A bucket of depth d stands if its parent was overfull and it is not, or cannot be split.
    """
    slots = keys.groupBy(F.shiftrightunsigned("hash", 64 - MAX_DEPTH).alias("slot")) \
        .agg(F.sum("bytes").alias("bytes"))
    depths = F.sequence(F.lit(0), F.lit(MAX_DEPTH))
    sizes = slots.select("bytes", "slot", F.explode(depths).alias("depth")) \
        .groupBy("depth", F.expr(f"shiftrightunsigned(slot, {MAX_DEPTH} - depth)").alias("prefix")) \
        .agg(F.sum("bytes").alias("bytes"))
    over = sizes.where(F.col("bytes") > bucket_bytes) \
        .select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    below = sizes.withColumn("parent", F.shiftrightunsigned("prefix", 1)) \
        .join(over, ["depth", "parent"], "left_semi").drop("parent")
    below = below.unionByName(sizes.where("depth = 0"))
    return below.where((F.col("bytes") <= bucket_bytes) | (F.col("depth") == MAX_DEPTH)) \
        .select("prefix", "depth", "bytes")


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies among the rows of a task become one row, as far as ``COMBINE_CHARS`` reach."""
    held: dict[str, list] = {}
    chars = 0
    for batch in batches:
        for hashed, text, n_chars, doc_id in zip(*(c.to_pylist() for c in batch.columns)):
            rank = (-n_chars, doc_id is None, doc_id)
            own = held.get(text)
            if own is None:
                held[text] = [hashed, rank, 1]
                chars += len(text)
            else:
                own[2] += 1
                if better(rank, own[1]):
                    own[1] = rank
        if chars > COMBINE_CHARS:
            yield combined(held)
            held, chars = {}, 0
    if held:
        yield combined(held)


def better(one: tuple, other: tuple) -> bool:
    """Whether a row is kept rather than another: more characters, then the smaller id."""
    return one[:2] < other[:2] or (one[:2] == other[:2] and not one[1] and one[2] < other[2])


def combined(held: dict[str, list]) -> pa.RecordBatch:
    rows = held.values()
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array(list(held), pa.string()),
         pa.array([-r[1][0] for r in rows], pa.int64()),
         pa.array([r[1][2] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
        ["hash", "text", "best_chars", "best_id", "copies"])


def own_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of an owner's buckets from keys in hash order; one chain is held at a time."""
    bucket = hashed = None
    chain: list[list] = []
    done: list[tuple] = []

    def close() -> None:
        done.extend((bucket, hashed, i, text, -rank[0], rank[2], copies)
                    for i, (text, rank, copies) in enumerate(chain))

    for batch in batches:
        for at, key, text, n_chars, doc_id, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if key != hashed:
                close()
                bucket, hashed, chain = at, key, []
            rank = (-n_chars, doc_id is None, doc_id)
            for own in chain:
                if own[0] == text:  # same hash: the bytes decide
                    own[2] += copies
                    if better(rank, own[1]):
                        own[1] = rank
                    break
            else:
                chain.append([text, rank, copies])
        if done:
            yield entry_batch(done)
            done.clear()
    close()
    if done:
        yield entry_batch(done)


def entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()] + [pa.int64()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
        ["bucket", "hash", "chain", "text", "best_chars", "keep_id", "group_size"])


def build_index(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """The directory and the entries of ``doc_id text``, written to the shared folder."""
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        squeezed(F.col("text")).alias("text"),
                        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"))
    keyed = keyed.withColumn("hash", F.xxhash64("text"))
    sizes = keyed.groupBy("hash").agg(F.max(F.octet_length("text") + 1).alias("bytes"))
    directory = save(build_directory(sizes, bucket_bytes), "directory")
    depths = [row.depth for row in directory.select("depth").distinct().collect()]

    combined_keys = keyed.select("hash", "text", "n_chars", "doc_id").mapInArrow(combine, ENTRY)
    # a key's bucket: of the depths in use, the one at which its prefix is in the directory
    slots = combined_keys.withColumn("slot", F.shiftrightunsigned("hash", 64 - MAX_DEPTH))
    ranges = directory.select(
        F.expr(f"shiftleft(prefix, {MAX_DEPTH} - depth)").alias("bucket"), "depth")
    deepest = max(depths, default=0)
    pages = ranges.select("bucket", F.explode(F.expr(
        f"sequence(shiftrightunsigned(bucket, {MAX_DEPTH} - {deepest}), "
        f"shiftrightunsigned(bucket, {MAX_DEPTH} - {deepest}) + shiftleft(1L, {deepest} - depth) - 1)"
    )).alias("page"))
    placed = slots.withColumn("page", F.expr(f"shiftrightunsigned(slot, {MAX_DEPTH} - {deepest})")) \
        .join(pages, "page")
    owners = placed.select("bucket", "hash", "text", "best_chars", "best_id", "copies") \
        .repartition("bucket").sortWithinPartitions("bucket", "hash")
    entries = owners.mapInArrow(
        own_entries, "bucket bigint, hash bigint, chain bigint, text string, best_chars bigint, "
                     "keep_id bigint, group_size bigint")
    entries = save(entries.withColumn("text_sha256", F.sha2("text", 256)), "entries")
    return directory, entries


def exact_groups(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id keep_id group_size kept text_sha256`` of every row. Rows that repeat the id
    and the length of the row that stays are marked as it is."""
    _, entries = build_index(docs, bucket_bytes)
    entries = entries.select("hash", "text_sha256", "keep_id", "best_chars", "group_size")
    text = squeezed(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("hash"),
                       F.sha2(text, 256).alias("text_sha256"),
                       F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"))
    joined = rows.join(entries, ["hash", "text_sha256"])
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("best_chars"))
    return joined.select("doc_id", "keep_id", "group_size", best.alias("kept"), "text_sha256")
