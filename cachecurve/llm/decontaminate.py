"""Benchmark decontamination by containment, in DataFrame expressions only.

A benchmark item leaks into a document when at least ``share`` of the item's distinct
five-word shingles are shingles of the document. Words are runs of letters and digits in
lower case; an item of fewer words is one shingle of all of them and is looked for with that
many words.

Search: the items are partitioned by size (powers of two of their shingle count). The
MinHash sketch of an item is its shingles of smallest hash, as many as an item of its partition's
largest size can miss, plus one. A document that contains the item must hold at least one of
them, whatever its own length, so the search loses nothing. The sketches are the index that
the shingles of all documents are looked up in. Candidates are then verified by the exact containment
of shingle texts.

Only benchmark sketches are ever small enough to broadcast, and Spark decides that by their
size. A document that leaks, or an item that leaks everywhere, adds one row a pair.

Results: null, empty and wordless texts neither leak nor are leaked into. Items and
documents with the same id count as one each if any row of the id qualifies (the highest share is given). An
empty table on either side gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.scratch import save

SHINGLE_WORDS = 5
SHARE = 0.8


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def shingles(words: Column, gram: Column | int, make) -> Column:
    """``make`` of every run of ``gram`` words."""
    gram = F.lit(gram) if isinstance(gram, int) else gram
    last = F.size(words) - gram + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                       lambda i: make(F.slice(words, i, gram)))
    return F.when(last >= 1, runs)


def texts(run: Column) -> Column:
    return F.array_join(run, " ")


def item_sketches(items: DataFrame, share: float = SHARE) -> DataFrame:
    """``item_id gram shingles size_class sketch`` of every item with words."""
    rows = items.select(F.col("item_id").alias("item_id"), words(F.col("text")).alias("words")) \
        .where(F.size("words") > 0)
    rows = rows.withColumn("gram", F.least(F.size("words"), F.lit(SHINGLE_WORDS)))
    rows = rows.select("item_id", "gram", F.array_distinct(
        shingles(F.col("words"), F.col("gram"), texts)).alias("shingles"),
        F.array_distinct(shingles(F.col("words"), F.col("gram"), F.xxhash64)).alias("hashes"))
    rows = rows.withColumn("size_class", F.ceil(F.log2(F.size("shingles"))).cast("int"))
    missed = F.floor(F.pow(F.lit(2), F.col("size_class")) * (1 - share) + 1e-9).cast("int")
    return rows.select("item_id", "gram", "shingles", "size_class",
                       F.slice(F.sort_array("hashes"), F.lit(1), missed + 1).alias("sketch"))


def contained_items(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id item_id n_shared n_item containment`` of every leak."""
    sketches = save(item_sketches(items, share), "item_sketches")
    grams = [row.gram for row in sketches.select("gram").distinct().collect()]  # 1 to 5 at most
    docs = docs.select(F.col("doc_id").alias("doc_id"), words(F.col("text")).alias("words"))
    index = sketches.select("item_id", "gram", F.explode("sketch").alias("hash"))

    hits = None
    for gram in grams:
        looked_up = docs.select("doc_id", F.explode(
            shingles(F.col("words"), gram, F.xxhash64)).alias("hash"))
        found = looked_up.join(index.where(F.col("gram") == gram), "hash").select("doc_id", "item_id")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = docs.join(sketches, F.lit(False)).select("doc_id", "item_id")
    hits = save(hits.distinct(), "candidates")

    wanted = hits.groupBy("doc_id").agg(F.collect_list("item_id").alias("items"))  # items, at most
    pairs = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"])).drop(wanted["doc_id"])
    by_gram = F.map_from_entries(F.array(*[
        F.struct(F.lit(g), F.coalesce(shingles(F.col("words"), g, texts),
                                      F.array().cast("array<string>"))) for g in grams or [1]]))
    pairs = pairs.select("doc_id", by_gram.alias("runs"), F.explode("items").alias("item_id"))
    checked = pairs.join(sketches.select("item_id", "gram", "shingles"), "item_id")
    shared = F.size(F.array_intersect("shingles", F.col("runs")[F.col("gram")])).cast("bigint")
    checked = checked.select("doc_id", "item_id", shared.alias("n_shared"),
                             F.size("shingles").cast("bigint").alias("n_item"))
    checked = checked.where(F.col("n_shared") >= F.col("n_item") * share - 1e-9)
    best = checked.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        (F.col("n_shared") / F.col("n_item")).alias("containment"), "n_shared", "n_item")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_shared", "b.n_item", "b.containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents that no item leaks into, with their columns."""
    leaks = contained_items(docs, items, share).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_leaked"]), "left_anti")
