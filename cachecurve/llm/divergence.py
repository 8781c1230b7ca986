"""Which sources of a language differ, and by which terms: ranking by count cells.

Each language keeps the terms that stand in at least ``min_docs`` of its documents. A group is a
(lang, source); it and its language give every kept term a smoothed frequency
``p = 1 + floor(10^9 * (count + 5) / (N + 5 * V))``, N being the count of all kept terms there and V their number.
``term`` rows rank the terms that a group uses more often than its language, by ``p - q``; ``pair`` rows rank the other sources of the language
by the sum of ``|p - q|`` over all kept terms. All arithmetic is on integers and decimals, so results are exact.

Terms of one group that have the same count in the group and in the language have the same value,
so terms are first counted by *cell* (group count, lang count); values are evaluated once a
cell, cells of one value are merged, values are ranked by the terms of greater value (cumulative
multiplicity), and only the values that reach the wanted ranks are expanded into terms, in UTF-8 order.

A pair's sum needs no zero counts spelled out: terms that neither source has are one product, terms that one of them has
come from that source's own cells, and only terms of both are joined, which corrects what the cells
said of them. So the join has one row for two sources that share a term, and cells are as few as distinct counts.

One pass counts terms in each task before anything is shuffled; a group that holds a third of all rows sends a row
a term and task. Top values and terms are limited in every partition before they meet.

Results: null text, lang and source count as empty strings, which are a language and a source of their own. A
group without kept terms has pairs, but no terms. A language with one source has no pairs. Each row is a
document, repeated ids included; ``doc_id`` is not read, and neither are extra columns of any name. An empty table gives an empty
one. A very long text is counted in parts.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachecurve.scratch import save

MIN_DOCS = 30
TOP = 50
SMOOTH = 5
SCALE = 1_000_000_000
#: Terms that a task holds before it sends their counts on, and bytes of a text read at once.
HELD_TERMS = 300_000
PART_BYTES = 1 << 20
#: Letters in lower case; bytes from 128 on stand for themselves and all others part terms.
LETTERS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20
                for b in range(256))


def text_parts(raw: bytes, most: int = PART_BYTES) -> Iterator[bytes]:
    """``raw`` cut at blanks into parts of about ``most`` bytes."""
    start = 0
    while len(raw) - start > most:
        cut = raw.find(b" ", start + most)
        if cut < 0:
            break
        yield raw[start:cut]
        start = cut
    yield raw[start:]


def count_terms(docs: DataFrame, held_terms: int = HELD_TERMS) -> DataFrame:
    """``lang source term n docs`` summed by task; the empty term stands for the group itself."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = defaultdict(Counter)
        docs_of: dict = defaultdict(Counter)

        def sent() -> Iterator[pa.RecordBatch]:
            for group, own in counts.items():
                terms, of = list(own), docs_of[group]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group[0]] * len(terms), pa.string()),
                     pa.array([group[1]] * len(terms), pa.string()),
                     pa.array(terms, pa.binary()), pa.array(own.values(), pa.int64()),
                     pa.array([of[t] for t in terms], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
            counts.clear()
            docs_of.clear()

        held = 0
        for batch in batches:
            for lang, source, raw in zip(*(c.to_pylist() for c in batch.columns)):
                own = counts[lang, source]
                held -= len(own)
                own[b""] += 0
                words: set[bytes] = set()
                for part in text_parts(raw.translate(LETTERS)):
                    terms = part.split()
                    own.update(terms)
                    words.update(terms)
                docs_of[lang, source].update(words)
                held += len(own)
                if held > held_terms:
                    yield from sent()
                    held = 0
        yield from sent()

    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(counted, "lang string, source string, term binary, n bigint, docs bigint")


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang term source n lang_n first`` of the kept terms with a count, saved; ``first`` marks one source of
    each term. Every group has a row with the empty term."""
    sums = count_terms(docs).groupBy("lang", "source", "term") \
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    rows = sums.select("lang", F.col("term").cast("string").alias("term"), "source", "n",
                       F.sum("n").over(of_term).alias("lang_n"),
                       F.sum("docs").over(of_term).alias("lang_docs"),
                       (F.col("source") == F.min("source").over(of_term)).alias("first"))
    rows = rows.where((F.col("lang_docs") >= min_docs) | (F.col("term") == "")).drop("lang_docs")
    return save(rows, "kept_terms")


def frequency(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed frequency of ``count`` of ``total`` over ``terms`` terms, exact at any size."""
    return F.call_function(
        "div", (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"),
        F.nullif((total + terms.cast("bigint") * SMOOTH).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))) + 1


def group_sizes(kept: DataFrame) -> DataFrame:
    """``lang source total terms lang_total zero`` of every group; ``zero`` is the frequency of no count."""
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"),
                                     F.count_if(F.col("first") & (F.col("term") != "")).alias("terms"))
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(langs, "lang")
    zero = frequency(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))
    return save(groups.withColumn("zero", F.coalesce(zero, F.lit(0).cast("bigint"))), "groups")


def term_ranks(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``lang source item value rank`` of the ``top`` terms that each group uses more than its language."""
    cell = ["lang", "source", "n", "lang_n"]
    used = kept.where(F.col("term") != "").select("term", *cell)
    cells = used.groupBy(*cell).agg(F.count("*").alias("size")).join(groups, ["lang", "source"])
    value = frequency(F.col("n"), F.col("total"), F.col("terms")) \
        - frequency(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    cells = save(cells.select(*cell, "size", value.alias("value")).where("value > 0"), "cells")

    values = cells.groupBy("lang", "source", "value").agg(F.sum("size").alias("size"))
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # each value has a term at least, so that later values cannot reach the top
    values = values.withColumn("place", F.row_number().over(down)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("size").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("before", before).where(F.col("before") < top)
    wanted = cells.join(values.select("lang", "source", "value", "before"), ["lang", "source", "value"])

    terms = used.join(wanted.drop("size"), cell)
    within = Window.partitionBy("lang", "source", "value").orderBy("term")
    terms = terms.withColumn("place", F.row_number().over(within)).where(F.col("place") <= top)
    rank = F.col("before") + F.col("place")
    return terms.where(rank <= top).select("lang", "source", F.col("term").alias("item"), "value",
                                           rank.cast("int").alias("rank"))


def pair_ranks(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang source item value rank`` of every other source of each group's language."""
    used = kept.where(F.col("term") != "") \
        .join(groups.select("lang", "source", "total", "terms", "zero"), ["lang", "source"])
    used = used.select("lang", "term", "source", "zero",
                       frequency(F.col("n"), F.col("total"), F.col("terms")).alias("p"))

    def side(name: str, df: DataFrame, *columns: str) -> DataFrame:
        return df.select("lang", *(F.col(c).alias(f"{c}_{name}") for c in columns))

    ids = groups.select("lang", "source", "zero", "terms")
    a, b = side("a", ids, "source", "zero", "terms"), side("b", ids, "source", "zero")
    both = a.join(b, "lang").where(F.col("source_a") != F.col("source_b"))
    apart = F.abs(F.col("zero_a") - F.col("zero_b"))
    neither = both.where("source_a < source_b") \
        .select("lang", "source_a", "source_b", (F.col("terms_a") * apart).alias("value"))

    # the terms of one source, as if the other had none of them: once a distinct frequency
    cells = used.groupBy("lang", "source", "zero", "p").agg(F.count("*").alias("size"))
    one = side("a", cells, "source", "zero", "p", "size").join(b, "lang").where("source_a <> source_b")
    one = one.select("lang", F.least("source_a", "source_b").alias("source_a"),
                     F.greatest("source_a", "source_b").alias("source_b"),
                     (F.col("size_a") * (F.abs(F.col("p_a") - F.col("zero_b")) - apart)).alias("value"))

    shared = used.select("lang", "term", *(F.col(c).alias(f"{c}_a") for c in ("source", "zero", "p"))) \
        .join(used.select("lang", "term", *(F.col(c).alias(f"{c}_b") for c in ("source", "zero", "p"))),
              ["lang", "term"]).where("source_a < source_b")
    shared = shared.select("lang", "source_a", "source_b", (
        F.abs(F.col("p_a") - F.col("p_b")) - F.abs(F.col("p_a") - F.col("zero_b"))
        - F.abs(F.col("zero_a") - F.col("p_b")) + apart).alias("value"))

    pairs = neither.unionByName(one).unionByName(shared).groupBy("lang", "source_a", "source_b") \
        .agg(F.sum("value").alias("value"))
    ends = F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                   F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))
    rows = pairs.select("lang", "value", F.inline(ends)).select("lang", "source", "item", "value")
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(down))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang source part item value rank``: other sources of the language (``pair``) and terms
    (``term``) of every group."""
    kept = kept_counts(docs, min_docs)
    groups = group_sizes(kept)
    parts = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
             for part, rows in (("pair", pair_ranks(kept, groups)), ("term", term_ranks(kept, groups, top)))]
    return parts[0].unionByName(parts[1])
