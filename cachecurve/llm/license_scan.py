"""License notices by diagonal voting.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. *Base* places are
those where the words of a phrase of ``PHRASES`` stand one after another. The method adds labels for
whole notices (``TEMPLATES``), which may differ in up to a tenth of their words:

1. All rolling hashes of ``GRAM`` words of all documents are joined in Spark with those of the templates.
2. Hits vote for their diagonal, the word of the document minus the word of the template. A notice with
   at most ``e`` words changed, lost or added keeps ``T + 1 - GRAM - GRAM * e`` of its grams, on diagonals
   that are at most ``e`` apart, so neighbouring diagonals up to that gap are merged, and merged ones with fewer votes go.
   This loses no notice.
3. Each span left is verified on the words themselves: the least number of edits between the
   template and any run of words in the span (a bit-parallel column a word), at most ``e``.

The hashes of documents meet only the table of the templates, which Spark broadcasts if it is small, so no text is shuffled for
them. For the verification only documents are sent that hold an *anchor*, one of ``e + 1`` long words of a template; a notice
with ``e`` edits keeps one at least. Rows are known by two digests of id and text.

Results: ``score`` is the highest share of a template's words that a verified span agrees with, 1 where a base
place is, else 0. Null and empty texts have no words, empty labels and score 0. Repeated rows
give repeated results; ids may be null or equal. An empty table gives an empty one. Columns other than ``doc_id``
and ``text`` are not read, whatever their names. Long texts are read in parts of ``PART_BYTES``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachecurve.llm.divergence import PART_BYTES, text_parts
from cachecurve.scratch import save

#: Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Well-known notices of public licenses.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files (the Software), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the"
            " GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
            " provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"
            " is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
GRAM = 3
#: Edits that are let pass, per word of a template.
EDITS = 0.1
#: Bytes of texts that are hashed at once.
BUFFER_BYTES = 2 << 20
WORDS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
              else 0x20 for b in range(256))
BASE = 0x9E3779B97F4A7C15

GRAM_SCHEMA = "row_a bigint, row_b bigint, place bigint, hash bigint"
FACT_SCHEMA = ("doc_id bigint, row_a bigint, row_b bigint, n_words bigint, n_base bigint, first_word bigint, "
               "last_word bigint, base_labels string, text binary")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORDS).split()


def edits_of(words: int) -> int:
    return int(words * EDITS + 1e-9)


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    found = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        found.append(np.cumprod(powers))
    return found[0], found[1]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of blank-separated ``raw`` starts, and its hash."""
    codes = np.frombuffer(b" " + raw + b" ", np.uint8)
    edges = np.flatnonzero(np.diff(codes != 0x20)) + 1
    starts, stops = edges[::2], edges[1::2]
    up, down = _powers(1 << max(16, len(codes).bit_length()))
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed * up[:len(codes)], out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * down[starts]
    return starts - 1, hashes ^ (hashes >> np.uint64(31))


def buffers(texts: Iterator[bytes], most: int = BUFFER_BYTES) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """Parts of texts joined by blanks: the bytes, where each part begins and its text's number."""
    parts: list[bytes] = []
    begins: list[int] = []
    owners: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        for part in text_parts(text.translate(WORDS), PART_BYTES):
            parts.append(part)
            begins.append(size)
            owners.append(number)
            size += len(part) + 1
            if size >= most:
                yield b" ".join(parts), begins, owners
                parts, begins, owners, size = [], [], [], 0
    if parts:
        yield b" ".join(parts), begins, owners


def text_grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text number, first word and hash of every run of ``GRAM`` words."""
    owner, place, hashes = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    for raw, begins, owners in buffers(iter(texts)):
        starts, fresh = word_hashes(raw)
        own = np.array(owners, np.int64)[np.searchsorted(begins, starts, "right") - 1]
        if not len(own):
            continue
        first = np.flatnonzero(np.diff(own, prepend=-1))  # of each text's words in this buffer
        at = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
        if len(owner) and owner[-1] == own[0]:
            at[own == own[0]] += place[-1] + 1
        owner, place = np.concatenate((owner, own)), np.concatenate((place, at))
        hashes = np.concatenate((hashes, fresh))
        runs = len(owner) - GRAM + 1
        if runs > 0:
            whole = owner[:runs] == owner[GRAM - 1:]
            mixed = np.zeros(runs, np.uint64)
            for k in range(GRAM):
                mixed = (mixed + hashes[k:k + runs]) * np.uint64(BASE)
                mixed ^= mixed >> np.uint64(32)
            yield owner[:runs][whole], place[:runs][whole], mixed[whole].view(np.int64)
        owner, place, hashes = owner[1 - GRAM:], place[1 - GRAM:], hashes[1 - GRAM:]


def grams(rows: DataFrame) -> DataFrame:
    """A row for every run of ``GRAM`` words of ``row_a row_b text``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_a, row_b = (batch.column(i).to_numpy() for i in (0, 1))
            for owner, place, hashes in text_grams(batch.column(2).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (row_a[owner], row_b[owner], place, hashes)],
                    ["row_a", "row_b", "place", "hash"])

    return rows.mapInArrow(hashed, GRAM_SCHEMA)


def with_row(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id").cast("bigint")
    return docs.select(key.alias("doc_id"), F.xxhash64(key, text).alias("row_a"),
                       F.xxhash64(text, F.lit(1), key).alias("row_b"), text.cast("binary").alias("text"))


def template_index(docs: DataFrame, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """``hash template at size edits``: every gram of the templates, saved."""
    sizes = [len(words_of(text)) for _, text in templates]
    if min(sizes, default=GRAM) < GRAM:
        raise ValueError(f"a template has at least {GRAM} words")
    rows = docs.sparkSession.createDataFrame(
        [(k, size, text.encode()) for k, (size, (_, text)) in enumerate(zip(sizes, templates))],
        "row_a bigint, row_b bigint, text binary")
    found = grams(rows).select("hash", F.col("row_a").cast("int").alias("template"),
                               F.col("place").alias("at"), F.col("row_b").alias("size"))
    return save(found.withColumn("edits", F.floor(F.col("size") * EDITS + 1e-9)), "templates")


def candidate_spans(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``row_a row_b template start stop votes``: merged diagonals with the votes that a notice keeps."""
    index = template_index(docs, templates)
    hits = grams(with_row(docs).select("row_a", "row_b", "text")).join(index, "hash")
    row = ["row_a", "row_b", "template", "size", "edits"]
    lines = hits.groupBy(*row, (F.col("place") - F.col("at")).alias("diagonal")) \
        .agg(F.count_distinct("at").alias("votes"))
    along = Window.partitionBy(*row).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("edits"), F.lit(True))
    lines = lines.withColumn("apart", apart)
    lines = lines.withColumn("span", F.count_if("apart").over(along))
    spans = lines.groupBy(*row, "span").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes"))
    needed = F.col("size") + 1 - GRAM - GRAM * F.col("edits")
    return spans.where(F.col("votes") >= needed).select(
        "row_a", "row_b", "template", F.greatest(F.col("low") - F.col("edits"), F.lit(0)).alias("start"),
        (F.col("high") + F.col("size") + F.col("edits")).alias("stop"), "votes")


def edit_column(pattern: list[bytes], words: list[bytes], free: bool) -> Iterator[int]:
    """Edits between the pattern and the words up to each word: from any word on if ``free``, else
    from the first."""
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    equal: dict[bytes, int] = {}
    for k, word in enumerate(pattern):
        equal[word] = equal.get(word, 0) | 1 << k
    rise, fall, score = full, 0, len(pattern)
    for word in words:
        same = equal.get(word, 0)
        vertical = same | fall
        level = (((same & rise) + rise) ^ rise) | same
        up, down = fall | full & ~(level | rise), rise & level
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1 | (not free)) & full, (down << 1) & full
        rise, fall = down | full & ~(vertical | up), up & vertical
        yield score


def best_run(pattern: list[bytes], words: list[bytes]) -> tuple[int, int, int]:
    """Least edits of the pattern to a run of the words, and where the first such run starts and stops."""
    ends = list(edit_column(pattern, words, True))
    edits = min(ends, default=len(pattern))
    if edits >= len(pattern):
        return edits, 0, 0
    stop = ends.index(edits) + 1
    back = list(edit_column(pattern[::-1], words[:stop][::-1], False))
    return edits, stop - 1 - back.index(edits), stop


def slices(text: bytes, spans: list[tuple[int, int]]) -> list[list[bytes]]:
    """The words of each (start, stop), reading the text in parts."""
    found: list[list[bytes]] = [[] for _ in spans]
    before = 0
    for part in text_parts(text.translate(WORDS), PART_BYTES):
        words = part.split()
        for own, (start, stop) in zip(found, spans):
            own += words[max(start - before, 0):max(stop - before, 0)]
        before += len(words)
    return found


def base_places(text: bytes, phrases: dict[tuple[bytes, ...], str]) -> tuple[int, list[tuple[int, str]]]:
    """The number of words, and place and label of every phrase."""
    ends = {p[-1] for p in phrases}
    longest = max(map(len, phrases), default=1)
    n, places, held = 0, [], []
    for part in text_parts(text.translate(WORDS), PART_BYTES):
        words = held + part.split()
        n -= len(held)
        if any(end in part for end in ends):
            for k, word in enumerate(words):
                if k >= len(held) and word in ends:
                    places += [(n + k + 1 - len(p), label) for p, label in phrases.items()
                               if tuple(words[max(k + 1 - len(p), 0):k + 1]) == p]
        n += len(words)
        held = words[len(words) - longest + 1:] if longest <= len(words) else words
        held = held if longest > 1 else []
    return n, places


def anchors(templates: Sequence[tuple[str, str]]) -> frozenset[bytes]:
    """Words of which every verified span holds one: edits + 1 places of each template, the longest words."""
    chosen: set[bytes] = set()
    for _, text in templates:
        words = sorted(words_of(text), key=lambda w: (-len(w), w))
        chosen.update(words[:edits_of(len(words)) + 1])
    return frozenset(chosen)


def facts(docs: DataFrame, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """Words and base places of every row; the text goes along only where it holds an anchor."""
    phrases = {tuple(words_of(p)): label for p, label in PHRASES.items()}
    wanted = anchors(templates)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).to_pylist()
            found = [base_places(t, phrases) for t in texts]
            starts = [[at for at, _ in places] for _, places in found]
            anchored = [any(not wanted.isdisjoint(part.split()) for part in text_parts(t.translate(WORDS)))
                        for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([n for n, _ in found], pa.int64()),
                 pa.array(map(len, starts), pa.int64()),
                 pa.array([min(s, default=None) for s in starts], pa.int64()),
                 pa.array([max(s, default=None) for s in starts], pa.int64()),
                 pa.array([",".join(sorted({label for _, label in p})) for _, p in found], pa.string()),
                 pa.array([t if held else None for t, held in zip(texts, anchored)], pa.binary())],
                ["doc_id", "row_a", "row_b", "n_words", "n_base", "first_word", "last_word", "base_labels", "text"])

    return with_row(docs).mapInArrow(read, FACT_SCHEMA)


SPAN_TYPE = "array<struct<label: string, start: bigint, stop: bigint, share: double>>"


def license_spans(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``doc_id n_words n_base first_word last_word base_labels spans`` of every row; ``spans`` are the verified notices
    with their words in the document."""
    patterns = [(label, words_of(text)) for label, text in templates]
    spans = candidate_spans(docs, templates).groupBy("row_a", "row_b").agg(
        F.sort_array(F.collect_list(F.struct("template", "start", "stop"))).alias("spans"))
    rows = facts(docs, templates).join(spans, ["row_a", "row_b"], "left")
    rows = rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                       F.when(F.col("spans").isNotNull(), F.col("text")).alias("text"),
                       F.coalesce("spans", F.array().cast("array<struct<template: int, start: bigint, stop: bigint>>"))
                       .alias("spans"))

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, asked in zip(batch.column(6).to_pylist(), batch.column(7).to_pylist()):
                kept = []
                places = [(s["start"], s["stop"]) for s in asked]
                for span, words in zip(asked, slices(text, places) if text else []):
                    label, pattern = patterns[span["template"]]
                    edits, start, stop = best_run(pattern, words)
                    if edits <= edits_of(len(pattern)):
                        kept.append({"label": label, "start": span["start"] + start,
                                     "stop": span["start"] + stop, "share": 1 - edits / len(pattern)})
                out.append(kept)
            kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()),
                                       ("stop", pa.int64()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(out, kind)],
                                             [*batch.schema.names[:6], "spans"])

    return rows.mapInArrow(verified, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, "
                                     f"last_word bigint, base_labels string, spans {SPAN_TYPE}")


def license_labels(found: DataFrame) -> DataFrame:
    """The rows of ``license_spans`` with ``labels`` and ``score`` in place of the spans."""
    base: Column = F.when(F.col("base_labels") != "", F.split("base_labels", ",")).otherwise(F.array())
    labels = F.array_sort(F.array_union(base, F.col("spans.label")))
    share = F.coalesce(F.array_max("spans.share"), F.lit(0.0))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                        F.array_join(labels, ",").alias("labels"),
                        F.when(F.col("n_base") > 0, 1.0).otherwise(share).alias("score"))
