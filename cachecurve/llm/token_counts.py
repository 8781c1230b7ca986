"""Token counts with a whole-token shortcut.

Before the job starts, every string of the vocabulary is encoded alone; those that come
back as one token are the *whole tokens*. In the job a pre-token that is a whole token
counts one without any merging, and only the distinct rest goes through the merges of the
tokenizers library. Pre-tokens are encoded independently of each other, so the sum over a
text is what the library gives for the text.

Results: null and empty texts have no tokens. Rows are independent: repeated rows give
repeated results, an empty table gives an empty one, other columns are not read. A null
``doc_id`` stays null. Special strings (``<|endoftext|>``) inside a text are one token, as the library's default
has it; such texts, and texts with code points newer than the class table, go through the
library whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachecurve.llm.pretokens import PieceCache, Pieces, piece_batches, segments


@functools.cache
def load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(path: str) -> list[str]:
    return [token.content for token in load(path).get_added_tokens_decoder().values()]


def whole_tokens(path: str) -> np.ndarray:
    """Hashes of the vocabulary strings that encode alone as exactly one token.

    Only strings that are one pre-token qualify; nothing else is ever looked up.
    """
    tokenizer = load(path)
    strings = [tokenizer.decode([i], skip_special_tokens=False)
               for i in range(tokenizer.get_vocab_size(with_added_tokens=False))]
    strings = [s for s in strings if s and "�" not in s]
    encoded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    alone = [s for s, e in zip(strings, encoded) if len(e.ids) == 1]
    found = Pieces(alone)
    one = np.flatnonzero(found.counts == 1)
    position = np.cumsum(found.counts)[one] - 1
    return np.unique(found.hashes[found.inverse[position]])


@functools.cache
def byte_signs() -> dict[int, int]:
    """The sign that stands for each byte in the vocabulary: printable bytes for themselves,
    the others from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(rest)}


def merge(path: str, pieces: list[str]) -> Iterator[list]:
    """The tokens of pre-tokens by the merges of the library."""
    model, signs = load(path).model, byte_signs()
    for piece in pieces:
        yield model.tokenize(piece.encode().decode("latin-1").translate(signs))


def merged_counts(path: str, pieces: list[str]) -> list[int]:
    return [len(tokens) for tokens in merge(path, pieces)]


def library_counts(path: str, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in load(path).encode_batch_fast(texts, add_special_tokens=False)]


class TokenCounter:
    def __init__(self, path: str, whole: np.ndarray):
        self.path, self.special = path, special_strings(path)
        self.cache = PieceCache(dict.fromkeys(whole.tolist(), 1),
                                functools.partial(merged_counts, path))

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of every text."""
        parts = [list(segments(t)) for t in texts]
        flat = [p for ps in parts for p in ps]
        out = np.zeros(len(flat), np.int64)
        for first, last, batch in piece_batches(flat):
            pieces = Pieces(batch)
            values = np.array(self.cache.of(pieces), np.int64)
            sums = np.concatenate(([0], np.cumsum(values[pieces.inverse])))
            stops = np.cumsum(pieces.counts)
            out[first:last] = sums[stops] - sums[stops - pieces.counts]
            for k in np.flatnonzero(pieces.odd):
                out[first + k] = library_counts(self.path, [batch[k]])[0]
        owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        total = np.bincount(owner, weights=out, minlength=len(texts)).astype(np.int64)
        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                total[k] = library_counts(self.path, [text])[0]
        return total


def count_tokens(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id",
                 limit: int = 512) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every text."""
    spark = docs.sparkSession
    whole = spark.sparkContext.broadcast(whole_tokens(path))  # at most the vocabulary

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, whole)
        for batch in batches:
            tokens = counter.count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    return rows.mapInArrow(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint") \
        .withColumn("over_limit", F.col("n_tokens") > limit)


_counters: dict[str, TokenCounter] = {}


def _counter(path: str, whole) -> TokenCounter:
    """One counter a worker process, so that its cache serves several tasks."""
    if path not in _counters:
        _counters[path] = TokenCounter(path, whole.value)
    return _counters[path]
