"""Token ids in compressed files with an index, read back document by document.

A data set is a folder of three parquet tables:

* ``dictionary``: one row (``dict_hash``, ``dictionary``), the zstandard dictionary that all
  frames share, trained on the serialized ids of a bounded sample of documents. It is empty
  if there are too few documents to train one; frames are then plain.
* ``blocks``: ``part block data`` and the index of ``data``: ``doc_ids``, ``offsets``
  and ``lengths`` (bytes in ``data``), ``n_tokens``, ``starts`` (ids of the documents before, in the
  same part) and ``dict_hash``. ``data`` holds one zstandard frame a document.
* ``parts``: ``part``, ``first_id`` (ids in all parts before) and ``part_tokens``.

Parts follow the order of the document ids, blocks the order in a part and frames the order in a
block, so the concatenation of all frames is the token stream. A frame holds unsigned
16-bit little-endian ids where every id of the vocabulary fits, else 32-bit ones; the ids of a document end with
``end_id``. One short document is read by its offset: the block's row, a slice, one
decompression with the shared dictionary.

Spark writes the tables, so any store it writes to will do, and a task that is run again
leaves no second copy. Texts are range-partitioned by document id before they are encoded: only
texts are shuffled, once, and a part is as large as Spark makes a partition.

Results: a null or empty text is a document of the end id alone. Null ids come first.
Repeated rows and equal ids are separate documents next to each other, ordered by text.
An empty table gives an empty data set. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cachecurve.llm.pretokens import PieceCache, Pieces, piece_batches, segments
from cachecurve.llm.token_counts import load, merge, special_strings

#: Documents, and characters of each, that the dictionary is trained on, and its size.
SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Bytes of frames in a block before the next one is begun.
BLOCK_BYTES = 4 << 20
#: Documents that are encoded at a time.
ENCODED_ROWS = 500

BLOCK_SCHEMA = ("part int, block int, data binary, doc_ids array<bigint>, offsets array<bigint>, "
                "lengths array<bigint>, n_tokens array<bigint>, starts array<bigint>, "
                "block_tokens bigint, dict_hash string")


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, so that the Python copies of only one part are held."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def merged_ids(path: str, pieces: list[str]) -> list[bytes]:
    """The ids of each pre-token as 32-bit numbers; a tuple of ints would take four times the memory."""
    return [array("I", [token.id for token in tokens]).tobytes() for tokens in merge(path, pieces)]


class IdEncoder:
    """Ids of whole texts; pre-tokens that come again are not merged again."""

    def __init__(self, path: str):
        self.path, self.special = path, special_strings(path)
        self.cache = PieceCache({}, functools.partial(merged_ids, path), 600_000)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        flat, owner = [], []
        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[k].append(self.library(text))
                continue
            for part in segments(text):
                flat.append(part)
                owner.append(k)
        for first, _, batch in piece_batches(flat):
            pieces = Pieces(batch)
            values = self.cache.of(pieces)
            sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
            known = np.frombuffer(b"".join(values), np.uint32)
            begins = np.cumsum(sizes) - sizes
            lengths = sizes[pieces.inverse]
            stops = np.cumsum(lengths)
            ids = known[np.repeat(begins[pieces.inverse] - (stops - lengths), lengths)
                        + np.arange(int(lengths.sum()))]
            edges = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(pieces.counts)))]
            for k in range(len(batch)):
                own = self.library(batch[k]) if pieces.odd[k] else ids[edges[k]:edges[k + 1]]
                out[owner[first + k]].append(own)
        return [np.concatenate(parts) if parts else np.empty(0, np.uint32) for parts in out]

    def library(self, text: str) -> np.ndarray:
        return np.array(load(self.path).encode(text, add_special_tokens=False).ids, np.uint32)


@functools.cache
def _encoder(path: str) -> IdEncoder:
    """One encoder a worker process, so that its cache serves several tasks."""
    return IdEncoder(path)


def id_type(path: str, end_id: int) -> np.dtype:
    largest = max(load(path).get_vocab_size() - 1, end_id)
    return np.dtype("<u2") if largest < 1 << 16 else np.dtype("<u4")


def train_dictionary(docs: DataFrame, path: str, end_id: int) -> bytes:
    """A dictionary from the ids of at most ``SAMPLE_DOCS`` documents by a digest of their
    keys; of a long one, ``SAMPLE_CHARS`` characters. It only bears on the size of frames."""
    import zstandard

    apart = max(1, docs.count() // SAMPLE_DOCS)
    rows = docs.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(apart)) == 0) \
        .select(F.substring("text", 1, SAMPLE_CHARS).alias("text")).limit(SAMPLE_DOCS)
    kind = id_type(path, end_id)
    samples = [ids.astype(kind).tobytes() for ids in
               IdEncoder(path).encode([row.text for row in rows.collect()]) if len(ids)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""  # too few samples


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int) -> None:
    """Encode ``doc_id text`` and write the data set to the folder ``out``."""
    import zstandard

    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    dictionary = train_dictionary(docs, path, end_id)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    kind = id_type(path, end_id)
    spark.createDataFrame([(dict_hash, dictionary)], "dict_hash string, dictionary binary") \
        .write.parquet(f"{out}/dictionary")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        part, encoder = TaskContext.get().partitionId(), _encoder(path)
        number, start = 0, 0
        frames: list[bytes] = []
        ids: list[int] = []
        tokens: list[int] = []
        filled = 0

        def block() -> pa.RecordBatch:
            sizes = np.array([len(f) for f in frames], np.int64)
            counts = np.array(tokens, np.int64)
            columns = [[part], [number], [b"".join(frames)], [ids], [np.cumsum(sizes) - sizes],
                       [sizes], [counts], [start + np.cumsum(counts) - counts],
                       [int(counts.sum())], [dict_hash]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _block_schema())],
                schema=_block_schema())

        for batch in slices(batches, ENCODED_ROWS):
            encoded = encoder.encode(batch.column(1).to_pylist())
            for doc_id, own in zip(batch.column(0).to_pylist(), encoded):
                frames.append(compress(np.append(own, end_id).astype(kind).tobytes()))
                ids.append(doc_id)
                tokens.append(len(own) + 1)
                filled += len(frames[-1])
                if filled >= BLOCK_BYTES:
                    yield block()
                    number, start = number + 1, start + sum(tokens)
                    frames, ids, tokens, filled = [], [], [], 0
        if frames:
            yield block()

    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(written, BLOCK_SCHEMA).write.option("compression", "none") \
        .parquet(f"{out}/blocks")
    parts = spark.read.parquet(f"{out}/blocks").groupBy("part") \
        .agg(F.sum("block_tokens").alias("part_tokens"))
    before = F.sum("part_tokens").over(Window.orderBy("part"))  # one row a partition
    parts.select("part", (before - F.col("part_tokens")).alias("first_id"), "part_tokens") \
        .write.parquet(f"{out}/parts")


@functools.cache
def _block_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema([("part", pa.int32()), ("block", pa.int32()), ("data", pa.binary()),
                      ("doc_ids", longs), ("offsets", longs), ("lengths", longs),
                      ("n_tokens", longs), ("starts", longs), ("block_tokens", pa.int64()),
                      ("dict_hash", pa.string())])


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(bytes(row.dictionary)).hexdigest() != row.dict_hash:
        raise ValueError(f"the dictionary in {folder} is damaged")
    return row.dict_hash, bytes(row.dictionary)


def _ids(frame: bytes, n_tokens: int, decompressor) -> np.ndarray:
    raw = decompressor.decompress(frame)
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n_tokens else "<u4")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id start n_tokens part block offset length dict_hash`` of every document;
    no frame is read."""
    blocks = spark.read.parquet(f"{folder}/blocks").drop("data", "block_tokens")
    parts = spark.read.parquet(f"{folder}/parts").select("part", "first_id")
    rows = blocks.join(parts, "part").select("part", "block", "dict_hash", "first_id", F.inline(
        F.arrays_zip("doc_ids", "offsets", "lengths", "n_tokens", "starts")))
    return rows.select(F.col("doc_ids").alias("doc_id"),
                       (F.col("first_id") + F.col("starts")).alias("start"), "n_tokens", "part",
                       "block", F.col("offsets").alias("offset"), F.col("lengths").alias("length"),
                       "dict_hash")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id, by index and offset."""
    import zstandard

    dict_hash, dictionary = _dictionary(spark, folder)
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    blocks = spark.read.parquet(f"{folder}/blocks").select("part", "block", "data")
    found = read_index(spark, folder).where(F.col("doc_id") == doc_id) \
        .join(blocks, ["part", "block"]).orderBy("start") \
        .select("n_tokens", "dict_hash", F.expr("substring(data, int(offset) + 1, int(length))").alias("frame"))
    out = []
    for row in found.toLocalIterator():
        if row.dict_hash != dict_hash:
            raise ValueError("the frame was written with another dictionary")
        out.append(_ids(bytes(row.frame), row.n_tokens, zstandard.ZstdDecompressor(dict_data=shared)))
    return out


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id start n_tokens ids_crc32`` of every document, from its decompressed frame."""
    import zstandard

    dict_hash, dictionary = _dictionary(spark, folder)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        decompressor = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                if row["dict_hash"] != dict_hash:
                    raise ValueError("a block was written with another dictionary")
                data = row["data"]
                crcs = [zlib.crc32(_ids(data[at:at + n], count, decompressor).astype("<u4").tobytes())
                        for at, n, count in zip(row["offsets"], row["lengths"], row["n_tokens"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * len(crcs), pa.int32()),
                     pa.array(row["starts"], pa.int64()), pa.array(row["n_tokens"], pa.int64()),
                     pa.array(crcs, pa.int64())],
                    ["doc_id", "part", "inside", "n_tokens", "ids_crc32"])

    blocks = spark.read.parquet(f"{folder}/blocks").drop("block", "block_tokens")
    rows = blocks.mapInArrow(
        decoded, "doc_id bigint, part int, inside bigint, n_tokens bigint, ids_crc32 bigint")
    parts = spark.read.parquet(f"{folder}/parts").select("part", "first_id")
    return rows.join(parts, "part").select(
        "doc_id", (F.col("first_id") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
