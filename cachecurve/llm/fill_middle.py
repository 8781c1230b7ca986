"""Fill-in-middle on seekable compressed frames.

``write_frames`` stores every text as independent zstandard frames of at most ``FRAME_BYTES``,
with the number of units and of code points before each frame. A unit is a word with the blanks
before it, or the blanks at the end of a text. ``fill_middle`` draws two places among the units from a digest of the
document's id, finds by the counts the frames that they cut, and decompresses no others: the output is again a list of
frames, in which untouched frames are the stored bytes and marks and cut parts are new frames. A plain document keeps
its frames as they are. ``output_digests`` streams the ordered frames, one at a time, for the digest of the output and
of the text that is rebuilt from output and form; ``output_texts`` gives the output as strings.

A frame ends at a code point, not at a unit, so frames are bounded whatever the words are; a unit
counts for the frame in which it ends. Rows are independent: nothing is shuffled, and a lost executor costs the rows it had.

Results: a null or empty text has no units and is plain. Repeated rows give repeated
results; a null id is drawn for as the empty string. An empty table gives an empty one. Only
``doc_id`` and ``text`` are read, so other columns of any name do not matter. A text that holds a mark stays plain.
"""

from __future__ import annotations

import functools
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachecurve.scratch import save

#: Marks before prefix, suffix and middle, and the order of the marks in each form.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE), "plain": ()}
SEED = 42
#: Per cent of the documents that are cut, and of those the ones with the suffix first.
CUT_PERCENT, SPM_PERCENT = 50, 80
FRAME_BYTES = 64 << 10
LEVEL = 3

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BLANKS = b" \t\n\x0b\x0c\r"

FRAME_FIELDS = [("doc_id", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()),
                ("units", pa.list_(pa.int64())), ("chars", pa.list_(pa.int64())),
                ("frames", pa.list_(pa.binary()))]
FRAME_SCHEMA = ("doc_id bigint, n bigint, marked boolean, units array<bigint>, chars array<bigint>, "
                "frames array<binary>")
OUTPUT_FIELDS = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                 ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                 ("frames", pa.list_(pa.binary()))]
OUTPUT_SCHEMA = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
                 "frames array<binary>")


@functools.cache
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()


def code_points(raw: bytes) -> int:
    if raw.isascii():
        return len(raw)
    return int(np.count_nonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80))


def split_frames(raw: bytes, most: int = FRAME_BYTES) -> Iterator[tuple[bytes, int]]:
    """Parts of at most ``most`` bytes that end at code points, and the units that end in each."""
    start = 0
    while start < len(raw):
        stop = min(start + most, len(raw))
        while stop < len(raw) and raw[stop] & 0xC0 == 0x80:
            stop -= 1
        part = raw[start:stop]
        units = len(part.split())
        if stop == len(raw):
            units += part[-1] in BLANKS
        elif part[-1] not in BLANKS and raw[stop] not in BLANKS:
            units -= 1  # the word goes on in the next frame
        yield part, units
        start = stop


def write_frames(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """A table in the shared folder with the frames of every text and the counts before each."""
    if frame_bytes < 8:
        raise ValueError("a frame must hold a code point")

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = _zstd()[0].compress
        for batch in batches:
            columns: list[list] = [[] for _ in FRAME_FIELDS]
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                units, chars, frames, n, length = [], [], [], 0, 0
                for part, ends in split_frames(raw, frame_bytes):
                    units.append(n)
                    chars.append(length)
                    frames.append(compress(part))
                    n, length = n + ends, length + code_points(part)
                marked = any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE))
                for column, value in zip(columns, (doc_id, n, marked, units, chars, frames)):
                    column.append(value)
            yield _batch(columns, FRAME_FIELDS)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return save(rows.mapInArrow(framed, FRAME_SCHEMA), "frames")


def _batch(columns: list[list], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)],
                                      names=[name for name, _ in fields])


class Frames:
    """The stored frames of one document."""

    def __init__(self, n: int, units: list[int], chars: list[int], frames: list[bytes]):
        self.n, self.units, self.chars, self.frames = n, units, chars, frames
        self.open: dict[int, bytes] = {}

    def raw(self, k: int) -> bytes:
        if k not in self.open:
            self.open[k] = _zstd()[1].decompress(self.frames[k])
        return self.open[k]

    def place(self, unit: int) -> tuple[int, int]:
        """Frame and byte in it where the first ``unit`` units end."""
        if unit == 0:
            return 0, 0
        k = bisect_left(self.units, unit) - 1
        raw = self.raw(k)
        if unit == self.n:
            return k, len(raw)
        return k, next(islice(WORD.finditer(raw), unit - self.units[k] - 1, None)).end()

    def chars_before(self, place: tuple[int, int]) -> int:
        k, at = place
        return self.chars[k] + code_points(self.raw(k)[:at])

    def between(self, a: tuple[int, int], b: tuple[int, int] | None) -> Iterator[tuple[bytes, bool]]:
        """Bytes and stored frames (true) from one place to another or to the end."""
        (k, at), (last, stop) = a, b or (len(self.frames), 0)
        while k < last:
            if at:
                yield self.raw(k)[at:], False
            else:
                yield self.frames[k], True
            k, at = k + 1, 0
        if stop > at:
            yield self.raw(k)[at:stop], False


def joined_frames(parts: Iterator[tuple[bytes, bool]]) -> list[bytes]:
    """Frames of an output; neighbouring new parts share one."""
    frames, fresh = [], b""
    for data, stored in parts:
        if not stored:
            fresh += data
            continue
        if fresh:
            frames.append(_zstd()[0].compress(fresh))
        frames.append(data)
        fresh = b""
    if fresh:
        frames.append(_zstd()[0].compress(fresh))
    return frames


def draws(doc_id: int | None, seed: int) -> list[int]:
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def fill_middle(frames: DataFrame, seed: int = SEED, cut_percent: int = CUT_PERCENT,
                spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``doc_id n form prefix_chars middle_chars frames`` of every document of ``write_frames``."""

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in OUTPUT_FIELDS]
            for doc_id, n, marked, units, chars, stored in zip(*(c.to_pylist() for c in batch.columns)):
                h1, h2, h3, h4 = draws(doc_id, seed)
                form, prefix, middle = "plain", None, None
                if n and not marked and h3 % 100 < cut_percent:
                    form = "spm" if h4 % 100 < spm_percent else "psm"
                    doc = Frames(n, units, chars, stored)
                    a, b = (doc.place(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    prefix = doc.chars_before(a)
                    middle = doc.chars_before(b) - prefix
                    spans = {PREFIX: ((0, 0), a), MIDDLE: (a, b), SUFFIX: (b, None)}
                    stored = joined_frames(part for mark in ORDERS[form] for part in
                                           [(mark, False), *doc.between(*spans[mark])])
                for column, value in zip(columns, (doc_id, n, form, prefix, middle, stored)):
                    column.append(value)
            yield _batch(columns, OUTPUT_FIELDS)

    return frames.mapInArrow(moved, OUTPUT_SCHEMA)


def stream(frames: list[bytes]) -> Iterator[bytes]:
    return map(_zstd()[1].decompress, frames)


def sections(chunks: Iterator[bytes], marks: tuple[bytes, ...]) -> Iterator[tuple[bytes, bytes]]:
    """The mark that each part of a stream stands after, and the part; marks may lie across chunks."""
    found, held = 0, b""
    for chunk in chunks:
        held += chunk
        while found < len(marks) and (cut := held.find(marks[found])) >= 0:
            if found:
                yield marks[found - 1], held[:cut]
            held, found = held[cut + len(marks[found]):], found + 1
        ready = len(held) if found == len(marks) else max(0, len(held) - len(marks[found]) + 1)
        if found:
            yield marks[found - 1], held[:ready]
        held = held[ready:]


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text in its own order from output and form: the suffix by a second pass over the
    stream, so that nothing is held."""
    marks = ORDERS[form]
    if not marks:
        yield from stream(frames)
        return
    for wanted in ((PREFIX, MIDDLE), (SUFFIX,)):
        yield from (part for mark, part in sections(stream(frames), marks) if mark in wanted)


def digest(parts: Iterator[bytes]) -> str:
    found = hashlib.sha256()
    for part in parts:
        found.update(part)
    return found.hexdigest()


def output_digests(output: DataFrame) -> DataFrame:
    """The rows of ``fill_middle`` with ``output_sha256`` and ``restored_sha256`` for their frames."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, stored = batch.column(2).to_pylist(), batch.column(5).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array([digest(stream(f)) for f in stored], pa.string()),
                 pa.array([digest(restored(f, form)) for f, form in zip(stored, forms)], pa.string())],
                [*batch.schema.names[:5], "output_sha256", "restored_sha256"])

    schema = OUTPUT_SCHEMA.replace("frames array<binary>", "output_sha256 string, restored_sha256 string")
    return output.mapInArrow(digested, schema)


def output_texts(output: DataFrame) -> DataFrame:
    """``doc_id form output`` with the output as a string, and ``text``, rebuilt from it."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, stored = batch.column(2).to_pylist(), batch.column(5).to_pylist()
            texts = [b"".join(stream(f)).decode() for f in stored]
            again = [b"".join(restored(f, form)).decode() for f, form in zip(stored, forms)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(texts, pa.string()), pa.array(again, pa.string())],
                ["doc_id", "form", "output", "text"])

    return output.mapInArrow(decoded, "doc_id bigint, form string, output string, text string")
