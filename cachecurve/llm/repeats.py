"""Long repeats across documents by a run-length index of the places where texts may repeat.

A byte is removed when a run of ``length`` bytes (50) that covers it also starts in a document
with a smaller id. Texts are judged as they came in, not after removals.

Documents are packed into compressed chunks of about a megabyte, saved once and read three times;
what the chunks and the key ranges tell each other is packed into arrays, one row for each pair
of chunk and range.

1. Anchors. In each run of ``length`` bytes the 16-byte strings of least hash are anchors, so
   equal runs have equal anchors at equal places; a text has one about every 18 bytes. They are
   searched when the chunk is packed, which keeps their places. Key ranges go by another hash of the
   string, which the choice does not bias. Each chunk
   names every anchor hash once, and the ranges answer which occur in two documents.
2. Contexts. Around each such anchor the bytes of all runs that hold it are cut out (34 before its
   start, 50 from it). A chunk sends every distinct context once, with its least document.
3. Index. For its range of anchors a task builds a Burrows-Wheeler transform of the distinct
   contexts that may share a run, as runs. Those share the anchor and the 17 bytes before or after
   it; a group of them too large for one index is divided by longer shared parts, down to the
   run itself, so a hot anchor needs no larger index. Of the transform the character, start and rank of
   each run are kept, and samples at the ends of runs, which are cut where the first ``length``
   bytes of the suffixes change; the sample is the least document that holds those bytes. All contexts
   then stream backwards through the index in step; where the match is ``length`` or longer
   (the matching statistic that counts here) the sample at the end of the run tells whether a
   smaller document has it. The transform and the suffix order are dropped after building.
4. Marks. Each chunk gets the answers for its contexts and marks the covered bytes.

A passage that a third of all documents share is one context a chunk, whatever their number, and
no pairs of documents are ever formed. The index is of repetitive text by
construction, which is what runs are short for. Two anchors or contexts are taken for equal
with odds of 2**-64 a pair.

Results: null is empty text; texts shorter than ``length`` keep all bytes. Rows with equal ids never
remove each other's bytes. A null id counts as larger than any. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachecurve.scratch import save

#: Bytes of text in a chunk, and bytes of all text for each key range.
CHUNK_BYTES = 1 << 20
RANGE_BYTES = 16 << 20
#: Contexts in one index.
INDEX_CONTEXTS = 4_000
ANCHOR = 16
#: Starts of runs whose anchors are searched at a time.
BLOCK = 1 << 17
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_NO_ID = np.iinfo(np.int64).max
#: Symbols packed into the first sort key of a suffix.
PACKED = 7


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each run of ``width`` values, by doubling."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def pack(array: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(array.tobytes())


def unpack(blob: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def eight_bytes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number."""
    raw = np.ascontiguousarray(raw)
    return np.ndarray((max(len(raw) - 7, 0),), "<u8", raw, 0, (1,))


def anchor_hashes(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of the strings of ``ANCHOR`` bytes that begin at the given places. They are mixed once more:
    anchors have the least hashes of their runs, so ranges of those would be far from even."""
    words = eight_bytes(raw)
    return mix(mix(words[at] * _A + mix(words[at + 8] + _B)) + _C)


def anchors(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int) -> np.ndarray:
    """Places of all anchors of the texts, from overlapping blocks to keep arrays small."""
    before = length - ANCHOR
    runs = len(raw) - length + 1  # places where a run begins
    valid = np.zeros(max(runs, 0) + 1, np.int32)  # runs inside one text
    whole = stops - starts >= length
    np.add.at(valid, starts[whole], 1)
    np.add.at(valid, stops[whole] - length + 1, -1)
    valid = np.cumsum(valid, out=valid)[:-1] > 0
    at = [np.empty(0, np.int64)]
    for begin in range(0, runs, BLOCK):
        part = raw[begin:begin + BLOCK + length - 1]
        words = eight_bytes(part)
        hashes = mix(words[:len(part) - 15] * _A + mix(words[8:] + _B))
        least = sliding(hashes, before + 1, np.minimum)  # of every run of ``length`` bytes
        least[~valid[begin:begin + len(least)]] = 0
        edge = np.zeros(before, np.uint64)
        most = sliding(np.concatenate((edge, least, edge)), before + 1, np.maximum)
        at.append(np.flatnonzero((most == hashes) & (hashes > 0)) + begin)
    return np.unique(np.concatenate(at))  # blocks overlap


class Chunk:
    """Texts of one chunk with their anchors; ``gaps`` are the places of the anchors as packed with
    the chunk."""

    def __init__(self, doc_ids: list, sizes: list[int], blob: bytes, length: int, gaps: bytes | None = None):
        self.length, self.before = length, length - ANCHOR
        self.ids = np.array([_NO_ID if i is None else i for i in doc_ids], np.int64)
        self.raw = unpack(blob, np.uint8)
        self.stops = np.cumsum(np.array(sizes, np.int64))
        self.starts = self.stops - np.array(sizes, np.int64)
        self.at = anchors(self.raw, self.starts, self.stops, length) if gaps is None \
            else np.cumsum(unpack(gaps, np.uint32), dtype=np.int64)
        self.hashes = anchor_hashes(self.raw, self.at)
        self.doc = np.searchsorted(self.stops, self.at, "right")
        self.distinct, self.inverse = np.unique(self.hashes, return_inverse=True)

    def pieces(self, hashes: np.ndarray, bits: int) -> dict[int, tuple[int, int]]:
        """Where each key range that occurs begins and ends among sorted hashes."""
        ranges = (hashes >> np.uint64(64 - bits) if bits else np.zeros_like(hashes)).astype(np.int64)
        starts = np.flatnonzero(np.diff(ranges, prepend=-1))
        stops = np.append(starts[1:], len(hashes))[:len(starts)]
        return dict(zip(ranges[starts].tolist(), zip(starts.tolist(), stops.tolist())))

    def least_and_most(self, groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(groups, kind="stable")
        heads = np.flatnonzero(np.diff(groups[order], prepend=-1))
        own = ids[order]
        if not len(own):
            return own, own
        return np.minimum.reduceat(own, heads), np.maximum.reduceat(own, heads)

    def several(self) -> np.ndarray:
        """Whether an anchor hash is in two texts of this chunk."""
        low, high = self.least_and_most(self.inverse, self.ids[self.doc])
        return low < high

    def contexts(self, shared: np.ndarray) -> None:
        """Distinct contexts of the shared anchors in order of anchor hash (``records``), their
        anchors (``keys``) and least documents (``least``), and the context of each occurrence
        (``context`` of ``found``)."""
        self.found = np.flatnonzero(shared[self.inverse])
        at, doc = self.at[self.found], self.doc[self.found]
        left = np.minimum(self.before, at - self.starts[doc])
        right = np.minimum(self.length, self.stops[doc] - at)
        size = self.before + self.length
        padded = np.concatenate((np.zeros(self.before, np.uint8), self.raw,
                                 np.zeros(self.length, np.uint8)))
        view = np.ndarray((len(self.raw), size), np.uint8, padded, 0, (1, 1))
        width = -(-(size + 2) // 8) * 8
        records = np.zeros((len(at), width), np.uint8)
        records[:, :size] = view[at]
        place = np.arange(size)
        records[:, :size][(place < (self.before - left)[:, None])
                          | (place >= (self.before + right)[:, None])] = 0
        records[:, size], records[:, size + 1] = left, right
        digest = np.zeros(len(at), np.uint64)
        for column in records.view("<u8").T:
            digest = mix(digest * _A + column)
        order = np.lexsort((digest, self.hashes[self.found]))
        key, value = self.hashes[self.found][order], digest[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (value[1:] != value[:-1])
        self.context = np.empty(len(order), np.int64)
        self.context[order] = np.cumsum(new) - 1
        firsts = order[new]
        self.records, self.keys = records[firsts], key[new]
        self.least = self.least_and_most(self.context, self.ids[doc])[0]

    def removed(self, least: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """Mask of the covered bytes, from the least document of each context anywhere and the
        runs of it that a smaller document than that one holds."""
        at, doc = self.at[self.found], self.doc[self.found]
        size = self.before + self.length
        records = self.records[self.context]
        left, right = records[:, size].astype(np.int64), records[:, size + 1].astype(np.int64)
        place = np.arange(self.before + 1)
        valid = (place >= (self.before - left)[:, None]) & (place <= (right - ANCHOR)[:, None])
        held = (runs[self.context][:, None] >> place.astype(np.uint64)) & np.uint64(1) > 0
        later = (self.ids[doc] > least[self.context])[:, None]
        occurrence, offset = np.nonzero(valid & (held | later))
        marks = np.zeros(len(self.raw) + 1, np.int32)
        begins = np.unique(at[occurrence] - self.before + offset)
        marks[begins] += 1
        np.add.at(marks, begins + self.length, -1)
        return np.cumsum(marks[:-1]) > 0


class RunLengthIndex:
    """Run-compressed transform of strings with a sampled number at the end of each run.

    ``texts`` are rows of bytes, ``sizes`` their lengths, ``numbers`` one number a row; the
    sample of a run is the least number over all rows that hold the first ``length`` bytes there.
    """

    def __init__(self, texts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, length: int):
        self.count, self.length = len(texts), length
        width = texts.shape[1] + 1
        place = np.arange(width)
        inside = place < sizes[:, None]
        symbols = np.zeros((self.count, width + PACKED), np.int64)
        symbols[:, :width - 1] = texts.astype(np.int64) + 1
        symbols[:, :width][~inside] = 0
        keep = (place <= sizes[:, None]).ravel()  # every suffix, the empty one too
        key = np.zeros((self.count, width), np.int64)
        for i in range(PACKED):
            key = key * 257 + symbols[:, i:i + width]
        row_of = np.repeat(np.arange(self.count), width)[keep]

        def rank(values: np.ndarray) -> np.ndarray:
            out = np.zeros(self.count * width, np.int64)
            out[keep] = np.unique(values, return_inverse=True)[1] + 1
            return out.reshape(self.count, width)

        def at(ranks: np.ndarray, offset: int) -> np.ndarray:
            moved = np.zeros_like(ranks)
            if offset < width:
                moved[:, :width - offset] = ranks[:, offset:]
            return moved

        def joined(ranks: np.ndarray, *offsets: int) -> np.ndarray:
            out, above = ranks, ranks.max() + 1
            for offset in offsets:
                out = out * above + at(ranks, offset)
            return out.ravel()[keep]

        ranks, depth = rank(key.ravel()[keep]), PACKED
        while depth < length:  # up to three ranks fit one number
            three = int(ranks.max() + 1) ** 3 < 1 << 63
            reach = min((3 if three else 2) * depth, length)
            ranks = rank(joined(ranks, *([min(depth, reach - depth)] if three else []), reach - depth))
            depth = reach
        equal = ranks.ravel()[keep]  # equal first ``length`` bytes
        while 2 * depth < width:
            ranks, depth = rank(joined(ranks, depth)), 2 * depth
        order = np.argsort(joined(ranks, max(width - depth, 0)), kind="stable")
        previous = np.zeros((self.count, width), np.int64)
        previous[:, 1:] = symbols[:, :width - 1]
        last = previous.ravel()[keep][order]
        equal = equal[order]
        heads = np.flatnonzero(np.diff(equal, prepend=-1))
        lowest = np.minimum.reduceat(numbers[row_of[order]], heads)[np.cumsum(
            np.diff(equal, prepend=-1) != 0) - 1]
        # runs: equal characters, cut where the first ``length`` bytes change
        self.begins = np.flatnonzero((np.diff(last, prepend=-1) != 0) | (np.diff(equal, prepend=-1) != 0))
        self.symbol, self.sample = last[self.begins], lowest[self.begins]
        sizes_of = np.diff(np.append(self.begins, len(last)))
        first = np.concatenate(([0], np.cumsum(np.bincount(last, minlength=258))))
        by_symbol = np.argsort(self.symbol, kind="stable")
        before = np.cumsum(sizes_of[by_symbol]) - sizes_of[by_symbol]
        self.rank = np.empty(len(self.begins), np.int64)  # row that the run's first row leads to
        ordered = self.symbol[by_symbol]
        group = np.flatnonzero(np.diff(ordered, prepend=-1))
        base = np.repeat(before[group], np.diff(np.append(group, len(ordered))))
        self.rank[by_symbol] = first[ordered] + before - base

    def held_before(self, sizes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """For each indexed row a bit for each start of a run of ``length`` bytes that a row of
        a smaller number holds. All rows stream backwards in step."""
        held = np.zeros(self.count, np.uint64)
        active = np.argsort(-sizes, kind="stable")  # those that end first are the last
        longer = np.searchsorted(-sizes[active], -np.arange(int(sizes.max(initial=0)) + 1), "right")
        rows = active
        run = np.searchsorted(self.begins, rows, "right") - 1
        for step in range(1, len(longer)):
            run = run[:longer[step]]
            rows = self.rank[run] + rows[:longer[step]] - self.begins[run]  # one byte longer
            run = np.searchsorted(self.begins, rows, "right") - 1
            if step >= self.length:
                own = active[:longer[step]]
                smaller = own[self.sample[run] < numbers[own]]
                held[smaller] |= np.uint64(1) << (sizes[smaller] - step).astype(np.uint64)
        return held


def core_groups(records: np.ndarray, rows: np.ndarray, left: int, right: int, length: int):
    """The given contexts that agree with another one on the anchor, ``left`` bytes before and
    ``right`` bytes after it: their rows, group by group, and where each group ends."""
    before = length - ANCHOR
    size = before + length
    rows = rows[(records[rows, size] >= left) & (records[rows, size + 1] >= ANCHOR + right)]
    core = np.zeros((len(rows), -(-(left + ANCHOR + right) // 8) * 8), np.uint8)
    core[:, :left + ANCHOR + right] = records[rows, before - left:before + ANCHOR + right]
    digest = np.zeros(len(rows), np.uint64)
    for column in core.view("<u8").T:
        digest = mix(digest * _A + column)
    _, group, times = np.unique(digest, return_inverse=True, return_counts=True)
    again = np.flatnonzero(times[group] > 1)
    again = again[np.argsort(group[again], kind="stable")]
    return rows[again], np.flatnonzero(np.diff(group[again], append=-1)) + 1


def index_parts(records: np.ndarray, rows: np.ndarray, left: int, right: int, length: int):
    """Parts of at most INDEX_CONTEXTS contexts so that any two that share a run around the given
    core are together in one part: ``(rows, None)``, or ``(rows, offset)`` for more contexts
    that all hold one and the same run.

    A run has at least half of the bytes it still needs on one side of the core. Contexts are
    grouped by the core with that half before it and with that half after it; a group too large for an
    index is divided again, by a core that is a half nearer to a whole run.
    """
    need = length - ANCHOR - left - right
    if not need:
        yield rows, length - ANCHOR - left
        return
    half = -(-need // 2)
    for l, r in ((left + half, right), (left, right + half)):
        found, ends = core_groups(records, rows, l, r, length)
        done = 0
        while done < len(found):  # whole groups, up to INDEX_CONTEXTS contexts in one part
            fits = np.searchsorted(ends, done + INDEX_CONTEXTS, "right")
            upto = int(ends[max(fits - 1, np.searchsorted(ends, done, "right"))])
            part, done = found[done:upto], upto
            if len(part) > INDEX_CONTEXTS:
                yield from index_parts(records, part, l, r, length)
            else:
                yield part, None


def answer_contexts(records: np.ndarray, least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context its least document among equal ones, and the runs in it that a smaller
    document than that one holds (bit ``o`` for the run at offset ``o``)."""
    before = length - ANCHOR
    size = before + length
    digest = np.zeros(len(records), np.uint64)
    for column in records.view("<u8").T:
        digest = mix(digest * _A + column)
    _, first, inverse = np.unique(digest, return_index=True, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    heads = np.flatnonzero(np.diff(inverse[order], prepend=-1))
    lowest = np.minimum.reduceat(least[order], heads)
    runs = np.zeros(len(first), np.uint64)
    distinct = records[first]
    for part, offset in index_parts(distinct, np.arange(len(first)), 0, 0, length):
        numbers = lowest[part]
        if offset is not None:
            runs[part[numbers > numbers.min()]] |= np.uint64(1) << np.uint64(offset)
            continue
        own = distinct[part]
        left, right = own[:, size].astype(np.int64), own[:, size + 1].astype(np.int64)
        texts = np.zeros((len(own), size), np.uint8)
        for shift in np.unique(before - left):  # texts begin where the document does
            rows = before - left == shift
            texts[rows, :size - shift] = own[rows, shift:size]
        index = RunLengthIndex(texts, left + right, numbers, length)
        runs[part] |= index.held_before(left + right, numbers) << (before - left).astype(np.uint64)
    return lowest[inverse], runs[inverse]


def pack_chunks(docs: DataFrame, length: int) -> DataFrame:
    """``chunk doc_ids sizes data gaps`` of ``doc_id text``, saved; ``gaps`` lead from anchor to anchor."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list[bytes] = []
        filled = 0

        def chunk() -> pa.RecordBatch:
            raw, sizes = np.frombuffer(b"".join(texts), np.uint8), [len(t) for t in texts]
            stops = np.cumsum(np.array(sizes, np.int64))
            gaps = np.diff(anchors(raw, stops - sizes, stops, length), prepend=0).astype(np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([pack(raw)], pa.binary()),
                 pa.array([pack(gaps)], pa.binary())],
                ["chunk", "doc_ids", "sizes", "data", "gaps"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                texts.append(text.as_buffer().to_pybytes())
                filled += len(texts[-1])
                if filled >= CHUNK_BYTES:
                    yield chunk()
                    number, ids, texts, filled = number + 1, [], [], 0
        if ids:
            yield chunk()

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return save(docs.mapInArrow(packed, "chunk bigint, doc_ids array<bigint>, sizes array<bigint>, "
                                        "data binary, gaps binary"), "chunks")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def repeated_spans(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id n_bytes spans kept``: the removed spans (``start stop`` in bytes) and the bytes that
    are left of every document of ``doc_id text``. ``length`` is 17 to 79."""
    chunks = pack_chunks(docs, length)
    total = chunks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()[0]
    bits = max(0, math.ceil(math.log2(max(1, (total or 0) / RANGE_BYTES))))

    def name_anchors(batches):
        for row in _rows(batches):
            chunk = Chunk(row["doc_ids"], row["sizes"], row["data"], length, row["gaps"])
            several = chunk.several()
            for k, (a, b) in chunk.pieces(chunk.distinct, bits).items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([row["chunk"]], pa.int64()),
                     pa.array([chunk.distinct[a:b].tobytes()], pa.binary()),
                     pa.array([np.packbits(several[a:b]).tobytes()], pa.binary())],
                    ["range", "chunk", "hashes", "several"])

    def find_shared(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
        sizes = np.array([len(h) for h in hashes])
        several = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=n)
                                  for s, n in zip(table["several"].to_pylist(), sizes)])
        _, inverse, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        shared = (times > 1) | (np.bincount(inverse, several, len(times)) > 0)
        parts = np.split(shared[inverse], np.cumsum(sizes)[:-1])
        return pa.table([table["range"], table["chunk"],
                         pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())],
                        ["range", "chunk", "shared"])

    named = chunks.mapInArrow(name_anchors, "range int, chunk bigint, hashes binary, several binary")
    shared = named.groupBy("range").applyInArrow(find_shared, "range int, chunk bigint, shared binary")
    shared = save(shared.groupBy("chunk").agg(F.collect_list(F.struct("range", "shared")).alias("shared")),
                  "shared")

    def with_contexts(row: dict) -> Chunk:
        chunk = Chunk(row["doc_ids"], row["sizes"], row["data"], length, row["gaps"])
        pieces = chunk.pieces(chunk.distinct, bits)
        known = np.zeros(len(chunk.distinct), bool)
        for answer in row["shared"] or []:
            a, b = pieces[answer["range"]]
            known[a:b] = np.unpackbits(np.frombuffer(answer["shared"], np.uint8), count=b - a)
        chunk.contexts(known)
        return chunk

    def send_contexts(batches):
        for row in _rows(batches):
            chunk = with_contexts(row)
            for k, (a, b) in chunk.pieces(chunk.keys, bits).items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([row["chunk"]], pa.int64()),
                     pa.array([pack(chunk.records[a:b])], pa.binary()),
                     pa.array([pack(chunk.least[a:b])], pa.binary())],
                    ["range", "chunk", "records", "least"])

    def answer(table: pa.Table) -> pa.Table:
        width = -(-(2 * length - ANCHOR + 2) // 8) * 8
        numbers = [unpack(x.as_py(), np.int64) for x in table["least"]]
        ends = np.cumsum([len(x) for x in numbers])
        records = np.empty((ends[-1], width), np.uint8)
        for end, own, packed in zip(ends, numbers, table["records"]):
            records[end - len(own):end] = unpack(packed.as_py(), np.uint8).reshape(-1, width)
        lowest, runs = answer_contexts(records, np.concatenate(numbers), length)
        edges = ends[:-1]
        return pa.table(
            [table["range"], table["chunk"],
             pa.array([pack(x) for x in np.split(lowest, edges)], pa.binary()),
             pa.array([pack(x) for x in np.split(runs, edges)], pa.binary())],
            ["range", "chunk", "lowest", "runs"])

    # the answers of a chunk are far smaller than its text, so they are hashed and no text is sorted
    asked = chunks.join(shared.hint("shuffle_hash"), "chunk").mapInArrow(
        send_contexts, "range int, chunk bigint, records binary, least binary")
    answers = asked.groupBy("range").applyInArrow(
        answer, "range int, chunk bigint, lowest binary, runs binary")
    answers = save(answers.groupBy("chunk").agg(
        F.collect_list(F.struct("range", "lowest", "runs")).alias("answers")), "answers")

    def mark(batches):
        for row in _rows(batches):
            chunk = with_contexts(row)
            pieces = chunk.pieces(chunk.keys, bits)
            lowest, runs = np.zeros(len(chunk.keys), np.int64), np.zeros(len(chunk.keys), np.uint64)
            for got in row["answers"] or []:
                a, b = pieces[got["range"]]
                lowest[a:b], runs[a:b] = unpack(got["lowest"], np.int64), unpack(got["runs"], np.uint64)
            gone = chunk.removed(lowest, runs)
            spans, kept = [], []
            for a, b in zip(chunk.starts.tolist(), chunk.stops.tolist()):
                edges = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0))
                spans.append([{"start": x, "stop": y} for x, y in edges.reshape(-1, 2).tolist()])
                kept.append(chunk.raw[a:b][~gone[a:b]].tobytes())
            span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["sizes"], pa.int64()),
                 pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])

    told = shared.join(answers, "chunk", "full").hint("shuffle_hash")
    return chunks.join(told, "chunk", "left").mapInArrow(
        mark, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary")
