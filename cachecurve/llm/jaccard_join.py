"""Jaccard self-join on word shingles by token-combination prefixes, as link classes.

A document's set holds the 64-bit hashes of its distinct runs of ``gram`` words. Two sets
link when ``100 * shared >= percent * union`` (80 or more). A set of n may then lack at most
``e = n - ceil(percent * n / 100)`` tokens of a partner, which is what a prefix has to outlast.
Equal sets are one node from the start.

Sifting. The *zone* of a set is its tokens below a fixed share of the hash space, 1.6 times the share
that a set may lack. All zones together tell exactly which of their tokens only one node has. A
node with more than e of these has no partner and goes, and so do its tokens: what it shared
may then be alone elsewhere, so a second pass sifts the rest. Most documents without copies end
here, shared passages or not. Grouping by token combines on the map side, so a hot token is no large group.

Signatures. Tokens of the rest are in one global order: those alone, then rare ones (few nodes
have them), then frequent ones, in two classes, by hash within a class; tokens outside the zone are in the
first frequent class. A prefix takes tokens until its *units* exceed e: a token that is alone is a unit without a
signature, a rare token a unit and a signature by itself; frequent tokens are split by hash into small subclasses, and c of
them in a subclass of k-token combinations give ``c - k + 1`` units and all their combinations as
signatures. To take every combination of a subclass from a partner one must take that many of
its tokens, so linked sets share a signature; extending the prefix is what pays for the rarer
combinations. The number of subclasses follows the size of a set in steps of about 15 %; a set
makes combinations for its own step and the next, so that linked sets meet in one step. Subclasses are
large enough for the units of any set to suffice, whatever the classes of its tokens.

Links. Signatures with the same nodes are one. For each signature all nodes meet its least node
first; those pairs are verified exactly and joined into components. Before token sets are
joined, a parity sketch of each set (512 bits, every token flips one) drops pairs that cannot link:
bits in which two sketches differ are at most the tokens that the sets do not share. Signatures
whose nodes are by then in one component need nothing more: that is what becomes of a large
group of near copies, at one pair a node instead of all pairs. The rest goes through two more such rounds with
other meeting points, and finally all pairs in different components whose sketches allow a
link are verified; a pair that shares many signatures is named at the first of them, and hardly again. A pair inside a component cannot change
the classes, so no link between different texts is lost.

Results: one row a document: ``doc_id n_shingles component_id``. Fewer words than ``gram`` are
one shingle; null, empty and blank texts have none and link with nothing. Repeated rows
are equal sets. Null ids sort last and are named only if nothing else is in the class. Columns
other than ``doc_id text`` are not read, whatever their names. An
empty table gives an empty result. Two different sets are taken for equal, two shingles, or two
signatures' nodes, with odds of 2**-64 a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachecurve.scratch import save

#: Nodes that may have a rare token; the second frequent class has fifty times as many.
RARE, TRIPLES = 64, 50 * 64
#: Tokens of a subclass on average, for combinations of two and of three tokens.
SUBCLASS = {2: 4, 3: 6}
#: Share of the hash space in the zone, as a multiple of the share of tokens that a set may lack.
ZONE = 1.6
#: Passes that drop nodes with too many tokens of their own.
SIFTS = 2
ROUNDS = 3
#: Signatures of a node that are looked back at, to name a pair once and not for each that it shares.
BEFORE = 8
#: Rows of two numbers that are few enough to broadcast.
BROADCAST_ROWS = 500_000
#: Columns of a parity sketch, of 64 bits each.
SKETCH = [f"s{i}" for i in range(8)]
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _LAST
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are remembered for a while."""

    def __init__(self, gram: int, most: int = 400_000):
        self.gram, self.most, self.known = gram, most, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        known = self.known
        if len(known) > self.most:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(codes):
            return codes
        gram = min(self.gram, len(codes))
        runs = len(codes) - gram + 1
        mixed = np.full(runs, gram, np.uint64)
        for i in range(gram):
            mixed = mix(mixed * _MIX + codes[i:i + runs])
        return np.unique(mixed)


def allowed(n: int, percent: int) -> int:
    """Tokens that a set of n may lack of a linked set."""
    return n - -(-percent * n // 100)


def size_step(n: int, percent: int) -> int:
    """Linked sets are at most one step apart; a little slack covers rounding."""
    return int(math.log(n) / -math.log(percent / 100 - 1e-3))


def step_size(step: int, percent: int) -> int:
    return max(1, int((percent / 100 - 1e-3) ** -step))


def zone_end(percent: int) -> np.uint64:
    """The hash below which a token is in the zone."""
    return np.uint64(int((1 << 64) * ZONE * (100 - percent) / 100))


def prefix(tokens: np.ndarray, level: np.ndarray, percent: int) -> list[int]:
    """Signatures of a set of sorted hashes. ``level`` of a token: 0 alone, 1 rare, else the length
    of its combinations."""
    need = allowed(len(tokens), percent) + 1 - int((level == 0).sum())
    rare = tokens[level == 1]
    found = rare[:max(need, 0)].tolist()
    if len(rare) >= need:
        return found
    step = size_step(len(tokens), percent)
    for own in (step, step + 1):
        size = step_size(own, percent)
        units = len(rare)
        for k in (2, 3):
            part = tokens[level == k]
            if units >= need or not len(part):
                continue
            groups = max(1, size // SUBCLASS[k])
            group = (mix(part * _MIX) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")  # in a subclass by hash, the global order
            seen = np.empty(len(part), np.int64)
            starts = np.flatnonzero(np.diff(group[order], prepend=-1))
            seen[order] = np.arange(len(part)) - np.repeat(
                starts, np.diff(np.append(starts, len(part))))
            gain = np.cumsum(seen >= k - 1)  # a unit for each token after the first k - 1
            taken = int(np.searchsorted(gain, need - units)) + 1
            units += int(gain[min(taken, len(part)) - 1])
            members: dict[int, list[int]] = {}
            for g, token in zip(group[:taken].tolist(), part[:taken].tolist()):
                members.setdefault(g, []).append(token)
            sets = [c for m in members.values() if len(m) >= k for c in combinations(m, k)]
            if sets:
                mixed = np.full(len(sets), (own << 8) + k, np.uint64)
                for column in np.array(sets, np.uint64).T:
                    mixed = mix(mixed * _MIX + column)
                found += mixed.tolist()
        if units < need:
            raise ValueError("the units of a prefix do not suffice")
    return found


def set_key(tokens: np.ndarray) -> int:
    """One hash for a whole set; 0 for the empty one."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) if len(tokens) else 0


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """The parities of how many tokens fall on each of 512 bits."""
    places = (tokens >> np.uint64(55)).astype(np.int64)
    odd = np.bincount(places, minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64), pa.int64())


def describe_sets(docs: DataFrame, gram: int, percent: int) -> DataFrame:
    """``doc_id node n zone`` and the sketch of every document; ``zone`` is null where a task has seen the
    set before, and for sets so small that only equal ones would link."""
    end = zone_end(percent)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingler(gram), set()
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            keys, zones = [set_key(s) for s in sets], []
            for key, tokens in zip(keys, sets):
                new = key not in seen and len(tokens) * (100 - percent) >= percent
                zones.append(tokens[:np.searchsorted(tokens, end)].view(np.int64) if new else None)
                seen.add(key)
            if len(seen) > 1_000_000:
                seen.clear()
            sketches = np.array([parity_sketch(s) for s in sets], np.int64).reshape(-1, len(SKETCH))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _signed(keys), pa.array([len(s) for s in sets], pa.int64()),
                 *map(pa.array, sketches.T.copy()), pa.array(zones, pa.list_(pa.int64()))],
                ["doc_id", "node", "n", *SKETCH, "zone"])

    sketch = "".join(f"{c} bigint, " for c in SKETCH)
    return save(docs.mapInArrow(described, f"doc_id bigint, node bigint, n bigint, {sketch}"
                                           "zone array<bigint>"), "sets")


def few(nodes: DataFrame) -> DataFrame:
    """A saved table of one or two numbers a row, to be broadcast if a count shows that it is small."""
    return F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes


def sift(nodes: DataFrame, zones: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The nodes, and their zones, that do not have more tokens to themselves than a linked set may."""
    for _ in range(SIFTS):
        alone = zones.select("node", F.explode("zone").alias("token")) \
            .groupBy("token").agg(F.min("node").alias("node"), F.max("node").alias("high")) \
            .where("node = high").groupBy("node").agg(F.count("*").alias("alone"))
        nodes = save(nodes.join(alone, "node", "left")
                     .where(f"coalesce(alone, 0) <= n * {100 - percent} div 100").drop("alone"), "nodes")
        zones = save(zones.join(few(nodes.select("node")), "node", "left_semi"), "zones")
    return nodes, zones


def token_counts(zones: DataFrame) -> DataFrame:
    """``node listed``: the zone's tokens that other nodes have too, and how many nodes have them."""
    tokens = zones.dropDuplicates(["node"]).select("node", F.explode("zone").alias("token"))
    times = tokens.groupBy("token").agg(F.count("*").alias("times")).where("times > 1")
    return tokens.join(times, "token").groupBy("node").agg(
        F.collect_list(F.struct("token", "times")).alias("listed"))


def make_postings(sets: DataFrame, listed: DataFrame, percent: int) -> DataFrame:
    """``sig node`` of every set."""
    end = zone_end(percent)

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for i, node in enumerate(batch.column(0).to_pylist()):
                tokens = batch.column(1)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                level = np.where(tokens < end, 0, 2)
                shared, times = batch.column(2)[i], batch.column(3)[i]
                if shared.is_valid:
                    times = times.values.to_numpy(zero_copy_only=False)
                    places = np.searchsorted(tokens, shared.values.to_numpy(zero_copy_only=False).view(np.uint64))
                    level[places] = 1 + (times > RARE) + (times > TRIPLES)
                found = np.array(prefix(tokens, level, percent), np.uint64)
                sigs.append(found)
                nodes.append(np.full(len(found), node, np.int64))
            yield pa.RecordBatch.from_arrays(
                [_signed(np.concatenate(sigs)), pa.array(np.concatenate(nodes))], ["sig", "node"])

    return sets.join(listed, "node", "left").select("node", "tokens", "listed.token", "listed.times") \
        .mapInArrow(posted, "sig bigint, node bigint")


def meet_nodes(postings: DataFrame) -> DataFrame:
    """``sig low node``: the nodes of each signature and the least of them, without signatures of one
    node and with one signature for each set of nodes."""
    postings = save(postings, "postings")
    code = F.xxhash64("node")
    lists = postings.groupBy("sig").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("times"),
        F.sum(F.shiftrightunsigned(code, 32)).alias("upper"),
        F.sum(code.bitwiseAND(F.lit(0xFFFFFFFF))).alias("lower")).where("low < high")
    first = lists.groupBy("low", "high", "times", "upper", "lower").agg(F.min("sig").alias("sig"))
    return save(postings.join(first.select("sig", "low"), "sig").distinct(), "lists")


def node_sets(docs: DataFrame, nodes: DataFrame, gram: int) -> DataFrame:
    """``node tokens`` of the wanted nodes, from the text of one document each."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, done = Shingler(gram), set()
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = shingles(text)
                if np.uint64(set_key(tokens)).view(np.int64) == node and node not in done:
                    done.add(node)  # repeated ids: only the text of this node
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([node], pa.int64()),
                         pa.array([tokens.view(np.int64)], pa.list_(pa.int64()))],
                        ["node", "tokens"])

    nodes = few(nodes)  # else the texts go to the nodes by id
    wanted = docs.join(nodes, docs["doc_id"].eqNullSafe(nodes["least_doc"])).select("node", "text")
    return wanted.mapInArrow(built, "node bigint, tokens array<bigint>")


def near_sketches(x: str, y: str, percent: int) -> Column:
    """Whether sketches differ in no more bits than linked sets differ in tokens, and sizes as
    little. The columns of a
    set are ``n`` and those of its sketch, with ``x`` or ``y`` added to their names."""
    differ = sum((F.bit_count(F.col(c + x).bitwiseXOR(F.col(c + y))) for c in SKETCH), F.lit(0))
    near = differ * (100 + percent) <= (F.col("n" + x) + F.col("n" + y)) * (100 - percent)
    return near & (F.least("n" + x, "n" + y) * 100 >= F.greatest("n" + x, "n" + y) * percent)


def all_pairs(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``x y``, with their sizes and components) of different components that share a signature
    of ``lists`` (``sig node n comp``) and may link.

    Sets that share a passage share most of its signatures. A pair leaves the join only at
    signatures before which the two have none in common among the last BEFORE of each: always at the
    first one that they share, and seldom again. Sketches travel along, so that only pairs that may link leave.
    """
    before = F.collect_list("sig").over(Window.partitionBy("node").orderBy("sig").rowsBetween(-BEFORE, -1))
    rest = lists.join(nodes.select("node", *SKETCH), "node").withColumn("before", before)
    one, two = (rest.select("sig", F.col("node").alias(side), F.col("comp").alias("c" + side),
                            *(F.col(c).alias(c + side) for c in ("n", "before", *SKETCH))) for side in "xy")
    return one.join(two, (one["sig"] == two["sig"]) & (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy"))
                    & near_sketches("x", "y", percent) & ~F.arrays_overlap("beforex", "beforey")) \
        .select("x", "nx", "cx", "y", "ny", "cy")


def may_link(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a b``) whose sketches allow a link."""
    left, right = (nodes.select(F.col("node").alias(side), *(F.col(c).alias(c + side) for c in ("n", *SKETCH)))
                   for side in "ab")
    return pairs.join(left, "a").join(right, "b").where(near_sketches("a", "b", percent)).select("a", "b")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a b``) of nodes that link, by the exact size of their intersection."""
    used = save(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "used")
    sets = sets.join(few(used), "node", "left_semi")
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - F.col("shared")
    return both.select("a", "b", shared.alias("shared"), "left", "right") \
        .where(F.col("shared") * 100 >= union * percent).select("a", "b")


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``node comp`` of all nodes with a link: those of ``labels``, joined by the links (``a b``); ``comp``
    is one of the nodes.

    Each round merges every vertex into the one of least digest beside it or itself, and
    what is left are the links between different ones, so rounds shrink by a factor and a large
    component is not joined with itself again.
    """
    one, two = (labels.select(F.col("node").alias(side), F.col("comp").alias("c" + side)) for side in "ab")
    ends = links.join(one, "a", "left").join(two, "b", "left") \
        .select(F.coalesce("ca", "a").alias("x"), F.coalesce("cb", "b").alias("y"))
    edges = save(ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y")))
                 .where("x <> y").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        turn = F.lit(len(rounds))
        beside = F.min(F.struct(F.xxhash64("y", turn).alias("code"), "y")).alias("beside")
        merged = save(edges.groupBy("x").agg(beside).select("x", F.least(
            F.struct(F.xxhash64("x", turn).alias("code"), F.col("x").alias("y")), "beside")["y"].alias("comp")),
            "merged")
        rounds.append(merged)
        left, right = (merged.select(F.col("x").alias(side), F.col("comp").alias("c" + side)) for side in "xy")
        edges = save(edges.join(left, "x").join(right, "y").where("cx <> cy")
                     .select(F.col("cx").alias("x"), F.col("cy").alias("y")).distinct(), "edges")
    if not rounds:
        return labels
    named = rounds.pop()
    while rounds:
        up = named.select(F.col("x").alias("up"), F.col("comp").alias("top"))
        own = rounds.pop()
        named = own.join(up, own["comp"] == up["up"], "left").select("x", F.coalesce("top", "comp").alias("comp"))
    named = save(named, "named")
    new = named.join(labels, named["x"] == labels["node"], "left_anti").select(F.col("x").alias("node"), "comp")
    up = named.select("x", F.col("comp").alias("top"))
    return save(labels.join(up, labels["comp"] == up["x"], "left")
                .select("node", F.coalesce("top", "comp").alias("comp")).unionByName(new), "labels")


def link_classes(docs: DataFrame, gram: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id n_shingles component_id`` of every row of ``doc_id text``."""
    if not 80 <= percent <= 100:
        raise ValueError("percent is 80 to 100")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = describe_sets(docs, gram, percent)
    nodes = rows.where(f"n * {100 - percent} >= {percent}").groupBy("node", "n").agg(
        F.min("doc_id").alias("least_doc"), *(F.min(c).alias(c) for c in SKETCH))
    nodes, zones = sift(nodes, rows.where("zone is not null").select("node", "zone"), percent)
    sets = save(node_sets(docs, nodes.select("node", "least_doc"), gram), "tokens")
    lists = meet_nodes(make_postings(sets, token_counts(zones), percent))
    labels = spark.createDataFrame([], "node bigint, comp bigint")
    done = None

    for turn in range(ROUNDS + 1):
        if not turn:
            met = lists.select(F.col("low").alias("x"), F.col("node").alias("y")).where("x <> y")
        else:
            known = nodes.select("node", "n").join(labels, "node", "left") \
                .withColumn("comp", F.coalesce("comp", "node"))
            placed = lists.select("sig", "node").join(known, "node")
            open_sigs = placed.groupBy("sig").agg(
                F.min("comp").alias("low"), F.max("comp").alias("high"),
                F.min_by(F.struct("node", "n", "comp"), F.xxhash64("node", F.lit(turn))).alias("meet")) \
                .where("low < high").select("sig", "meet")
            lists = save(placed.join(open_sigs, "sig"), "lists")  # what is closed stays so
            if turn < ROUNDS:
                met = lists.select(
                    F.col("meet.node").alias("x"), F.col("meet.n").alias("nx"), F.col("meet.comp").alias("cx"),
                    F.col("node").alias("y"), F.col("n").alias("ny"), F.col("comp").alias("cy"))
            else:
                met = all_pairs(lists, nodes, percent)
            met = met.where((F.col("cx") != F.col("cy"))
                            & (F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent))
        pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = save(may_link(pairs, nodes, percent), "pairs")
        if pairs.isEmpty():
            # an empty round says nothing of pairs that did not meet: only the last takes all of them
            continue
        done = pairs if done is None else done.unionByName(pairs)
        labels = components(save(verify(pairs, sets, percent), "links"), labels)

    named = rows.join(labels, "node", "left").withColumn(
        "comp", F.when(F.col("n") > 0, F.coalesce("comp", "node")))
    names = named.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return named.join(names, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
