"""Exact LRU stack distance, in objects and bytes.

With accesses at dense positions, ``p(i)`` the previous access of the same object
and ``w`` its size, the objects touched between ``p(i)`` and ``i`` are

    objects(i) = (i - p(i) - 1) - N(i)     N(i) = #{j < i : p(j) > p(i)}
    bytes(i)   = sum of w over (p(i), i) - the w of the same pairs j

and the distance adds the object itself unless nothing lies between. Shards lie end
to end, so a pair of a later shard never nests around one of an earlier shard and
the shard needs no place in the computation. N(i) falls into three disjoint parts by
slice (``q`` = slice of p, ``s`` = slice of the access):

1. j in slice s too: counted inside slice s;
2. j in an earlier slice, p(j) in slice q: counted inside slice q;
3. j in an earlier slice, p(j) in a later slice than q: a sum over (q, s) cells.

1 and 2 work on one slice at a time, at most ``slice_rows`` rows, and the slice reads
3 from its cells. 3 works on the counts per cell: all cells of all slices are laid out, those without rows as
zeros, and summed over the earlier s of each q and then over the later q of each s.
Slices grow with the square root of the rows, so cells stay far fewer than rows.

All parts are additive, so a histogram can sum them without bringing the parts of
one request together. Byte sums over many slices pass 2**63, so they are kept in two
halves, ``hi * 2**32 + lo``; only a distance itself must fit a bigint.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.operators.sequence import slice_bits
from cachecurve.scratch import save

_PART_SCHEMA = "at bigint, shard int, t int, objects bigint, hi bigint, lo bigint"
_NONE = -1
_LOW = (1 << 32) - 1


def nested_before(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element, number and weight of the earlier elements of greater value.

    Values are distinct; ``weights`` has a row for each kind of weight, and so has the
    result. Indexes, padded to a power of two, are taken by falling value
    and split by their bits, highest first. Each block then holds one aligned range of
    indexes, its lower half precedes its upper half in the input, and what stands before
    an upper index within the block is greater.
    """
    n = len(values)
    bits = max(n - 1, 0).bit_length()
    width = 1 << bits
    order = np.concatenate((np.argsort(values)[::-1], np.arange(n, width)))
    weights = np.concatenate((weights, np.zeros((len(weights), width - n), np.int64)), axis=1)
    counts = np.zeros(width, np.int64)
    sums = np.zeros((len(weights), width), np.int64)
    for bit in range(bits - 1, -1, -1):
        half = 1 << bit
        blocks = width >> (bit + 1)
        is_upper = (order & half) != 0
        at = np.flatnonzero(is_upper)
        upper, lower = order[at], order[~is_upper]
        greater = (at & (2 * half - 1)) - (np.arange(len(at)) & (half - 1))
        counts[upper] += greater
        running = np.zeros((blocks, half + 1), np.int64)
        for weight, total in zip(weights, sums):
            np.cumsum(weight[lower].reshape(blocks, half), axis=1, out=running[:, 1:])
            total[upper] += running.ravel()[np.repeat(np.arange(blocks) * (half + 1), half) + greater]
        order = np.concatenate((lower.reshape(blocks, half), upper.reshape(blocks, half)),
                               axis=1).ravel()
    return counts[:n], sums[:, :n]


def limbs(weights: np.ndarray) -> np.ndarray:
    """The weights as rows whose sums over all of them fit 64 bits: themselves, or their lower
    and upper 32 bits."""
    if len(weights) * int(weights.max(initial=0)) < 1 << 62:
        return weights[None, :]
    return np.stack((weights & _LOW, weights >> 32))


def halves(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower half of sums of ``limbs``."""
    high = sums[0] >> 32
    return high if len(sums) == 1 else high + sums[1], sums[0] & _LOW


def _slice_parts(bits: int) -> Callable[..., pd.DataFrame]:
    def parts(rows: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame([], columns=["at", "shard", "t", "objects", "hi", "lo"])
        rows = rows.sort_values("pos")
        pos, prev, nxt, weight, shard, t, next_t = (
            rows[c].to_numpy() for c in ("pos", "prev", "nxt", "w", "shard", "t", "next_t"))
        weight = limbs(weight)
        running = np.cumsum(weight, axis=1)
        first = (pos[0] >> bits) << bits

        # Accesses of this slice that look back.
        back = np.flatnonzero(prev != _NONE)
        i, p, own_weight = pos[back], prev[back], weight[:, back]
        inner, inner_w = nested_before(p, own_weight)
        apart = i != p + 1
        objects = i - p - 1 - inner + apart
        size = running[:, back] - own_weight - inner_w + apart * own_weight
        here = np.flatnonzero(p >= first)
        size[:, here] -= running[:, np.searchsorted(pos, p[here])]
        high, low = halves(size)
        far = np.flatnonzero(p < first)
        if len(far):
            cells = cells.sort_values("q")
            cell = np.searchsorted(cells["q"].to_numpy(), p[far] >> bits)
            objects[far] += cells["objects"].to_numpy()[cell]
            high[far] += cells["hi"].to_numpy()[cell]
            low[far] += cells["lo"].to_numpy()[cell]
        own = pd.DataFrame({"at": i, "shard": shard[back], "t": t[back], "objects": objects,
                            "hi": high, "lo": low})

        # Accesses of this slice that are looked back to from a later slice.
        if (nxt >> bits).max() <= first >> bits:
            return own
        ahead = np.flatnonzero(nxt != _NONE)
        ahead = ahead[np.lexsort((pos[ahead], nxt[ahead] >> bits))]
        outer, outer_w = nested_before(pos[ahead], weight[:, ahead])
        leaves = (nxt[ahead] >> bits) > (first >> bits)
        k = ahead[leaves]
        high, low = halves(-outer_w[:, leaves] - running[:, k])
        passed = pd.DataFrame({"at": nxt[k], "shard": shard[k], "t": next_t[k],
                               "objects": -outer[leaves], "hi": high, "lo": low})
        return pd.concat([own, passed], ignore_index=True)

    return parts


def high_half(column: str) -> Column:
    return F.shiftright(column, 32)


def low_half(column: str) -> Column:
    return F.col(column).bitwiseAND(F.lit(_LOW))


def carried(rows: DataFrame, high: str, low: str) -> DataFrame:
    """The same numbers with a lower half of 32 bits, so that sums of it have room."""
    return rows.withColumns({high: F.col(high) + high_half(low), low: low_half(low)})


def wide_sum(high: Column, low: Column) -> Column:
    """A sum of halves as a decimal of any size."""
    return F.sum(high).cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.sum(low).cast("decimal(38,0)")


def _cells(linked: DataFrame, bits: int) -> DataFrame:
    """Requests and weight per (slice of the previous access, slice of the access); first
    accesses have no ``q``, so the weight of a slice is the sum over all its ``q``."""
    cells = linked.groupBy(F.shiftright("prev_pos", bits).alias("q"), F.col("slice").alias("s")).agg(
        F.count("*").alias("n"), F.sum(high_half("obj_size")).alias("hi"),
        F.sum(low_half("obj_size")).alias("lo"))
    return save(carried(cells, "hi", "lo"), "cells")


def cell_base(linked: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """What every re-reference of a cell (q, s), q < s, has in common: the weight of
    slices q to s - 1 and, taken off, the sums of part 3.

    Two windows over the laid-out cells, each over as many rows as there are slices. The cells are read twice and saved,
    being far smaller than the accesses.
    """
    cells = _cells(linked, slice_bits(cfg))
    weights = carried(cells.groupBy("s").agg(F.sum("hi").alias("whi"), F.sum("lo").alias("wlo")), "whi", "wlo")
    zero = F.lit(0).cast("bigint")
    laid = weights.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("s"))).alias("q"), "s",
                          zero.alias("n"), zero.alias("hi"), zero.alias("lo"), "whi", "wlo")
    taken = cells.where("q is not null").select("q", "s", "n", "hi", "lo", zero.alias("whi"), zero.alias("wlo"))
    names = ("n", "hi", "lo", "whi", "wlo")
    grid = laid.unionByName(taken).repartition("q").groupBy("q", "s").agg(*[F.sum(c).alias(c) for c in names])

    earlier = Window.partitionBy("q").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.select("q", "s", (F.col("n") > 0).alias("met"),
                       *[F.coalesce(F.sum(c).over(earlier), zero).alias(c) for c in names])
    later = Window.partitionBy("s").orderBy(F.desc("q")).rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(later), zero).alias(f"{c}_later") for c in ("n", "hi", "lo")]
    return carried(grid, "hi", "lo").select("q", "s", "met", "whi", "wlo", *sums) \
        .where("met and q < s").select(
        F.col("s").alias("slice"), "q", (-F.col("n_later")).alias("objects"),
        (F.col("whi") - F.col("hi_later")).alias("hi"), (F.col("wlo") - F.col("lo_later")).alias("lo"))


def distance_parts(linked: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """Additive parts of the distances: the sum over ``at`` (the position of the
    re-reference) of ``objects``, and of ``hi`` and ``lo``, is its stack distance.

    A slice meets at most as many cells as it has accesses.
    """

    def known(name: str):
        return F.coalesce(name, F.lit(_NONE))

    per_slice = linked.select(
        "slice", "pos", known("prev_pos").alias("prev"), known("next_pos").alias("nxt"),
        F.col("obj_size").alias("w"), "shard", known("t").alias("t"),
        known("next_t").alias("next_t")).groupBy("slice")
    return per_slice.cogroup(cell_base(linked, cfg).groupBy("slice")) \
        .applyInPandas(_slice_parts(slice_bits(cfg)), _PART_SCHEMA)


def stack_distance(parts: DataFrame) -> DataFrame:
    """Distance of every re-reference, counted in the statistics or not."""
    sums = carried(parts.groupBy(F.col("at").alias("pos")).agg(
        F.sum("objects").alias("dist_objects"), F.sum("hi").alias("hi"), F.sum("lo").alias("lo")), "hi", "lo")
    fits = F.col("hi").between(-(1 << 31), (1 << 31) - 1)
    too_large = F.raise_error(F.lit("a byte distance exceeds 64 bits")).cast("bigint")
    return sums.select("pos", "dist_objects", F.when(
        fits, F.shiftleft("hi", 32).bitwiseOR(F.col("lo"))).otherwise(too_large).alias("dist_bytes"))
