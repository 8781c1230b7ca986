"""Totals, histograms and the descriptor tables of every shard.

Every aggregate groups by shard and something finer, or combines map-side, so one
dominant shard does not end up in one task. Only the curve itself is walked shard by
shard, and a curve has at most one row per second of the horizon.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachecurve.config import SIZE_UNIT, TRAFFIC_BUCKET_S, FootprintConfig
from cachecurve.functions.columns import shortfall
from cachecurve.operators.distance import wide_sum
from cachecurve.operators.filters import add_sample_buckets
from cachecurve.operators.route import add_labels, label_map_network
from cachecurve.operators.sequence import copy_side

_WIDE = "decimal(38,0)"
#: Seconds of a block of a curve, as a power of two.
RATE_BLOCK_BITS = 12


def _sum_if(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


# --- request level totals ---------------------------------------------------------------


def served_totals(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """Requests and bytes after prewarm, the largest request count and byte sum of any
    300 s bucket (each on its own), and what bypassed the stack.

    Sums per bucket first, which both bounds what a shard brings together and serves
    the peaks in the same pass.
    """
    counted = ~F.col("prewarm")
    bucket = F.floor((F.col("ts") - F.col("first_ts")) / TRAFFIC_BUCKET_S)
    buckets = requests.groupBy("shard", bucket.alias("bucket")).agg(
        _count_if(counted).alias("requests"),
        _sum_if(counted, F.col("bytes")).alias("bytes"),
        _count_if(F.col("bypass")).alias("bypass_requests"),
        _sum_if(F.col("bypass"), F.col("size")).alias("bypass_bytes"),
        _sum_if(F.col("bypass"), shortfall(F.col("size"), F.col("bytes")))
        .alias("bypass_inflation"))
    sums = ["requests", "bytes", "bypass_requests", "bypass_bytes", "bypass_inflation"]
    unfilled = F.lit(0).cast("bigint")
    peaks = [unfilled if cfg.parity else F.max(c) for c in ("requests", "bytes")]
    return buckets.groupBy("shard").agg(
        *[F.sum(c).alias(c) for c in sums],
        peaks[0].alias("peak_requests"), peaks[1].alias("peak_bytes"))


def stack_totals(linked: DataFrame) -> DataFrame:
    """Inflation, inserted bytes, active footprint and re-references of a shard."""
    first = F.col("prev_pos").isNull()
    counted = ~F.col("prewarm")
    sampled = F.col("t").isNotNull()
    active = F.col("next_pos").isNull() & (F.col("ts") > F.col("compute_start"))
    return linked.groupBy("shard").agg(
        _sum_if((first & counted) | sampled, F.col("inflation")).alias("stack_inflation"),
        _sum_if(first & counted, F.col("size")).alias("inserted_bytes"),
        _count_if(active).alias("active_objects"),
        _sum_if(active, F.col("obj_size")).alias("active_bytes"),
        _count_if(sampled).alias("rereferences"))


def skipped_totals(ordered: DataFrame) -> DataFrame:
    """Requests and bytes sampled out at this stage, after prewarm."""
    rows = ordered.where("sampled_out and size > 0")
    return rows.where(F.col("ts").cast("bigint") >= F.col("compute_start")).groupBy("shard").agg(
        F.count("*").alias("skipped_requests"), F.sum("bytes").alias("skipped_bytes"))


def distinct_objects(ordered: DataFrame) -> DataFrame:
    """Distinct digests of a shard over all its requests, empty ones included."""
    return ordered.select("shard", "obj").distinct().groupBy("shard") \
        .agg(F.count("*").alias("distinct_objects"))


def serial_info(requests: DataFrame, linked: DataFrame) -> DataFrame:
    """Requests, bytes and new objects of every original serial after prewarm.

    An object is new to the statistics when it was not in the stack or was last
    touched in the prewarm phase; each bypassed request is.
    """
    keys = ["shard", F.col("true_serial").alias("serial")]
    counted = requests.where(~F.col("prewarm")).select(
        *keys, F.lit(1).alias("n"), "bytes",
        F.col("bypass").cast("int").alias("u"), F.when(F.col("bypass"), F.col("size"))
        .otherwise(0).alias("ub"))
    fresh = F.col("prev_ts").isNull() | (F.col("prev_ts").cast("bigint") < F.col("compute_start"))
    new = linked.where(~F.col("prewarm") & fresh).select(
        *keys, F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("bytes"),
        F.lit(1).alias("u"), F.col("size").alias("ub"))
    return counted.unionByName(new).groupBy("shard", "serial").agg(
        F.sum("n").alias("requests"), F.sum("bytes").alias("bytes"),
        F.sum("u").alias("unique_objects"), F.sum("ub").alias("unique_bytes"))


# --- object level -----------------------------------------------------------------------


def object_intervals(linked: DataFrame) -> DataFrame:
    """Mean reuse interval of every object in whole seconds and whether its requests,
    thrown at two servers, reached both."""
    seen = linked.where(~F.col("prewarm") & F.col("in_horizon"))
    side = copy_side(F.col("obj"), F.col("seq"))
    return seen.groupBy("shard", "obj").agg(
        F.sum(F.coalesce("interval_s", F.lit(0))).alias("interval_sum"),
        F.count("*").alias("accesses"),
        F.max("obj_size").alias("obj_size"),
        F.min(side).alias("_low"), F.max(side).alias("_high")) \
        .select("shard", "obj", "interval_sum", "accesses", "obj_size",
                F.expr("interval_sum div accesses").alias("mean_interval"),
                (F.col("_low") < F.col("_high")).alias("two_copies"))


def copy_transitions(intervals: DataFrame) -> DataFrame:
    """Extra bytes and requests of a second copy, at the objects' mean interval."""
    return intervals.where("two_copies").groupBy(
        "shard", F.col("mean_interval").cast("int").alias("t")).agg(
        F.sum("obj_size").alias("transition_bytes"), F.count("*").alias("transition_requests"))


# --- histogram and curve ----------------------------------------------------------------


def reuse_histogram(linked: DataFrame, parts: DataFrame) -> DataFrame:
    """Sums per shard and second of reuse interval.

    Request sums and distance parts are added in one aggregation, so no row carries
    its distance through a shuffle.
    """
    zero = F.lit(0).cast("bigint")
    requests = linked.where("t is not null").select(
        "shard", "t", F.lit(1).cast("bigint").alias("requests"),
        F.col("stale").cast("bigint").alias("stale"), "bytes", "inflation",
        zero.alias("dist_objects"), zero.alias("hi"), zero.alias("lo"))
    distances = parts.where("t >= 0").select(
        "shard", "t", zero.alias("requests"), zero.alias("stale"), zero.alias("bytes"),
        zero.alias("inflation"), F.col("objects").alias("dist_objects"), "hi", "lo")
    return requests.unionByName(distances).groupBy("shard", "t").agg(
        F.sum("requests").alias("requests"), F.sum("stale").alias("stale"),
        F.sum("bytes").alias("bytes"), F.sum("inflation").alias("inflation"),
        F.sum("dist_objects").alias("dist_objects"),
        wide_sum(F.col("hi"), F.col("lo")).cast(_WIDE).alias("dist_bytes"))


def mean_distance(histogram: DataFrame) -> DataFrame:
    """``std_mib`` and ``std_objects``: mean distance per second, rounded down."""
    return histogram.withColumns({
        "std_mib": F.expr(f"cast(dist_bytes div (requests * {SIZE_UNIT}) as bigint)"),
        "std_objects": F.expr("dist_objects div requests"),
    })


def raw_curve(histogram: DataFrame, transitions: DataFrame | None,
              cfg: FootprintConfig) -> DataFrame:
    """Unscaled, unthinned curve; the last second of the horizon is not part of it."""
    curve = mean_distance(histogram).where(F.col("t") < cfg.horizon_s - 1)
    requests = F.col("requests") - F.col("stale") if cfg.consider_ttl else F.col("requests")
    zero = F.lit(0).cast("bigint")
    if transitions is None:
        curve = curve.withColumns({"transition_bytes": zero, "transition_requests": zero})
    else:
        curve = curve.join(transitions, ["shard", "t"], "left")
    return curve.select(
        "shard", "t", "std_mib", "std_objects", requests.alias("requests"),
        (F.col("bytes") + F.col("inflation")).alias("bytes"),
        F.coalesce("transition_bytes", zero).alias("transition_bytes"),
        F.coalesce("transition_requests", zero).alias("transition_requests"))


def hit_rate_curve(curve: DataFrame, totals: DataFrame) -> DataFrame:
    """Request and byte hit rates in percent when objects are kept for ``t`` seconds.

    Sums run within blocks of seconds, so that a long curve spreads over tasks; what lies
    before a block comes from the few sums of the blocks of its shard.
    """
    rows = curve.select("shard", "t", "requests", "bytes",
                        F.shiftright("t", RATE_BLOCK_BITS).alias("_block"))
    earlier = Window.partitionBy("shard").orderBy("_block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("shard", "_block").agg(F.sum("requests").alias("n"), F.sum("bytes").alias("b"))
    zero = F.lit(0).cast("bigint")
    before = blocks.select("shard", "_block", F.coalesce(F.sum("n").over(earlier), zero).alias("_n_before"),
                           F.coalesce(F.sum("b").over(earlier), zero).alias("_b_before"))
    before = before.join(totals.select("shard", F.col("requests").alias("_n"),
                                       F.col("bytes").alias("_b")), "shard")
    upto = Window.partitionBy("shard", "_block").orderBy("t") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def share(column: str, start: str, whole: str) -> Column:
        return F.try_divide((F.sum(column).over(upto) + F.col(start)) * 100.0, F.col(whole))

    return rows.join(before, ["shard", "_block"]).select(
        "shard", "t", share("requests", "_n_before", "_n").alias("request_hit_pct"),
        share("bytes", "_b_before", "_b").alias("byte_hit_pct"))


_CARRIED = ["requests", "bytes", "transition_bytes", "transition_requests"]
_CURVE_COLUMNS = ["shard", "t", "std_mib", "std_objects", *_CARRIED]
_CURVE_SCHEMA = "shard int, t int, " + ", ".join(f"{c} bigint" for c in _CURVE_COLUMNS[2:])
#: Rows after a kept one that are looked at one by one before a search by ever longer steps.
_NEAR_ROWS = 6


def _first_that(passes: Callable[[int], bool], fails: int, guess: int) -> int:
    """The least number above ``fails`` that passes a test which all greater ones pass too."""
    if guess > fails and passes(guess):
        if not passes(guess - 1):
            return guess
        low, high = fails, guess
    else:
        low, high = max(guess, fails), max(guess, fails) + 1
        while not passes(high):
            low, high = high, 2 * high - fails + 1
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if passes(middle) else (middle, high)
    return high


def print_bounds(t: int, size: int, jump: float) -> tuple[int, int, int]:
    """What a row must reach to be kept after a kept row: the seconds, or the size from above,
    or the size from below (-1: it cannot)."""
    late = t + 1
    if t:
        late = _first_that(lambda v: (v - t) * 100.0 / t > jump, t, t + int(t * jump / 100.0) + 1)
    if not size:
        return late, 1, -1
    step = math.ceil(size * jump / 100.0)
    large = _first_that(lambda v: (v - size) * 100.0 / size >= jump, size, size + step)
    small = -1
    if 100.0 >= jump:
        small = size - _first_that(lambda v: v * 100.0 / size >= jump, 0, min(step, size))
    return late, large, small


def _next_kept(t: np.ndarray, size: np.ndarray, start: int, bounds: tuple[int, int, int]) -> int:
    """The first row from ``start`` on that reaches a bound, or the end. Seconds rise, so theirs is
    found by bisection; sizes before it are searched in steps that grow."""
    late, large, small = bounds
    stop = start + int(np.searchsorted(t[start:], late))
    at = min(start + _NEAR_ROWS, stop)
    for k, value in enumerate(size[start:at].tolist(), start):
        if value >= large or value <= small:
            return k
    step = 64
    while at < stop:
        part = size[at:min(at + step, stop)]
        reached = (part >= large) | (part <= small)
        k = int(reached.argmax())
        if reached[k]:
            return at + k
        at, step = at + step, 4 * step
    return stop


class _Thinner:
    """Walks the sorted rows of shards from kept row to kept row; between batches it holds the
    last kept row, the last row and the sums since."""

    def __init__(self, jump: float):
        self.jump = jump
        self.shard = None
        self.reset()

    def reset(self) -> None:
        self.bounds: tuple[int, int, int] | None = None
        self.last: tuple[int, ...] | None = None
        self.pending = np.zeros(len(_CARRIED), np.int64)

    def rest(self) -> list[np.ndarray]:
        """The last row of a shard, if anything has come since the kept one."""
        if self.last is None or self.pending[0] <= 0:
            return []
        return [np.array([[self.shard, *self.last, *self.pending]], np.int64)]

    def kept_rows(self, t: np.ndarray, size: np.ndarray) -> list[int]:
        found, at = [], 0
        if self.bounds is None:
            if 100.0 < self.jump:
                return []
            found.append(0)
        else:
            at = _next_kept(t, size, 0, self.bounds)
            if at == len(t):
                return []
            found.append(at)
        while True:
            k = found[-1]
            self.bounds = print_bounds(int(t[k]), int(size[k]), self.jump)
            at = _next_kept(t, size, k + 1, self.bounds)
            if at == len(t):
                return found
            found.append(at)

    def run(self, rows: np.ndarray) -> list[np.ndarray]:
        """Kept rows of neighbouring rows of one shard, with the sums since the kept one before."""
        kept = self.kept_rows(rows[:, 1], rows[:, 2])
        sums = np.concatenate((np.zeros((1, len(_CARRIED)), np.int64), np.cumsum(rows[:, 4:], axis=0)))
        marks = sums[[0, *(k + 1 for k in kept), len(rows)]]
        between = np.diff(marks, axis=0)
        between[0] += self.pending
        self.pending = between[-1]
        self.last = tuple(rows[-1, 1:4].tolist())
        return [np.column_stack((rows[kept, :4], between[:-1]))] if kept else []

    def batch(self, rows: np.ndarray) -> list[np.ndarray]:
        out = []
        borders = np.flatnonzero(np.diff(rows[:, 0])) + 1
        for part in np.split(rows, borders):
            if part[0, 0] != self.shard:
                out += self.rest()
                self.shard = int(part[0, 0])
                self.reset()
            out += self.run(part)
        return out


def _thin(jump: float):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        thinner = _Thinner(jump)

        def made(parts: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate([np.empty((0, len(_CURVE_COLUMNS)), np.int64), *parts])
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * (len(_CURVE_COLUMNS) - 2)]
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[:, k]).cast(kind) for k, kind in enumerate(kinds)], _CURVE_COLUMNS)

        for batch in batches:
            if batch.num_rows:
                yield made(thinner.batch(np.column_stack(
                    [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])))
        yield made(thinner.rest())

    return walk


def thin_curve(curve: DataFrame, jump: float) -> DataFrame:
    """Drop rows that change little against the last kept one; what they held goes
    to the next kept row, and the last row of a shard keeps the remainder.

    The walk is sequential by definition. It reads aggregated curves, sorted within
    a task, goes from kept row to kept row, and holds one row per shard.
    """
    if jump <= 0:
        return curve.select(*_CURVE_COLUMNS)
    return curve.select(*_CURVE_COLUMNS).repartition("shard").sortWithinPartitions("shard", "t") \
        .mapInArrow(_thin(jump), _CURVE_SCHEMA)


# --- shard rows, scaling and output -----------------------------------------------------


def shard_summary(facts: DataFrame, totals: DataFrame, stack: DataFrame,
                  objects: DataFrame | None, skipped: DataFrame | None,
                  cfg: FootprintConfig) -> DataFrame:
    """One row per shard with its totals, label and unshard factors.

    Leaves out shards without a counted re-reference, without bytes or with less
    than a second of statistics, and shards where sampling kept far too little.
    """
    zero = F.lit(0).cast("bigint")
    rows = facts.select("shard", "period_s").join(totals, "shard").join(stack, "shard")
    rows = add_labels(rows, cfg)
    map_, network = label_map_network(F.col("label"))
    rows = add_sample_buckets(rows, cfg.sample_buckets, cfg.sample_overrides,
                              network=network, map_=map_)
    rows = rows.where("rereferences > 0 and bytes <> 0 and requests > 0 and period_s >= 1")
    if skipped is None:
        rows = rows.withColumns({"skipped_requests": zero, "skipped_bytes": zero})
    else:
        rows = rows.join(skipped, "shard", "left").fillna(0, ["skipped_requests", "skipped_bytes"])
        least = F.when(F.col("unshard_buckets") > 0, 0.7 / F.col("unshard_buckets")).otherwise(0.7)
        kept = F.col("bytes") / (F.col("bytes") + F.col("skipped_bytes"))
        rows = rows.where((F.col("skipped_requests") == 0) | (kept > least))
    if cfg.sample_at == "map":
        scale = {"byte_scale": F.col("unshard_buckets").cast("bigint"),
                 "count_scale": F.col("unshard_buckets").cast("bigint")}
    else:
        scale = {"byte_scale": F.expr("(skipped_bytes + bytes) div bytes"),
                 "count_scale": F.expr("(skipped_requests + requests) div requests")}
    rows = rows.withColumns(scale)
    if objects is None:
        return rows.withColumns({"footprint_objects": F.col("active_objects"),
                                 "footprint_bytes": F.col("active_bytes")})
    return rows.join(objects, "shard").withColumns({
        "footprint_objects": F.col("distinct_objects"),
        "footprint_bytes": F.col("inserted_bytes")})


def fd_header(summary: DataFrame) -> DataFrame:
    """Descriptor header, scaled. ``total_mib`` is in bytes despite its name."""
    count, size = F.col("count_scale"), F.col("byte_scale")
    return summary.select(
        "shard", "label",
        (F.col("requests") * count).alias("requests"),
        (F.col("bytes") * size).alias("bytes"),
        "period_s",
        ((F.col("stack_inflation") + F.col("bypass_inflation")) * size).alias("total_mib"),
        (F.col("footprint_objects") * count).alias("footprint_objects"),
        (F.col("footprint_bytes") * size).alias("footprint_bytes"),
        (F.col("peak_requests") * count).alias("peak_requests"),
        (F.col("peak_bytes") * size).alias("peak_bytes"))


def fd_curve(curve: DataFrame, summary: DataFrame) -> DataFrame:
    """Scale a thinned curve; shards without a summary row have no curve."""
    scales = summary.select("shard", "label", "count_scale", "byte_scale")
    count, size = F.col("count_scale"), F.col("byte_scale")
    return curve.join(scales, "shard").select(
        "shard", "label", "t",
        (F.col("std_mib") * size).alias("std_mib"),
        (F.col("std_objects") * count).alias("std_objects"),
        (F.col("requests") * count).alias("requests"),
        (F.col("bytes") * size).alias("bytes"),
        (F.col("transition_bytes") * size).alias("transition_bytes"),
        (F.col("transition_requests") * count).alias("transition_requests"))


def scaled_serial_info(info: DataFrame, summary: DataFrame) -> DataFrame:
    scales = summary.select("shard", "label", "period_s", "count_scale", "byte_scale")
    count, size = F.col("count_scale"), F.col("byte_scale")
    return info.join(scales, "shard").select(
        "shard", "label", "serial",
        (F.col("requests") * count).alias("requests"),
        (F.col("bytes") * size).alias("bytes"),
        "period_s",
        (F.col("unique_objects") * count).alias("unique_objects"),
        (F.col("unique_bytes") * size).alias("unique_bytes"))
