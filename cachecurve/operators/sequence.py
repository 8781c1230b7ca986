"""Request order and access links of every shard.

A shard may hold most of the data, and one object most of a shard, so no step brings
all requests of a shard, or of a hot object, together. All requests are laid end to end
in (shard, time, record) order and given one dense global position. ``slice`` = position
divided by ``slice_rows``: groups by slice are bounded by construction. What a hot object
carries from one slice to the next is first reduced to one row per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cachecurve.config import MAX_TIME_S, FootprintConfig
from cachecurve.functions.columns import (is_digest, object_draw, object_hex, object_id,
                                          record_tail, sample_hash, shortfall)
from cachecurve.operators.filters import add_sample_buckets
from cachecurve.operators.route import add_labels, label_map_network
from cachecurve.scratch import save

_ROW_BITS = 33  # rows of a partition in monotonically_increasing_id


def slice_bits(cfg: FootprintConfig) -> int:
    return cfg.slice_rows.bit_length() - 1


def number_rows(df: DataFrame, order: list[Column], name: str,
                columns: list[str | Column] | None = None,
                partitions: int | None = None) -> DataFrame:
    """Save ``df`` in a total order with ``_part``, the number of its range, and ``_inside``, the
    place in it.

    Range partitioning splits hot shards at timestamps. ``columns`` are what is saved; they are
    computed behind the shuffle, and so not again while Spark samples range bounds.
    """
    if partitions:
        ranged = df.repartitionByRange(partitions, *order)
    else:
        ranged = df.repartitionByRange(*order)
    numbered = save(ranged.sortWithinPartitions(*order).select(
        *(columns or df.columns), F.monotonically_increasing_id().alias("_rid")), name)
    return numbered.withColumns({
        "_part": F.shiftright("_rid", _ROW_BITS),
        "_inside": F.col("_rid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}).drop("_rid")


def global_positions(df: DataFrame, order: list[Column], name: str,
                     columns: list[str | Column] | None = None,
                     partitions: int | None = None) -> DataFrame:
    """Save ``df`` in a total order with a dense global ``pos`` from 0. The only unpartitioned
    window runs over one row per partition."""
    numbered = number_rows(df, order, name, columns, partitions)
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_rows"))
    # Saved so that its real size is known: a small table is then broadcast and the
    # numbered rows are not shuffled again.
    starts = save(running_starts(sizes, "_part"), "partition_starts")
    return numbered.join(starts, "_part") \
        .withColumn("pos", F.col("_start") + F.col("_inside")) \
        .drop("_inside", "_part", "_start")


def running_starts(sizes: DataFrame, key: str) -> DataFrame:
    """``_start`` = rows of all earlier keys. One row per partition or slice, so the
    unpartitioned window sees a millionth of the data."""
    earlier = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(key, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))


def order_requests(routed: DataFrame, cfg: FootprintConfig, tiebreak: tuple[str, ...] = (),
                   keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Requests with ``obj``, ``access``, ``pos`` and the facts of their shard, and the pieces
    that these came from.

    ``access`` marks requests that reach the stack: positive size and not sampled
    out. They hold the positions from 0 on in (shard, ts, record text, tiebreak)
    order; the others follow, and count only for time bounds, object ids and the
    sampling totals. ``tiebreak`` columns only spread equal records over tasks. The
    digest and the columns that only the order needs are not kept.
    """
    routed = routed.where(is_digest(F.col("md5")))
    sampled_out = F.lit(False)
    if cfg.sample_at == "reduce":
        map_, network = label_map_network(F.col("label"))
        routed = add_sample_buckets(add_labels(routed, cfg), cfg.sample_buckets,
                                    cfg.sample_overrides, network=network, map_=map_)
        sampled_out = F.pmod(sample_hash(F.col("md5")), F.col("filter_buckets")) != 0
    route_key = ["route_key"] if cfg.num_shards else []
    base = ["shard", "ts", "md5", "size", "bytes", "cpcode", "true_serial", "max_age"]
    rows = routed.select(*dict.fromkeys([*base, *route_key, *tiebreak, *keep]),
                         sampled_out.alias("sampled_out")) \
        .withColumn("access", (F.col("size") > 0) & ~F.col("sampled_out"))
    # The digest leads the record text; comparing it first builds the text only in ties.
    order = [F.expr("not access"), F.col("shard"), *[F.col(c) for c in route_key],
             F.col("ts"), F.col("md5"), record_tail(), *[F.col(c) for c in tiebreak]]
    kept = ["shard", "ts", "size", "bytes", "true_serial", "max_age", "sampled_out", "access"]
    columns = [*dict.fromkeys([*kept, *route_key, *keep]), object_id(F.col("md5")).alias("obj")]
    numbered = number_rows(rows, order, "ordered", columns, cfg.partitions)
    pieces = shard_pieces(numbered, cfg)
    facts = pieces.select("_part", "shard", "_start", *SHARD_FACTS)
    ordered = numbered.join(facts, ["_part", "shard"]) \
        .withColumn("pos", F.col("_start") + F.col("_inside")).drop("_part", "_inside", "_start")
    return ordered, pieces


#: What requests are given of their shard.
SHARD_FACTS = ("first_pos", "first_ts", "compute_start")


def compute_start(cfg: FootprintConfig) -> Column:
    """Second at which a shard's statistics start, from its ``first_ts``."""
    first = F.col("first_ts").cast("bigint")
    if cfg.prewarm_from_config:
        return F.greatest(F.lit(cfg.start_s + cfg.prewarm_s).cast("bigint"), first)
    return first + cfg.prewarm_s


def shard_pieces(numbered: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """A row for every shard in every range of the order, saved: where the range starts, its
    ``accesses`` and the facts of the whole shard; ``lead`` marks one row of a shard.

    Shards lie end to end, so there are as many rows as shards and ranges together. Requests meet the
    facts by range and shard, which bounds the rows of a key by a range; no shuffle is by shard alone.
    """
    bounds = [F.min("ts").alias("_first"), F.max("ts").alias("_last")]
    if cfg.num_shards:
        by_order = F.struct("route_key", "ts")
        bounds = [F.min(by_order).alias("_first"), F.max(by_order).alias("_last")]
    pieces = numbered.groupBy("_part", "shard").agg(
        *bounds, F.count(F.when(F.col("access"), 1)).alias("accesses"),
        F.min(F.when(F.col("access"), F.col("_inside"))).alias("_access"))
    starts = running_starts(numbered.groupBy("_part").agg(F.count("*").alias("_rows")), "_part")
    shard = Window.partitionBy("shard")
    first_ts, last_ts = F.min("_first").over(shard), F.max("_last").over(shard)
    if cfg.num_shards:
        first_ts, last_ts = first_ts["ts"], last_ts["ts"]
    found = pieces.join(starts, "_part").select(
        "_part", "shard", "_start", "accesses", first_ts.alias("first_ts"), last_ts.alias("last_ts"),
        F.min(F.col("_start") + F.col("_access")).over(shard).alias("first_pos"),
        (F.col("_part") == F.min("_part").over(shard)).alias("lead"))
    return save(found.withColumn("compute_start", compute_start(cfg)), "shard_pieces")


def stack_request_count(pieces: DataFrame) -> int:
    """Number of requests that reach the stack."""
    return pieces.agg(F.coalesce(F.sum("accesses"), F.lit(0))).first()[0]


def shard_facts(pieces: DataFrame) -> DataFrame:
    """Per shard: time bounds of all its requests, first access position, start of
    statistics and the periods derived from them."""
    facts = pieces.where("lead").select("shard", "first_ts", "last_ts", "first_pos", "compute_start")
    last = F.col("last_ts")
    return facts.withColumns({
        "actual_start": F.col("first_ts").cast("bigint"),
        "actual_end": last.cast("bigint"),
        "actual_total_s": last.cast("bigint") - F.col("first_ts").cast("bigint"),
        "actual_prewarm_s": (F.col("compute_start") - F.col("first_ts")).cast("bigint"),
        "period_s": (last - F.col("compute_start")).cast("bigint"),
    })


def configured_periods(cfg: FootprintConfig) -> dict[str, int]:
    return {
        "configured_start": cfg.start_s,
        "configured_end": cfg.end_s,
        "configured_total_s": cfg.end_s - cfg.start_s,
        "configured_prewarm_s": cfg.prewarm_s,
        "configured_compute_start": cfg.start_s + cfg.prewarm_s,
        "configured_compute_s": cfg.end_s - cfg.start_s - cfg.prewarm_s,
    }


def accesses(ordered: DataFrame) -> DataFrame:
    """Stack requests with request number ``seq`` (1.. per shard) and ``prewarm``."""
    return ordered.where("access").withColumns({
        "seq": F.col("pos") - F.col("first_pos") + 1,
        "prewarm": F.col("ts").cast("bigint") < F.col("compute_start"),
    }).drop("first_pos", "sampled_out", "access")


def admit(rows: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """``bypass`` for requests of objects not yet let into the stack.

    Each request of an unseen object draws a reproducible percentage; the object is
    in from its first draw within ``admission_pct``.
    """
    if cfg.admission_pct >= 100:
        return rows.withColumn("bypass", F.lit(False))
    bits = slice_bits(cfg)
    admitted = F.pmod(object_draw(F.col("obj"), F.col("seq")), F.lit(100)) <= cfg.admission_pct
    rows = rows.withColumns({"slice": F.shiftright("pos", bits), "_admitted": admitted})
    keys = ["slice", "shard", "obj"]
    firsts = rows.groupBy(*keys).agg(F.min(F.when(F.col("_admitted"), F.col("pos"))).alias("_in"))
    so_far = Window.partitionBy("shard", "obj").orderBy("slice") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    firsts = firsts.withColumn("_in", F.min("_in").over(so_far))
    return rows.join(firsts, keys) \
        .withColumn("bypass", F.col("_in").isNull() | (F.col("pos") < F.col("_in"))) \
        .drop("slice", "_admitted", "_in")


def stack_positions(admitted: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """Close the gaps that bypassed requests leave, so positions are dense again."""
    if cfg.admission_pct >= 100:
        return admitted
    bits = slice_bits(cfg)
    rows = admitted.where(~F.col("bypass")).withColumn("slice", F.shiftright("pos", bits))
    sizes = rows.groupBy("slice").agg(F.count("*").alias("_rows"))
    starts = running_starts(sizes, "slice")
    inside = F.row_number().over(Window.partitionBy("slice").orderBy("pos")) - 1
    return rows.withColumn("_inside", inside).join(starts, "slice") \
        .withColumn("pos", F.col("_start") + F.col("_inside")) \
        .drop("slice", "_start", "_inside")


def hot_buckets(rows: DataFrame, cfg: FootprintConfig, slices: int) -> DataFrame:
    """Hash buckets of objects with more rows than a slice has, saved. Every object with more
    accesses than that is in one; with 16 buckets a slice, at most a sixteenth of the buckets are hot."""
    bucket = object_bucket(slices)
    counts = rows.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_n"))
    return save(counts.where(F.col("_n") > cfg.slice_rows).select("_bucket", F.lit(True).alias("_hot")),
                "hot_buckets")


def object_bucket(slices: int) -> Column:
    return F.pmod(F.xxhash64("shard", "obj"), F.lit(16 * slices)).cast("bigint")


def link_accesses(rows: DataFrame, cfg: FootprintConfig, slices: int) -> DataFrame:
    """Previous and next access of the same object, and its sticky size.

    Adds ``prev_pos``, ``prev_ts``, ``next_pos``, ``next_ts`` and ``obj_size`` (the
    object's first accepted size). Accesses of an object are brought together, but those of an object in a
    hot bucket slice by slice, so that no group exceeds ``slice_rows``; one row per such object and slice
    carries the ends across.
    """
    rows = rows.drop("first_ts", "bypass", "prewarm") \
        .withColumns({"slice": F.shiftright("pos", slice_bits(cfg)), "_bucket": object_bucket(slices)})
    hot = hot_buckets(rows, cfg, slices)
    hot_rows = rows.join(hot, "_bucket").withColumn("_run", F.col("slice"))
    rows = rows.join(hot, "_bucket", "left") \
        .withColumn("_run", F.when(F.col("_hot"), F.col("slice")).otherwise(-1)).drop("_hot", "_bucket")
    keys = ["shard", "obj", "_run"]
    within = Window.partitionBy(*keys).orderBy("pos")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    linked = rows.withColumns({
        "prev_pos": F.lag("pos").over(within), "prev_ts": F.lag("ts").over(within),
        "next_pos": F.lead("pos").over(within), "next_ts": F.lead("ts").over(within),
        "obj_size": F.first("size").over(within.rowsBetween(*so_far))})
    runs = hot_rows.groupBy(*keys).agg(
        F.min("pos").alias("_first_pos"), F.min_by("ts", "pos").alias("_first_ts"),
        F.max("pos").alias("_last_pos"), F.max_by("ts", "pos").alias("_last_ts"),
        F.min_by("size", "pos").alias("_size"))
    across = Window.partitionBy("shard", "obj").orderBy("_run")
    carried = runs.select(
        *keys,
        F.lag("_last_pos").over(across).alias("_prev_pos"),
        F.lag("_last_ts").over(across).alias("_prev_ts"),
        F.lead("_first_pos").over(across).alias("_next_pos"),
        F.lead("_first_ts").over(across).alias("_next_ts"),
        F.first("_size").over(across.rowsBetween(*so_far)).alias("_obj_size"))
    ends = ["prev_pos", "prev_ts", "next_pos", "next_ts"]
    return linked.join(carried, keys, "left").withColumns({
        **{c: F.coalesce(c, f"_{c}") for c in ends},
        "obj_size": F.coalesce("_obj_size", "obj_size"),
    }).drop("_run", "_obj_size", *[f"_{c}" for c in ends])


def _sample_second(ts: Column, prev_ts: Column, cfg: FootprintConfig) -> Column:
    """Whole second of the reuse interval when the re-reference counts, else null."""
    second = (ts - prev_ts).try_cast("int")
    counted = (second >= 0) & (second < cfg.horizon_s) \
        & (ts.cast("bigint") >= F.col("compute_start"))
    return F.when(counted, second)


def sampled_links(linked: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """``t`` of each re-reference and of the next one, staleness and inflation.

    ``t`` is null for first accesses, prewarm rows and intervals outside the horizon.
    """
    ts, prev_ts = F.col("ts"), F.col("prev_ts")
    stale = F.lit(False)
    if cfg.consider_ttl:
        stale = (F.col("max_age") > -1) & (ts > prev_ts.cast("int") + F.col("max_age"))
    in_horizon = prev_ts.isNull() | (F.col("interval_s").between(0, cfg.horizon_s - 1))
    return linked.withColumns({
        "prewarm": ts.cast("bigint") < F.col("compute_start"),
        "t": _sample_second(ts, prev_ts, cfg),
        "next_t": _sample_second(F.col("next_ts"), ts, cfg),
        "interval_s": (ts - prev_ts).try_cast("int"),
        "stale": F.coalesce(stale, F.lit(False)),
        "inflation": shortfall(F.when(prev_ts.isNull(), F.col("size"))
                               .otherwise(F.col("obj_size")), F.col("bytes")),
    }).withColumn("in_horizon", in_horizon)


def copy_side(obj: Column, seq: Column) -> Column:
    """Which of two servers a request falls to: parity of the draw's leading hex digit."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", object_hex(obj), seq)), 1, 1), 16, 10)
                  .cast("int"), F.lit(2))
