"""Request order, stack distance, histograms and descriptor tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.functions.columns import object_hex
from cachecurve.operators import describe, profile
from cachecurve.plans.footprint import Footprint
from workload.registry import query
from workload.views import (EVENT_KEYS, ITEM_KEYS, ITEMS_SQL, PLAIN, REQUESTS_SQL, routed_events,
                            routed_items)

SLICED = replace(PLAIN, slice_rows=1024)


def events(spark, sf_dir, cfg=PLAIN, prepare=None) -> Footprint:
    requests = routed_events(spark, sf_dir)
    return Footprint(prepare(requests) if prepare else requests, cfg, EVENT_KEYS, EVENT_KEYS)


def items(spark, sf_dir, cfg=PLAIN) -> Footprint:
    return Footprint(routed_items(spark, sf_dir), cfg, ITEM_KEYS, ITEM_KEYS)


# --- SQL building blocks ----------------------------------------------------------------

ROUTED_EVENTS = REQUESTS_SQL + """,
routed AS (SELECT *, serial AS shard, serial AS true_serial, CAST(serial AS VARCHAR) AS label,
             event_id AS tie1, 0 AS tie2, false AS sampled_out FROM requests)"""
ROUTED_ITEMS = ITEMS_SQL + """,
routed AS (SELECT *, serial AS shard, serial AS true_serial, CAST(serial AS VARCHAR) AS label,
             l_orderkey AS tie1, l_linenumber AS tie2, false AS sampled_out FROM items)"""


def draw(expr: str = "seq") -> str:
    return f"('0x' || substr(md5(md5 || ':' || {expr}), 1, 7))::BIGINT"


def stack(source: str, prewarm: int = 0, admission: int = 100, horizon: int = 2678401,
          ttl: bool = False) -> str:
    """CTEs facts, req (numbered stack requests), lnk (their links) on top of ``routed``."""
    admitted = "true" if admission >= 100 else f"{draw()} % 100 <= {admission}"
    stale = "max_age > -1 AND ts > trunc(prev_ts) + max_age" if ttl else "false"
    return f"""WITH {source},
facts AS (
  SELECT shard, min(ts) AS first_ts, max(ts) AS last_ts,
    CAST(trunc(min(ts)) AS BIGINT) + {prewarm} AS compute_start FROM routed GROUP BY shard),
numbered AS (
  SELECT r.*, compute_start, first_ts, trunc(ts) < compute_start AS prewarm,
    row_number() OVER (PARTITION BY shard ORDER BY ts, concat(md5, ':', size, ':', bytes, ':',
      cpcode, ':', true_serial, ':', max_age), tie1, tie2) AS seq
  FROM routed r JOIN facts USING (shard) WHERE size > 0 AND NOT sampled_out),
req AS (
  SELECT *, coalesce(seq < first_in, true) AS bypass FROM (
    SELECT *, min(CASE WHEN {admitted} THEN seq END) OVER (PARTITION BY shard, md5) AS first_in
    FROM numbered)),
stacked AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY seq) AS n FROM req WHERE NOT bypass),
linked AS (
  SELECT *, lag(n) OVER o AS p, lag(ts) OVER o AS prev_ts, lead(n) OVER o AS nx,
    first_value(size) OVER o AS obj_size
  FROM stacked WINDOW o AS (PARTITION BY shard, md5 ORDER BY seq)),
lnk AS (
  SELECT *, CAST(trunc(ts - prev_ts) AS INTEGER) AS interval_s, coalesce({stale}, false) AS stale,
    greatest(CASE WHEN p IS NULL THEN size ELSE obj_size END - bytes, 0) AS inflation,
    CASE WHEN NOT prewarm AND trunc(ts - prev_ts) BETWEEN 0 AND {horizon - 1}
      THEN CAST(trunc(ts - prev_ts) AS INTEGER) END AS t
  FROM linked)"""


DIST = """,
dist AS (
  SELECT a.shard, a.n, any_value(a.t) AS t, any_value(a.tie1) AS tie1, any_value(a.tie2) AS tie2,
    CASE WHEN count(j.n) = 0 THEN 0 ELSE count(j.n) + 1 END AS dist_objects,
    CASE WHEN count(j.n) = 0 THEN 0 ELSE CAST(sum(j.obj_size) AS BIGINT) + any_value(a.obj_size) END AS dist_bytes
  FROM lnk a LEFT JOIN lnk j ON j.shard = a.shard AND j.n > a.p AND j.n < a.n
    AND (j.p IS NULL OR j.p < a.p)
  WHERE a.p IS NOT NULL GROUP BY a.shard, a.n)"""

HIST = DIST + """,
hist AS (
  SELECT l.shard, l.t, count(*) AS requests, count(*) FILTER (l.stale) AS stale,
    CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(inflation) AS BIGINT) AS inflation,
    CAST(sum(dist_objects) AS BIGINT) AS dist_objects, sum(dist_bytes) AS dist_bytes
  FROM lnk l JOIN dist d ON d.shard = l.shard AND d.n = l.n
  WHERE l.t IS NOT NULL GROUP BY l.shard, l.t)"""

TRANSITIONS = """,
objects AS (
  SELECT shard, md5, CAST(sum(coalesce(interval_s, 0)) AS BIGINT) AS interval_sum,
    count(*) AS accesses, max(obj_size) AS obj_size,
    CAST(sum(coalesce(interval_s, 0)) AS BIGINT) // count(*) AS mean_interval,
    min(('0x' || substr(md5(md5 || ':' || seq), 1, 1))::BIGINT % 2)
      < max(('0x' || substr(md5(md5 || ':' || seq), 1, 1))::BIGINT % 2) AS two_copies
  FROM lnk WHERE NOT prewarm AND (prev_ts IS NULL OR interval_s BETWEEN 0 AND 2678400)
  GROUP BY shard, md5),
transitions AS (
  SELECT shard, CAST(mean_interval AS INTEGER) AS t, CAST(sum(obj_size) AS BIGINT) AS transition_bytes,
    count(*) AS transition_requests FROM objects WHERE two_copies GROUP BY ALL)"""

CURVE = HIST + TRANSITIONS + """,
curve AS (
  SELECT h.shard, h.t, CAST(dist_bytes // (requests * 1048576) AS BIGINT) AS std_mib,
    dist_objects // requests AS std_objects, requests - stale AS requests,
    bytes + inflation AS bytes, coalesce(transition_bytes, 0) AS transition_bytes,
    coalesce(transition_requests, 0) AS transition_requests
  FROM hist h LEFT JOIN transitions x ON x.shard = h.shard AND x.t = h.t WHERE h.t < 2678400)"""

TOTALS = """,
totals AS (
  SELECT shard, count(*) FILTER (NOT prewarm) AS requests,
    CAST(coalesce(sum(bytes) FILTER (NOT prewarm), 0) AS BIGINT) AS bytes,
    count(*) FILTER (bypass) AS bypass_requests,
    CAST(coalesce(sum(size) FILTER (bypass), 0) AS BIGINT) AS bypass_bytes,
    CAST(coalesce(sum(greatest(size - bytes, 0)) FILTER (bypass), 0) AS BIGINT) AS bypass_inflation
  FROM req GROUP BY shard),
stack_totals AS (
  SELECT shard, CAST(coalesce(sum(inflation) FILTER ((p IS NULL AND NOT prewarm) OR t IS NOT NULL), 0) AS BIGINT)
      AS stack_inflation,
    CAST(coalesce(sum(size) FILTER (p IS NULL AND NOT prewarm), 0) AS BIGINT) AS inserted_bytes,
    count(*) FILTER (nx IS NULL AND ts > compute_start) AS active_objects,
    CAST(coalesce(sum(obj_size) FILTER (nx IS NULL AND ts > compute_start), 0) AS BIGINT) AS active_bytes,
    count(*) FILTER (t IS NOT NULL) AS rereferences
  FROM lnk GROUP BY shard),
peaks AS (
  SELECT shard, max(n) AS peak_requests, CAST(max(b) AS BIGINT) AS peak_bytes FROM (
    SELECT shard, floor((ts - first_ts) / 300) AS bucket, count(*) AS n, sum(bytes) AS b
    FROM req WHERE NOT prewarm GROUP BY ALL) GROUP BY shard),
seen AS (SELECT shard, count(DISTINCT md5) AS distinct_objects FROM routed GROUP BY shard)"""

SUMMARY = TOTALS + """,
summary AS (
  SELECT *, CAST(trunc(last_ts - compute_start) AS BIGINT) AS period_s
  FROM facts JOIN totals USING (shard) JOIN stack_totals USING (shard) JOIN peaks USING (shard)
    JOIN seen USING (shard)
  WHERE rereferences > 0 AND bytes <> 0 AND requests > 0
    AND trunc(last_ts - compute_start) >= 1)"""


def header_sql(scale: str = "1", objects: str = "distinct_objects",
               size: str = "inserted_bytes") -> str:
    return f"""
SELECT shard, CAST(shard AS VARCHAR) AS label, requests * {scale} AS requests,
  bytes * {scale} AS bytes, period_s, (stack_inflation + bypass_inflation) * {scale} AS total_mib,
  {objects} * {scale} AS footprint_objects, {size} * {scale} AS footprint_bytes,
  peak_requests * {scale} AS peak_requests, peak_bytes * {scale} AS peak_bytes FROM summary"""


EVENT_STACK = stack(ROUTED_EVENTS)
ITEM_STACK = stack(ROUTED_ITEMS)

CURVE_OUT = """
SELECT c.shard, CAST(c.shard AS VARCHAR) AS label, c.t, c.std_mib, c.std_objects, c.requests, c.bytes,
  c.transition_bytes, c.transition_requests
FROM curve c JOIN summary s ON s.shard = c.shard"""

# --- order and links --------------------------------------------------------------------


@query("shard_sequence", EVENT_STACK + " SELECT tie1 AS event_id, shard, seq FROM req")
def shard_sequence(spark, sf_dir):
    return events(spark, sf_dir).requests.select("event_id", "shard", "seq")


@query("shard_sequence_ties", ITEM_STACK + """
SELECT shard, seq, ts, md5, l_orderkey, l_linenumber FROM req""")
def shard_sequence_ties(spark, sf_dir):
    return items(spark, sf_dir).requests.select(
        "shard", "seq", "ts", object_hex(F.col("obj")).alias("md5"), "l_orderkey", "l_linenumber")


@query("shard_partition", f"""
WITH {REQUESTS_SQL},
folded AS (SELECT *, CAST(serial AS VARCHAR) AS route_key, serial % 3 AS shard FROM requests WHERE size > 0)
SELECT event_id, shard, row_number() OVER (PARTITION BY shard ORDER BY route_key, ts,
  concat(md5, ':', size, ':', bytes, ':', cpcode, ':', serial, ':', max_age), event_id) AS seq
FROM folded""")
def shard_partition(spark, sf_dir):
    from cachecurve.operators.route import route
    from workload.views import event_requests

    cfg = FootprintConfig(num_shards=3)
    routed = route(event_requests(spark, sf_dir).withColumns(
        {"true_serial": F.col("serial"), "map_index": F.lit(-1)}), cfg)
    return Footprint(routed, cfg, EVENT_KEYS, EVENT_KEYS).requests.select("event_id", "shard", "seq")


@query("head_per_shard", EVENT_STACK + """
SELECT shard, tie1 AS event_id, CAST(seq AS INTEGER) AS rank FROM req WHERE seq <= 5""")
def head_per_shard(spark, sf_dir):
    return profile.head_per_shard(events(spark, sf_dir).ordered).select("shard", "event_id", "rank")


@query("recency_rank", EVENT_STACK + """
SELECT shard, md5, CAST(r AS INTEGER) AS rank FROM (
  SELECT shard, md5, row_number() OVER (PARTITION BY shard ORDER BY max(seq) DESC) AS r
  FROM req GROUP BY shard, md5) WHERE r = 7""")
def recency_rank(spark, sf_dir):
    return profile.recency_rank(events(spark, sf_dir).linked, 7).select(
        "shard", object_hex(F.col("obj")).alias("md5"), "rank")


@query("reuse_interval", EVENT_STACK + """
SELECT tie1 AS event_id, shard, interval_s, t, obj_size FROM lnk""")
def reuse_interval(spark, sf_dir):
    return events(spark, sf_dir, SLICED).linked.select("event_id", "shard", "interval_s", "t",
                                                       "obj_size")


HORIZON = dict(start_s=1704067200, end_s=1704067200 + 40000)


@query("reuse_horizon", stack(ROUTED_EVENTS, horizon=40002) + """
SELECT tie1 AS event_id, shard, interval_s, t FROM lnk WHERE p IS NOT NULL""")
def reuse_horizon(spark, sf_dir):
    cfg = replace(PLAIN, **HORIZON)
    return events(spark, sf_dir, cfg).linked.where("prev_pos is not null") \
        .select("event_id", "shard", "interval_s", "t")


@query("stack_distance_objects", EVENT_STACK + DIST + """
SELECT tie1 AS event_id, dist_objects FROM dist""")
def stack_distance_objects(spark, sf_dir):
    f = events(spark, sf_dir)
    return f.distances.join(f.linked, "pos").select("event_id", "dist_objects")


@query("stack_distance_bytes", ITEM_STACK + DIST + """
SELECT shard, n AS seq, tie1 AS l_orderkey, tie2 AS l_linenumber, dist_objects, dist_bytes FROM dist""")
def stack_distance_bytes(spark, sf_dir):
    f = items(spark, sf_dir)
    return f.distances.join(f.linked, "pos").select("shard", "seq", "l_orderkey", "l_linenumber",
                                                    "dist_objects", "dist_bytes")


@query("stack_distance_sliced", ITEM_STACK + DIST + """
SELECT shard, n AS seq, tie1 AS l_orderkey, tie2 AS l_linenumber, dist_objects, dist_bytes FROM dist""")
def stack_distance_sliced(spark, sf_dir):
    f = items(spark, sf_dir, SLICED)
    return f.distances.join(f.linked, "pos").select("shard", "seq", "l_orderkey", "l_linenumber",
                                                    "dist_objects", "dist_bytes")


HOT = "ABCDEFABCDEFABCD"
HOT_EVENTS = ROUTED_EVENTS.replace(
    "SELECT *, serial AS shard",
    f"SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN '{HOT}' ELSE md5 END AS md5), 1 AS shard")


@query("hot_object_distance", stack(HOT_EVENTS) + DIST + """
SELECT tie1 AS event_id, t, dist_objects, dist_bytes FROM dist""")
def hot_object_distance(spark, sf_dir):
    """One shard, and one object in it with a third of the requests."""
    f = events(spark, sf_dir, replace(PLAIN, slice_rows=256), lambda r: r.withColumns({
        "shard": F.lit(1),
        "md5": F.when(F.expr("event_id % 3 = 0"), HOT).otherwise(F.col("md5"))}))
    return f.distances.join(f.linked, "pos").select("event_id", "t", "dist_objects", "dist_bytes")


# --- prewarm, time to live, admission ---------------------------------------------------

WARM_S = 10 * 86400


@query("periods", stack(ROUTED_EVENTS, prewarm=WARM_S) + f"""
SELECT shard, compute_start, CAST(trunc(first_ts) AS BIGINT) AS actual_start,
  CAST(trunc(last_ts) AS BIGINT) AS actual_end,
  CAST(trunc(last_ts) AS BIGINT) - CAST(trunc(first_ts) AS BIGINT) AS actual_total_s,
  CAST(trunc(compute_start - first_ts) AS BIGINT) AS actual_prewarm_s,
  CAST(trunc(last_ts - compute_start) AS BIGINT) AS period_s,
  CAST({WARM_S} AS BIGINT) AS configured_prewarm_s, CAST({2**31 - 1 - WARM_S} AS BIGINT) AS configured_compute_s
FROM facts""")
def periods(spark, sf_dir):
    return events(spark, sf_dir, replace(PLAIN, prewarm_s=WARM_S)).periods.select(
        "shard", "compute_start", "actual_start", "actual_end", "actual_total_s",
        "actual_prewarm_s", "period_s", "configured_prewarm_s", "configured_compute_s")


@query("prewarm_from_config", stack(ROUTED_EVENTS).replace(
    "CAST(trunc(min(ts)) AS BIGINT) + 0", "greatest(1704067200 + 864000, CAST(trunc(min(ts)) AS BIGINT))") + """
SELECT tie1 AS event_id, shard, prewarm, t FROM lnk""")
def prewarm_from_config(spark, sf_dir):
    cfg = replace(PLAIN, start_s=1704067200, prewarm_s=864000, prewarm_from_config=True)
    return events(spark, sf_dir, cfg).linked.select("event_id", "shard", "prewarm", "t")


@query("ttl_stale", stack(ROUTED_EVENTS, ttl=True) + CURVE + """
SELECT h.shard, h.t, h.requests, h.stale, c.requests AS fresh FROM hist h JOIN curve c
ON c.shard = h.shard AND c.t = h.t""")
def ttl_stale(spark, sf_dir):
    f = events(spark, sf_dir, replace(PLAIN, consider_ttl=True))
    fresh = describe.raw_curve(f.histogram, None, f.cfg) \
        .select("shard", "t", F.col("requests").alias("fresh"))
    return f.histogram.select("shard", "t", "requests", "stale").join(fresh, ["shard", "t"])


ADMIT = replace(PLAIN, admission_pct=10, slice_rows=1024)
ADMIT_STACK = stack(ROUTED_EVENTS, admission=10)


@query("admission", ADMIT_STACK + TOTALS + """
SELECT shard, requests, bytes, bypass_requests, bypass_bytes, bypass_inflation FROM totals""")
def admission(spark, sf_dir):
    return events(spark, sf_dir, ADMIT).totals.drop("peak_requests", "peak_bytes")


@query("admission_distance", ADMIT_STACK + DIST + """
SELECT tie1 AS event_id, dist_objects, dist_bytes FROM dist""")
def admission_distance(spark, sf_dir):
    f = events(spark, sf_dir, ADMIT)
    return f.distances.join(f.linked, "pos").select("event_id", "dist_objects", "dist_bytes")


# --- tables -----------------------------------------------------------------------------


@query("reuse_histogram", ITEM_STACK + HIST + """
SELECT shard, t, requests, stale, bytes, inflation, dist_objects,
  CAST(dist_bytes AS BIGINT) AS dist_bytes FROM hist""")
def reuse_histogram(spark, sf_dir):
    return items(spark, sf_dir).histogram.withColumn("dist_bytes", F.col("dist_bytes").cast("bigint"))


@query("fd_curve", EVENT_STACK + CURVE + SUMMARY + CURVE_OUT)
def fd_curve(spark, sf_dir):
    return events(spark, sf_dir).curve


@query("fd_curve_items", ITEM_STACK + CURVE + SUMMARY + CURVE_OUT)
def fd_curve_items(spark, sf_dir):
    return items(spark, sf_dir, SLICED).curve


@query("fd_header", EVENT_STACK + SUMMARY + header_sql())
def fd_header(spark, sf_dir):
    return events(spark, sf_dir).header


@query("fd_header_items", ITEM_STACK + SUMMARY + header_sql())
def fd_header_items(spark, sf_dir):
    return items(spark, sf_dir).header


@query("fd_header_prewarm", stack(ROUTED_EVENTS, prewarm=WARM_S) + SUMMARY
       + header_sql(objects="active_objects", size="active_bytes"))
def fd_header_prewarm(spark, sf_dir):
    return events(spark, sf_dir, replace(PLAIN, prewarm_s=WARM_S)).header


@query("iat_per_object", EVENT_STACK + TRANSITIONS + """
SELECT shard, md5, interval_sum, accesses, mean_interval FROM objects""")
def iat_per_object(spark, sf_dir):
    return events(spark, sf_dir).object_intervals.select(
        "shard", object_hex(F.col("obj")).alias("md5"), "interval_sum", "accesses",
        "mean_interval")


@query("copy_transition", EVENT_STACK + TRANSITIONS + "SELECT * FROM transitions")
def copy_transition(spark, sf_dir):
    return describe.copy_transitions(events(spark, sf_dir).object_intervals)


@query("peak_traffic", EVENT_STACK + TOTALS + "SELECT * FROM peaks")
def peak_traffic(spark, sf_dir):
    return events(spark, sf_dir).totals.select("shard", "peak_requests", "peak_bytes")


@query("serial_info", stack(ROUTED_EVENTS.replace(
    "serial AS shard, serial AS true_serial, CAST(serial AS VARCHAR) AS label",
    "cpcode AS shard, serial AS true_serial, CAST(cpcode AS VARCHAR) AS label"), prewarm=WARM_S)
    + SUMMARY + """
SELECT i.shard, CAST(i.shard AS VARCHAR) AS label, i.serial, i.requests, i.bytes, s.period_s,
  i.unique_objects, i.unique_bytes
FROM (
  SELECT r.shard, r.true_serial AS serial, count(*) AS requests, CAST(sum(r.bytes) AS BIGINT) AS bytes,
    count(*) FILTER (l.prev_ts IS NULL OR trunc(l.prev_ts) < r.compute_start) AS unique_objects,
    CAST(coalesce(sum(r.size) FILTER (l.prev_ts IS NULL OR trunc(l.prev_ts) < r.compute_start), 0) AS BIGINT)
      AS unique_bytes
  FROM req r JOIN lnk l ON l.shard = r.shard AND l.seq = r.seq WHERE NOT r.prewarm GROUP BY ALL) i
JOIN summary s ON s.shard = i.shard""")
def serial_info(spark, sf_dir):
    return events(spark, sf_dir, replace(PLAIN, prewarm_s=WARM_S),
                  lambda r: r.withColumn("shard", F.col("cpcode"))).serial_info


# A shard per twelve events: many have no re-reference at all.
USER_SHARDS = ROUTED_EVENTS.replace(
    "serial AS shard, serial AS true_serial, CAST(serial AS VARCHAR) AS label",
    "CAST(event_id // 12 AS INTEGER) AS shard, serial AS true_serial, CAST(event_id // 12 AS VARCHAR) AS label")


@query("empty_shards", stack(USER_SHARDS) + SUMMARY + header_sql())
def empty_shards(spark, sf_dir):
    return events(spark, sf_dir, PLAIN, lambda r: r.withColumn(
        "shard", F.expr("cast(event_id div 12 as int)"))).header


@query("hit_rate_curve", EVENT_STACK + CURVE + TOTALS + """
SELECT c.shard, t, sum(c.requests) OVER o * 100.0 / any_value(x.requests) OVER o AS request_hit_pct,
  sum(c.bytes) OVER o * 100.0 / any_value(x.bytes) OVER o AS byte_hit_pct
FROM curve c JOIN totals x ON x.shard = c.shard
WINDOW o AS (PARTITION BY c.shard ORDER BY t)""")
def hit_rate_curve(spark, sf_dir):
    return events(spark, sf_dir).hit_rates


def thinned_sql(jump: float) -> str:
    """The scan over a curve as recursion over its rows."""
    return CURVE + SUMMARY + f""",
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.shard ORDER BY t) AS r,
    count(*) OVER (PARTITION BY c.shard) AS rs FROM curve c JOIN summary USING (shard)),
walk AS (
  SELECT shard, r, rs, t, std_mib, std_objects, 100 >= {jump} AS prints, t AS pt, std_mib AS ps,
    100 >= {jump} AS any_printed, requests AS sr, bytes AS sb, transition_bytes AS stb,
    transition_requests AS str_ FROM ranked WHERE r = 1
  UNION ALL
  SELECT shard, r, rs, t, std_mib, std_objects, prints,
    CASE WHEN prints THEN t ELSE pt END, CASE WHEN prints THEN std_mib ELSE ps END,
    any_printed OR prints, sr, sb, stb, str_
  FROM (
    SELECT n.shard, n.r, n.rs, n.t, n.std_mib, n.std_objects, w.pt, w.ps, w.any_printed,
      CASE WHEN NOT w.any_printed THEN 100 >= {jump}
        ELSE w.pt = 0 OR abs((n.t - w.pt) * 100.0 / w.pt) > {jump}
          OR (CASE WHEN w.ps = 0 THEN n.std_mib <> 0
                   ELSE abs((n.std_mib - w.ps) * 100.0 / w.ps) >= {jump} END) END AS prints,
      n.requests + CASE WHEN w.prints THEN 0 ELSE w.sr END AS sr,
      n.bytes + CASE WHEN w.prints THEN 0 ELSE w.sb END AS sb,
      n.transition_bytes + CASE WHEN w.prints THEN 0 ELSE w.stb END AS stb,
      n.transition_requests + CASE WHEN w.prints THEN 0 ELSE w.str_ END AS str_
    FROM walk w JOIN ranked n ON n.shard = w.shard AND n.r = w.r + 1))
SELECT shard, CAST(shard AS VARCHAR) AS label, t, std_mib, std_objects, sr AS requests, sb AS bytes,
  stb AS transition_bytes, str_ AS transition_requests
FROM walk WHERE prints OR (r = rs AND sr > 0)"""


@query("fd_curve_thinned", EVENT_STACK.replace("WITH ", "WITH RECURSIVE ", 1) + thinned_sql(5))
def fd_curve_thinned(spark, sf_dir):
    return events(spark, sf_dir, replace(PLAIN, thinning_pct=5.0)).curve


# --- sampling ---------------------------------------------------------------------------

REDUCE_SAMPLED = ROUTED_EVENTS.replace(
    "false AS sampled_out", "('0x' || substr(md5, 9, 8))::BIGINT % 3 <> 0 AS sampled_out")


@query("spatial_sample_reduce", stack(REDUCE_SAMPLED) + SUMMARY + """,
skipped AS (
  SELECT shard, count(*) AS skipped_requests, CAST(sum(bytes) AS BIGINT) AS skipped_bytes
  FROM routed WHERE sampled_out AND size > 0 GROUP BY shard),
scaled AS (
  SELECT *, (skipped_requests + requests) // requests AS cs, (skipped_bytes + bytes) // bytes AS bs
  FROM summary JOIN skipped USING (shard)
  WHERE CAST(bytes AS DOUBLE) / (bytes + skipped_bytes) > 0.7 / 3)
SELECT shard, CAST(shard AS VARCHAR) AS label, requests * cs AS requests, bytes * bs AS bytes, period_s,
  (stack_inflation + bypass_inflation) * bs AS total_mib, distinct_objects * cs AS footprint_objects,
  inserted_bytes * bs AS footprint_bytes, peak_requests * cs AS peak_requests,
  peak_bytes * bs AS peak_bytes FROM scaled""")
def spatial_sample_reduce(spark, sf_dir):
    return events(spark, sf_dir, replace(PLAIN, sample_at="reduce", sample_buckets=3)).header


GUARDED = REQUESTS_SQL + """,
routed AS (SELECT r.*, CAST(user_id % 300 AS INTEGER) AS shard, serial AS true_serial, event_id AS tie1, 0 AS tie2,
             ('0x' || substr(md5, 9, 8))::BIGINT % 4 <> 0 AS sampled_out FROM requests r JOIN ev USING (event_id))"""


@query("sampling_guard", stack(GUARDED) + SUMMARY + """,
skipped AS (
  SELECT shard, count(*) AS skipped_requests, CAST(sum(bytes) AS BIGINT) AS skipped_bytes
  FROM routed WHERE sampled_out AND size > 0 GROUP BY shard),
scaled AS (
  SELECT *, (coalesce(skipped_requests, 0) + requests) // requests AS cs, (coalesce(skipped_bytes, 0) + bytes) // bytes AS bs
  FROM summary LEFT JOIN skipped USING (shard)
  WHERE skipped_requests IS NULL OR CAST(bytes AS DOUBLE) / (bytes + skipped_bytes) > 0.7 / 4)
SELECT shard, requests * cs AS requests, bytes * bs AS bytes, distinct_objects * cs AS footprint_objects FROM scaled""")
def sampling_guard(spark, sf_dir):
    """Small shards, of which sampling leaves too little of some."""
    def split(requests):
        users = spark.read.parquet(f"{sf_dir}/events.parquet").select(
            "event_id", F.expr("cast(user_id % 300 as int)").alias("_user"))
        return requests.join(users, "event_id").withColumn("shard", F.col("_user")).drop("_user")

    cfg = replace(PLAIN, sample_at="reduce", sample_buckets=4)
    return events(spark, sf_dir, cfg, split).header.select("shard", "requests", "bytes", "footprint_objects")


VARYING = ROUTED_EVENTS.replace("SELECT *, serial AS shard", """SELECT * REPLACE (
  CASE WHEN size = 0 THEN 0 ELSE 1000000 * (1 + (event_id * 7) % 23) END AS size), serial AS shard""")


def vary(requests):
    return requests.withColumn("size", F.expr(
        "if(size = 0, 0L, 1000000 * (1 + (event_id * 7) % 23))"))


@query("varying_sizes", stack(VARYING) + SUMMARY + header_sql())
def varying_sizes(spark, sf_dir):
    """Objects whose size changes with every request: the first one sticks."""
    return events(spark, sf_dir, prepare=vary).header


@query("varying_sizes_curve", stack(VARYING) + CURVE + SUMMARY + CURVE_OUT)
def varying_sizes_curve(spark, sf_dir):
    return events(spark, sf_dir, prepare=vary).curve


LARGE = ROUTED_EVENTS.replace("SELECT *, serial AS shard", """SELECT * REPLACE (
  CAST(18014398509481984 - event_id % 3 AS BIGINT) AS size), serial AS shard""")


@query("large_sizes", stack(LARGE) + DIST + """
SELECT tie1 AS event_id, dist_objects, dist_bytes FROM dist""")
def large_sizes(spark, sf_dir):
    """Sizes of 2 ** 54: what the requests of a slice weigh together needs more than 64 bits."""
    f = events(spark, sf_dir, replace(PLAIN, slice_rows=512), lambda requests: requests.withColumn(
        "size", F.expr("18014398509481984L - event_id % 3")))
    return f.distances.join(f.linked, "pos").select("event_id", "dist_objects", "dist_bytes")


MAP_SAMPLED = ROUTED_EVENTS.replace(
    "FROM requests)", "FROM requests WHERE ('0x' || substr(md5, 9, 8))::BIGINT % 2 = 0)")


@query("unshard_header", stack(MAP_SAMPLED) + SUMMARY + header_sql(scale="2"))
def unshard_header(spark, sf_dir):
    from cachecurve.plans.footprint import footprint
    from workload.views import event_requests

    cfg = replace(PLAIN, sample_at="map", sample_buckets=2, ignore_icp=False)
    return footprint(event_requests(spark, sf_dir), cfg, EVENT_KEYS).header


# --- whole jobs -------------------------------------------------------------------------

STANDARD_SQL = REQUESTS_SQL + """,
routed AS (
  SELECT *, CAST(('0x' || substr(md5, 1, 4))::BIGINT % 5 AS INTEGER) AS shard, serial AS true_serial,
    event_id AS tie1, 0 AS tie2, false AS sampled_out
  FROM requests WHERE objstatus <> 'g' AND ts BETWEEN 1704067200 AND 1706000000
    AND ('0x' || substr(md5, 9, 8))::BIGINT % 2 = 0)"""


@query("standard_job", stack(STANDARD_SQL, horizon=1932802).replace(
    "CAST(trunc(min(ts)) AS BIGINT) + 0", "greatest(1704067200, CAST(trunc(min(ts)) AS BIGINT))")
    .replace("WITH ", "WITH RECURSIVE ", 1) + thinned_sql(5).replace(
    "std_mib, std_objects, sr AS requests, sb AS bytes,\n  stb AS transition_bytes, str_ AS",
    "std_mib * 2 AS std_mib, std_objects * 2 AS std_objects, sr * 2 AS requests, sb * 2 AS bytes,\n"
    "  stb * 2 AS transition_bytes, str_ * 2 AS"))
def standard_job(spark, sf_dir):
    """Url hash split, map-side sampling and thinning together."""
    from cachecurve.plans.footprint import footprint
    from workload.views import event_requests

    cfg = FootprintConfig(start_s=1704067200, end_s=1706000000, prewarm_from_config=True,
                          url_buckets=5, sample_at="map", sample_buckets=2, thinning_pct=5.0)
    return footprint(event_requests(spark, sf_dir), cfg, EVENT_KEYS).curve


EXPANSION_SQL = REQUESTS_SQL + """,
vmn(vcd, mapname, network, label, id) AS (VALUES (0, 'm1', 'f', 'm1^f^v0', 0),
  (1, 'm1', 'f', 'm1^f^v1', 1), (1, 'm2', 'f', 'm2^f^v1', 2), (2, 'm3', 'f', 'm3^f^v2', 3),
  (0, '101', 'f', '101^f^v0', 4)),
mapped AS (SELECT r.*, id, label FROM requests r JOIN vmn USING (vcd, mapname, network)
  WHERE objstatus <> 'g' AND ts BETWEEN 1704067200 AND 1706700000
    AND ('0x' || substr(md5, 9, 8))::BIGINT % CASE WHEN mapname = 'm1' THEN 1 ELSE 2 END = 0),
copies AS (
  SELECT * EXCLUDE (id, label, bytes), bytes, CAST(id AS INTEGER) AS shard, label AS label FROM mapped
  WHERE NOT (objstatus = 'K' AND mapname <> '101')
  UNION ALL
  SELECT * EXCLUDE (id, label, bytes), greatest(bytes, size), CAST(5 + id AS INTEGER), label || '^miss'
  FROM mapped WHERE objstatus IN ('o', 'p')),
routed AS (SELECT *, serial AS true_serial, event_id AS tie1, 0 AS tie2, false AS sampled_out FROM copies)"""


@query("expansion_job", stack(EXPANSION_SQL, horizon=2632802).replace(
    "CAST(trunc(min(ts)) AS BIGINT) + 0", "greatest(1704067200, CAST(trunc(min(ts)) AS BIGINT))")
    + SUMMARY + """,
scaled AS (
  SELECT s.*, l.label, CASE WHEN l.label LIKE 'm1^f^%' THEN 4 ELSE 2 END AS k
  FROM summary s JOIN (SELECT DISTINCT shard, label FROM routed) l ON l.shard = s.shard)
SELECT shard, label, requests * k AS requests, bytes * k AS bytes, period_s,
  (stack_inflation + bypass_inflation) * k AS total_mib, distinct_objects * k AS footprint_objects,
  inserted_bytes * k AS footprint_bytes, peak_requests * k AS peak_requests,
  peak_bytes * k AS peak_bytes FROM scaled""")
def expansion_job(spark, sf_dir):
    """Label split with served and miss copies, overrides per network."""
    from cachecurve.plans.footprint import footprint
    from workload.views import VMN_LABELS, event_requests

    cfg = FootprintConfig(
        start_s=1704067200, end_s=1706700000, prewarm_from_config=True, split_by="vmn",
        vmn_labels=VMN_LABELS, mode="both", ignore_prefetch=True,
        prefetch_overrides="101:f:false", sample_at="map", sample_buckets=2,
        sample_overrides="m1:f:1:4")
    return footprint(event_requests(spark, sf_dir), cfg, EVENT_KEYS).header


@query("descriptor_text", EVENT_STACK + CURVE + SUMMARY + """
SELECT CAST(shard AS VARCHAR) AS label, -1 AS line_no, concat_ws(' ', '#', requests, bytes, period_s,
  stack_inflation + bypass_inflation, distinct_objects, inserted_bytes, peak_requests, peak_bytes) AS line
FROM summary
UNION ALL
SELECT CAST(c.shard AS VARCHAR), t, concat_ws(' ', t, std_mib, std_objects, c.requests, c.bytes,
  transition_bytes, transition_requests)
FROM curve c JOIN summary s ON s.shard = c.shard""")
def descriptor_text(spark, sf_dir):
    from cachecurve.sinks.tables import descriptor_text as text

    f = events(spark, sf_dir)
    return text(f.header, f.curve)
