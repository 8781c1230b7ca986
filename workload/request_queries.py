"""Parsing, classification, filtering, sampling and routing of requests."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.functions import columns as C
from cachecurve.operators import filters, parse, profile, route
from cachecurve.plans.footprint import routed_requests
from workload.registry import query
from workload.views import (ARL_VCD, CPCODE_ACCOUNTS, REQUESTS_SQL, SERVERS, VMN_LABELS,
                            event_requests, routed_events)

BASE = FootprintConfig(ignore_icp=False)


def with_requests(body: str, more: str = "") -> str:
    return f"WITH {REQUESTS_SQL}{',' + more if more else ''}\n{body}"


def rejected(df):
    return df.select("event_id", F.coalesce("reject_reason", F.lit("ok")).alias("reason"))


# --- text layouts -----------------------------------------------------------------------

_HEAD = "concat(map, ':', serial, ':', {ts}, ':', md5, ':', size, ':', bytes, ':', cpcode"
_MID = "':', objstatus, ':', arlid, ':', network, ':', mapname, ':', region, ':'"


def _line(ts: str) -> str:
    head = _HEAD.format(ts=ts)
    return f"""CASE event_id % 10
      WHEN 0 THEN concat('# ', region, ' ', ip)
      WHEN 1 THEN {head})
      WHEN 2 THEN {head}, ':', objstatus)
      WHEN 3 THEN {head}, {_MID}, max_age)
      WHEN 4 THEN {head}, {_MID}, vcd, ':', product)
      WHEN 5 THEN concat(map, ':', serial, ':', md5)
      WHEN 6 THEN concat(map, ':0:', {ts}, ':', md5, ':', size, ':', bytes, ':', cpcode)
      WHEN 7 THEN concat(map, ':40000:', {ts}, ':', md5, ':', size, ':', bytes, ':', cpcode)
      WHEN 8 THEN {head}, ':', objstatus, ':junk')
      ELSE concat(':', serial, ':', {ts}, ':', md5, ':', size, ':', bytes, ':', cpcode) END"""


def event_lines(spark, sf_dir):
    """The events as log lines of every layout, comments and broken lines among them."""
    return event_requests(spark, sf_dir).select(
        "event_id", F.expr(_line("format_string('%.3f', ts)")).alias("value"))


_LAYOUT_SQL = """
typed AS (
  SELECT *, CASE event_id % 10 WHEN 1 THEN 7 WHEN 2 THEN 8 WHEN 3 THEN 13 WHEN 4 THEN 14
                               WHEN 6 THEN 7 WHEN 8 THEN 8 END AS layout FROM requests)"""

PARSED = ["event_id", "layout", "map", "serial", "ts", "md5", "size", "bytes", "cpcode",
          "objstatus", "arlid", "network", "mapname", "region", "vcd", "product", "max_age"]


@query("parse_layouts", with_requests("""
SELECT event_id, layout, map, serial, ts, md5, size, bytes, cpcode,
  CASE WHEN layout = 7 THEN '' ELSE objstatus END AS objstatus,
  CASE WHEN layout >= 13 THEN arlid END AS arlid,
  CASE WHEN layout >= 13 THEN network END AS network,
  CASE WHEN layout >= 13 THEN mapname END AS mapname,
  CASE WHEN layout >= 13 THEN region END AS region,
  CASE WHEN layout = 14 THEN vcd END AS vcd,
  CASE WHEN layout = 14 THEN product END AS product,
  CASE WHEN layout = 13 THEN max_age ELSE -1 END AS max_age
FROM typed WHERE layout IS NOT NULL AND event_id % 10 <> 6""", _LAYOUT_SQL))
def parse_layouts(spark, sf_dir):
    parsed = parse.parse_requests(event_lines(spark, sf_dir))
    return parsed.where("reject_reason is null").select(*PARSED)


@query("parse_replication_layouts", with_requests("""
SELECT event_id, CASE WHEN layout = 13 THEN 8 ELSE layout END AS layout, serial, md5, size,
  CASE WHEN layout = 14 THEN region END AS region
FROM typed WHERE layout IS NOT NULL AND event_id % 10 <> 6""", _LAYOUT_SQL))
def parse_replication_layouts(spark, sf_dir):
    parsed = parse.parse_requests(event_lines(spark, sf_dir), layouts=parse.REPLICATION_LAYOUTS)
    return parsed.where("reject_reason is null") \
        .select("event_id", "layout", "serial", "md5", "size", "region")


@query("reject_counters", with_requests("""
SELECT CASE event_id % 10 WHEN 0 THEN 'comment' WHEN 5 THEN 'layout' WHEN 6 THEN 'serial'
         WHEN 7 THEN 'layout' WHEN 9 THEN 'layout' ELSE 'ok' END AS reason, count(*) AS lines
FROM requests GROUP BY 1"""))
def reject_counters(spark, sf_dir):
    return parse.reject_counters(parse.parse_requests(event_lines(spark, sf_dir)))


RECORD_SQL = ("concat(shard, ':', printf('%.3f', ts), ':', md5, ':', size, ':', bytes, ':', cpcode,"
              " ':', true_serial, ':', max_age)")


@query("canonical_record", with_requests(f"""
SELECT event_id, {RECORD_SQL} AS record
FROM (SELECT *, serial AS shard, serial AS true_serial FROM requests)"""))
def canonical_record(spark, sf_dir):
    return routed_events(spark, sf_dir).select("event_id", C.record_text().alias("record"))


@query("parse_routed", with_requests("""
SELECT event_id, serial AS shard, ts, md5, size, bytes, cpcode,
  CASE WHEN event_id % 2 = 0 THEN serial ELSE -1 END AS true_serial,
  CASE WHEN event_id % 2 = 0 THEN max_age ELSE -1 END AS max_age
FROM requests WHERE event_id % 5 <> 4"""))
def parse_routed(spark, sf_dir):
    record = C.record_text()
    lines = routed_events(spark, sf_dir).select("event_id", F.when(
        F.expr("event_id % 5 = 4"), F.concat(F.lit("bad:"), "md5"))
        .when(F.expr("event_id % 2 = 0"), record)
        .otherwise(F.substring_index(record, ":", 6)).alias("value"))
    return parse.parse_routed(lines).select("event_id", "shard", "ts", "md5", "size", "bytes",
                                            "cpcode", "true_serial", "max_age")


@query("digest_and_ip_numbers", with_requests("""
SELECT event_id, ('0x' || substr(md5, 1, 4))::BIGINT AS hash4,
  ('0x' || substr(md5, 1, 2))::BIGINT AS hash2,
  CAST(split_part(ip, '.', 1) AS INTEGER) * 16777216 + CAST(split_part(ip, '.', 2) AS INTEGER) * 65536
    + CAST(split_part(ip, '.', 3) AS INTEGER) * 256 + CAST(split_part(ip, '.', 4) AS INTEGER) AS packed,
  CASE WHEN map IN ('101', '102') THEN CAST(map AS INTEGER) END AS map_id
FROM requests"""))
def digest_and_ip_numbers(spark, sf_dir):
    return event_requests(spark, sf_dir).select(
        "event_id", C.hex_prefix(F.col("md5"), 1, 4).alias("hash4"),
        C.hex_prefix(F.col("md5"), 1, 2).alias("hash2"),
        C.pack_ip(F.col("ip")).alias("packed"),
        C.numeric_map_id(F.col("map")).alias("map_id"))


# --- classification ---------------------------------------------------------------------

EXCEPTIONS = {5153: 2007, 3353: 2008, 566: 2009, 152: 1999}


@query("serial_translate", """
WITH s AS (SELECT event_id, CAST(1 + (user_id * 151) % 15999 AS INTEGER) AS slot FROM events)
SELECT event_id, slot % 2048 AS ff, slot % 4096 AS cw,
  CASE slot WHEN 5153 THEN 2007 WHEN 3353 THEN 2008 WHEN 566 THEN 2009 WHEN 152 THEN 1999
    ELSE slot % 2000 END AS essl
FROM s""")
def serial_translate(spark, sf_dir):
    slots = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.expr("cast(1 + (user_id * 151) % 15999 as int)").alias("slot"))

    def on(network):
        cfg = FootprintConfig(network=network, slot_exceptions=EXCEPTIONS)
        return parse.translate_serial(F.col("slot"), cfg)

    return slots.select("event_id", on("FF").alias("ff"), on("CW").alias("cw"),
                        on("ESSL").alias("essl"))


@query("status_flags", with_requests("""
SELECT event_id, objstatus IN ('o', 'p') AS is_miss, objstatus = 'g' AS is_icp,
  objstatus = 'K' AS is_prefetch FROM requests"""))
def status_flags(spark, sf_dir):
    return parse.status_flags(event_requests(spark, sf_dir)) \
        .select("event_id", "is_miss", "is_icp", "is_prefetch")


@query("miss_inflate", with_requests("""
SELECT event_id, CASE WHEN objstatus IN ('o', 'p') THEN greatest(bytes, size) ELSE bytes END AS bytes
FROM requests"""))
def miss_inflate(spark, sf_dir):
    cfg = replace(BASE, mode="miss")
    return filters.prepare(event_requests(spark, sf_dir), cfg).select("event_id", "bytes")


@query("arl_vcd_fill", with_requests("""
SELECT event_id, CAST(CASE WHEN vcd <> 0 THEN vcd WHEN arlid = 10 THEN 1 WHEN arlid = 11 THEN 2
  ELSE vcd END AS INTEGER) AS vcd FROM requests"""))
def arl_vcd_fill(spark, sf_dir):
    return filters.fill_vcd(event_requests(spark, sf_dir), replace(BASE, arl_vcd=ARL_VCD)) \
        .select("event_id", "vcd")


# --- filters ----------------------------------------------------------------------------


def kept(spark, sf_dir, cfg):
    return filters.keep(filters.prepare(event_requests(spark, sf_dir), cfg), cfg)


START, END = 1704500000, 1705500000


@query("time_filter", with_requests(f"""
SELECT event_id, ts FROM requests WHERE ts BETWEEN {START} AND {END}"""))
def time_filter(spark, sf_dir):
    return kept(spark, sf_dir, replace(BASE, start_s=START, end_s=END)).select("event_id", "ts")


@query("map_rules", with_requests("""
SELECT event_id, map,
  CASE map WHEN 'm1' THEN 0 WHEN 'm2' THEN 1 WHEN '101' THEN 2 WHEN '102' THEN 2 ELSE -1 END AS listed,
  CASE map WHEN 'm1' THEN 0 WHEN 'm2' THEN 0 WHEN 'm3' THEN 1 ELSE -1 END AS grouped,
  CASE map WHEN 'm1' THEN 0 WHEN 'm2' THEN 1 WHEN '101' THEN 3 WHEN '102' THEN 4 ELSE -1 END AS by_id
FROM requests"""))
def map_rules(spark, sf_dir):
    df = event_requests(spark, sf_dir)
    for name, cfg in (("listed", replace(BASE, map_rules="m1,m2,100-102")),
                      ("grouped", replace(BASE, map_rules="(m1,m2)(m3,101)")),
                      ("by_id", replace(BASE, map_rules="m1,m2,100-102", split_by="mapid"))):
        df = filters.add_map_index(df, cfg).withColumnRenamed("map_index", name)
    return df.select("event_id", "map", "listed", "grouped", "by_id")


FILTERS = dict(map_rules="m1,101", cpcodes="1000,1002,1003", vcds=[1], exclude_vcds=True,
               regions="1:2:3")
_FILTER_SQL = "map IN ('m1', '101') {0} cpcode IN (1000, 1002, 1003) {0} vcd <> 1 {0} region IN (1, 2, 3)"


@query("filters_and", with_requests(
    f"SELECT event_id FROM requests WHERE {_FILTER_SQL.format('AND')}"))
def filters_and(spark, sf_dir):
    return kept(spark, sf_dir, replace(BASE, **FILTERS)).select("event_id")


@query("filters_or", with_requests(
    f"SELECT event_id FROM requests WHERE {_FILTER_SQL.format('OR')}"))
def filters_or(spark, sf_dir):
    return kept(spark, sf_dir, replace(BASE, combine="OR", **FILTERS)).select("event_id")


@query("filter_exclusions", with_requests("""
SELECT event_id FROM requests WHERE cpcode NOT IN (1000, 1001) AND region NOT IN (4)"""))
def filter_exclusions(spark, sf_dir):
    cfg = replace(BASE, cpcodes="1000,1001", exclude_cpcodes=True, regions="4",
                  exclude_regions=True)
    return kept(spark, sf_dir, cfg).select("event_id")


@query("or_without_filters", with_requests("""
SELECT event_id, 'filter' AS unset, CASE WHEN cpcode = 1003 OR region = 2 THEN 'ok' ELSE 'filter' END AS reason
FROM requests"""))
def or_without_filters(spark, sf_dir):
    """OR takes an unset filter as false, so that all requests go if none is set."""
    def reasons(**options):
        cfg = replace(BASE, combine="OR", **options)
        return rejected(filters.classify(filters.prepare(event_requests(spark, sf_dir), cfg), cfg))

    return reasons().withColumnRenamed("reason", "unset").join(reasons(cpcodes="1003", regions="2"), "event_id")


_NEAR = "{base} + (event_id % 9 - 4) * 0.00025"


@query("time_bounds", with_requests(f"""
SELECT event_id, round(near, 3) AS ts FROM (
  SELECT event_id, CAST(printf('%.5f', CAST(CASE WHEN event_id % 2 = 0 THEN {_NEAR.format(base=START)}
                                                 ELSE {_NEAR.format(base=END)} END AS DOUBLE)) AS DOUBLE) AS near
  FROM requests)
WHERE near BETWEEN {START} AND {END}"""))
def time_bounds(spark, sf_dir):
    """Times within a millisecond of the range: tested as they stand in the line, rounded in the record."""
    text = "concat('m1:1:', format_string('%.5f', cast({near} as double)), ':', md5, ':', size, ':', bytes, ':', cpcode)"
    lines = event_requests(spark, sf_dir).select("event_id", F.when(
        F.expr("event_id % 2 = 0"), F.expr(text.format(near=_NEAR.format(base=START))))
        .otherwise(F.expr(text.format(near=_NEAR.format(base=END)))).alias("value"))
    cfg = replace(BASE, start_s=START, end_s=END)
    requests = parse.parse_requests(lines).where("reject_reason is null")
    return filters.keep(filters.prepare(requests, cfg), cfg).select("event_id", "ts")


HASH_SQL = "('0x' || substr(md5, 9, 8))::BIGINT"


@query("spatial_sample", with_requests(f"""
SELECT event_id, CASE WHEN mapname = 'm1' THEN 2 ELSE 3 END AS filter_buckets,
  CASE WHEN mapname = 'm1' THEN 4 ELSE 3 END AS unshard_buckets
FROM requests WHERE {HASH_SQL} % CASE WHEN mapname = 'm1' THEN 2 ELSE 3 END = 0"""))
def spatial_sample(spark, sf_dir):
    cfg = replace(BASE, sample_at="map", sample_buckets=3, sample_overrides="m1:f:2:4^bad:f:1")
    return kept(spark, sf_dir, cfg).select("event_id", "filter_buckets", "unshard_buckets")


@query("random_sample", with_requests(f"""
SELECT event_id FROM (SELECT event_id, {_line("printf('%.3f', ts)")} AS value FROM requests)
WHERE ('0x' || substr(md5('17:' || value), 1, 8))::BIGINT < 1073741824"""))
def random_sample(spark, sf_dir):
    return filters.sample_lines(event_lines(spark, sf_dir), 25.0, 17).select("event_id")


@query("misses_only", with_requests("""
SELECT event_id, greatest(bytes, size) AS bytes FROM requests WHERE objstatus IN ('o', 'p')"""))
def misses_only(spark, sf_dir):
    return kept(spark, sf_dir, FootprintConfig(mode="miss")).select("event_id", "bytes")


@query("drop_icp_prefetch", with_requests("""
SELECT event_id FROM requests WHERE objstatus <> 'g' AND NOT (objstatus = 'K' AND vcd <> 1)"""))
def drop_icp_prefetch(spark, sf_dir):
    cfg = FootprintConfig(ignore_prefetch=True, prefetch_overrides="keep:f:false")
    requests = event_requests(spark, sf_dir).withColumn(
        "mapname", F.when(F.col("vcd") == 1, "keep").otherwise(F.col("mapname")))
    return filters.keep(filters.prepare(requests, cfg), cfg).select("event_id")


@query("reject_reasons", with_requests(f"""
SELECT event_id, CASE WHEN objstatus = 'g' THEN 'icp' WHEN objstatus = 'K' THEN 'prefetch'
  WHEN NOT ts BETWEEN {START} AND {END} THEN 'time' WHEN cpcode <> 1001 THEN 'filter'
  ELSE 'ok' END AS reason FROM requests"""))
def reject_reasons(spark, sf_dir):
    cfg = FootprintConfig(ignore_prefetch=True, start_s=START, end_s=END, cpcodes="1001")
    return rejected(filters.classify(filters.prepare(event_requests(spark, sf_dir), cfg), cfg))


@query("accounts_only", with_requests("""
SELECT event_id, cpcode, 0 AS shard FROM requests WHERE cpcode IN (1003, 1004)"""))
def accounts_only(spark, sf_dir):
    cfg = replace(BASE, accounts="a2", cpcode_accounts=CPCODE_ACCOUNTS, split_by="account")
    return routed_requests(event_requests(spark, sf_dir), cfg).select("event_id", "cpcode", "shard")


# --- routing ----------------------------------------------------------------------------


def routed(spark, sf_dir, cfg, *columns):
    found = routed_requests(event_requests(spark, sf_dir), cfg)
    return route.add_labels(found, cfg).select("event_id", "shard", "label", *columns)


HASH4_SQL = "('0x' || substr(md5, 1, 4))::BIGINT"
HASH2_SQL = "('0x' || substr(md5, 1, 2))::BIGINT"


@query("route_url_hash", with_requests(f"""
SELECT event_id, shard, CAST(shard AS VARCHAR) AS label FROM (
  SELECT event_id, CAST(CASE map WHEN 'm1' THEN {HASH4_SQL} % 16 WHEN 'm2' THEN 16 + {HASH4_SQL} % 16
    ELSE serial END AS INTEGER) AS shard
  FROM requests WHERE map IN ('m1', 'm2') OR cpcode = 1003)"""))
def route_url_hash(spark, sf_dir):
    cfg = replace(BASE, url_buckets=16, map_rules="m1,m2", cpcodes="1003", combine="OR")
    return routed(spark, sf_dir, cfg)


@query("route_url_hash_servers", with_requests(f"""
SELECT event_id, CAST((CAST(split_part(ip, '.', 3) AS INTEGER)) * 8 + {HASH4_SQL} % 8 AS INTEGER) AS shard
FROM requests WHERE ip IN {SERVERS}"""))
def route_url_hash_servers(spark, sf_dir):
    from cachecurve.sources.logs import keep_servers

    cfg = replace(BASE, url_buckets=8, servers=SERVERS)
    logged = event_requests(spark, sf_dir).withColumn(
        "file", F.concat(F.lit("x/fd_storelog_"), "ip", F.lit("_"), "event_id", F.lit(".gz")))
    return routed_requests(keep_servers(logged, list(SERVERS)), cfg).select("event_id", "shard")


@query("route_cpcode", with_requests("""
SELECT event_id, CASE cpcode WHEN 1003 THEN 0 WHEN 1000 THEN 1 ELSE 2 END AS shard,
  CAST(cpcode AS VARCHAR) AS label FROM requests WHERE cpcode IN (1003, 1000, 1004)"""))
def route_cpcode(spark, sf_dir):
    return routed(spark, sf_dir, replace(BASE, split_by="cpcode", cpcodes="1003,1000,1004"))


@query("route_mapid", with_requests("""
SELECT event_id, CASE map WHEN 'm1' THEN 0 WHEN '101' THEN 2 ELSE 3 END AS shard,
  CASE map WHEN 'm1' THEN '0' ELSE map END AS label
FROM requests WHERE map IN ('m1', '101', '102')"""))
def route_mapid(spark, sf_dir):
    return routed(spark, sf_dir, replace(BASE, split_by="mapid", map_rules="m1,100-102"))


@query("route_rehash", with_requests(f"""
SELECT event_id, CAST(CASE serial WHEN 2 THEN 2048 + {HASH2_SQL} % 4 WHEN 4 THEN 2052 + {HASH2_SQL} % 4
  WHEN 5 THEN 2056 + {HASH2_SQL} % 4 ELSE serial END AS INTEGER) AS shard
FROM requests"""))
def route_rehash(spark, sf_dir):
    cfg = replace(BASE, rehash_serials="2,4-6", rehash_buckets=4)
    return routed(spark, sf_dir, cfg).select("event_id", "shard")


@query("rehash_only", with_requests("""
SELECT event_id, CASE serial WHEN 2 THEN 0 WHEN 4 THEN 1 ELSE 2 END AS shard,
  CAST(serial AS VARCHAR) AS label
FROM requests WHERE serial IN (2, 4, 5)"""))
def rehash_only(spark, sf_dir):
    cfg = replace(BASE, rehash_serials="2,4-6", rehash_buckets=1, rehash_only=True,
                  rehash_from_zero=True, label_rehashed_serial=True)
    return routed(spark, sf_dir, cfg)


@query("route_account", with_requests("""
SELECT event_id, CASE WHEN cpcode = 1003 THEN 1 ELSE 0 END AS shard,
  CASE WHEN cpcode = 1003 THEN 'a2' ELSE 'a1' END AS label FROM requests"""))
def route_account(spark, sf_dir):
    return routed(spark, sf_dir, replace(BASE, split_by="account",
                                         cpcode_accounts=CPCODE_ACCOUNTS))


_VMN_SQL = """
vmn(vcd, mapname, network, label, id) AS (VALUES (0, 'm1', 'f', 'm1^f^v0', 0),
  (1, 'm1', 'f', 'm1^f^v1', 1), (1, 'm2', 'f', 'm2^f^v1', 2), (2, 'm3', 'f', 'm3^f^v2', 3),
  (0, '101', 'f', '101^f^v0', 4)),
mapped AS (SELECT r.*, id, label FROM requests r JOIN vmn USING (vcd, mapname, network))"""


@query("route_vmn_served_miss", with_requests("""
SELECT event_id, CAST(id AS INTEGER) AS shard, label, bytes FROM mapped WHERE objstatus <> 'K'
UNION ALL
SELECT event_id, CAST(5 + id AS INTEGER), label || '^miss', greatest(bytes, size) FROM mapped
WHERE objstatus IN ('o', 'p')""", _VMN_SQL))
def route_vmn_served_miss(spark, sf_dir):
    cfg = replace(BASE, split_by="vmn", vmn_labels=VMN_LABELS, mode="both", ignore_prefetch=True)
    return routed(spark, sf_dir, cfg, "bytes")


@query("top_shards", with_requests("""
SELECT cpcode AS shard, count(*) AS requests FROM requests GROUP BY 1
ORDER BY requests DESC, shard LIMIT 20"""))
def top_shards(spark, sf_dir):
    return profile.top_shards(event_requests(spark, sf_dir).withColumn("shard", F.col("cpcode")))


@query("map_profile", with_requests("""
SELECT count(*) AS lines, count(DISTINCT serial) AS shards, count(DISTINCT md5) AS digests
FROM requests"""))
def map_profile(spark, sf_dir):
    return profile.route_profile(routed_events(spark, sf_dir))
