"""Routing and filtering by lists as long as the tables, one key of which has a third of the requests."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from cachecurve.operators import route
from cachecurve.plans.footprint import routed_requests
from cachecurve.scratch import scratch_root
from cachecurve.sources.lists import Lists, content_lines
from workload.registry import query
from workload.request_queries import with_requests
from workload.views import PLAIN, event_requests

BASE = replace(PLAIN, ignore_icp=False)

_SKEWED_SQL = """
skewed AS (SELECT r.* REPLACE (
    CAST(CASE WHEN event_id % 3 = 0 THEN 1007 ELSE 1000 + event_id END AS INTEGER) AS cpcode,
    CAST(CASE WHEN event_id % 3 = 1 THEN 7 WHEN event_id % 3 = 2 THEN event_id ELSE 0 END AS INTEGER) AS vcd,
    CAST(event_id AS INTEGER) AS arlid) FROM requests r)"""


def skewed(spark, sf_dir):
    return event_requests(spark, sf_dir).withColumns({
        "cpcode": F.expr("cast(if(event_id % 3 = 0, 1007, 1000 + event_id) as int)"),
        "vcd": F.expr("cast(case event_id % 3 when 1 then 7 when 2 then event_id else 0 end as int)"),
        "arlid": F.expr("cast(event_id as int)")})


def list_lines(spark, sf_dir, *texts):
    """A list with a line for each event and text; a null text is no line."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.posexplode(F.array(*map(F.expr, texts))))
    return content_lines(rows.where("col is not null").select(
        (F.col("event_id") * len(texts) + F.col("pos")).alias("line_no"), F.col("col").alias("value")))


def routed(spark, sf_dir, cfg, *columns):
    found = routed_requests(skewed(spark, sf_dir), cfg)
    return route.add_labels(found, cfg).select("event_id", "shard", "label", *columns)


@query("list_accounts", with_requests("""
SELECT event_id, CAST(id AS INTEGER) AS shard, account AS label FROM skewed JOIN low USING (cpcode) JOIN ids USING (id)""",
    _SKEWED_SQL + """,
pairs AS (
  SELECT 2 * event_id AS line_no, 1000 + event_id AS cpcode, 'a' || (event_id % 97) AS account FROM ev
  UNION ALL SELECT 2 * event_id + 1, 1000 + event_id, 'b' || (event_id % 13) FROM ev WHERE event_id % 5 = 0),
ids AS (SELECT account, row_number() OVER (ORDER BY min(line_no)) - 1 AS id FROM pairs GROUP BY account),
low AS (SELECT cpcode, min(id) AS id FROM pairs JOIN ids USING (account) GROUP BY cpcode)"""))
def list_accounts(spark, sf_dir):
    lines = list_lines(spark, sf_dir, "concat(1000 + event_id, ' a', event_id % 97)",
                       "if(event_id % 5 = 0, concat(1000 + event_id, ' b', event_id % 13), null)")
    return routed(spark, sf_dir, replace(BASE, split_by="account", lists=Lists.of(accounts=lines)))


@query("list_vmns_arls", with_requests("""
SELECT event_id, CAST(id AS INTEGER) AS shard, label, bytes FROM mapped
UNION ALL
SELECT event_id, CAST((SELECT count(*) FROM ev) + id AS INTEGER), label || '^miss', greatest(bytes, size) FROM mapped
WHERE objstatus IN ('o', 'p')""", _SKEWED_SQL + """,
filled AS (SELECT * REPLACE (CASE WHEN vcd = 0 THEN CAST(event_id % 50 AS INTEGER) ELSE vcd END AS vcd) FROM skewed),
vmns AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS id, event_id % 400 AS vcd, map AS mapname, network,
                map || '^f^v' || event_id AS label FROM requests),
lasts AS (SELECT vcd, mapname, network, max(id) AS id, max_by(label, id) AS label FROM vmns GROUP BY ALL),
mapped AS (SELECT f.*, id, label FROM filled f JOIN lasts USING (vcd, mapname, network))"""))
def list_vmns_arls(spark, sf_dir):
    events = event_requests(spark, sf_dir)
    vmns = content_lines(events.select(F.col("event_id").alias("line_no"), F.expr(
        "concat(event_id % 400, ' ', map, ' f ', map, '^f^v', event_id)").alias("value")))
    arls = list_lines(spark, sf_dir, "concat(event_id, ' ', 1 + event_id % 50)", "concat(event_id, '  ', event_id % 50)")
    return routed(spark, sf_dir, replace(BASE, split_by="vmn", mode="both", lists=Lists.of(vmns=vmns, arls=arls)), "bytes")


@query("list_cpcodes", with_requests("""
SELECT event_id, CAST(position AS INTEGER) AS shard, CAST(cpcode AS VARCHAR) AS label
FROM skewed JOIN places USING (cpcode)""", _SKEWED_SQL + """,
listed AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS position, 1000 + event_id - event_id % 2 AS cpcode
           FROM ev WHERE event_id % 7 <> 0),
places AS (SELECT cpcode, max(position) AS position FROM (
             SELECT * FROM listed UNION ALL SELECT (SELECT count(*) FROM listed), 1007) GROUP BY cpcode)"""))
def list_cpcodes(spark, sf_dir):
    path = f"{scratch_root(spark)}/cachecurve/{uuid.uuid4().hex}/cpcodes"
    ids = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 7 <> 0").select(
        "event_id", F.expr("1000 + event_id - event_id % 2").alias("cpcode"))
    last = ids.agg((F.max("event_id") + 1).alias("event_id"), F.lit(1007).cast("bigint").alias("cpcode"))
    ids.unionByName(last).repartitionByRange("event_id").sortWithinPartitions("event_id") \
        .select(F.concat("cpcode", F.lit("  # listed"))).write.text(path)
    return routed(spark, sf_dir, replace(BASE, split_by="cpcode", lists=Lists.read(spark, cpcodes=path)))


@query("list_accounts_only", with_requests("""
SELECT event_id, cpcode FROM skewed WHERE (cpcode - 1000) % 97 IN (3, 7)
  AND cpcode - 1000 IN (SELECT event_id FROM ev)""", _SKEWED_SQL))
def list_accounts_only(spark, sf_dir):
    lines = list_lines(spark, sf_dir, "concat(1000 + event_id, ' a', event_id % 97)")
    cfg = replace(BASE, lists=Lists.of(accounts=lines, only=["a3", "a7"]))
    return routed_requests(skewed(spark, sf_dir), cfg).select("event_id", "cpcode")
