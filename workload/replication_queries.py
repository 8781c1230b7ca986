"""Copies of objects over servers."""

from __future__ import annotations

from cachecurve.config import ReplicationConfig
from cachecurve.functions.columns import object_hex
from cachecurve.plans.replication import replication
from pyspark.sql import functions as F
from workload.registry import query
from workload.views import REQUESTS_SQL, event_requests

CFG = ReplicationConfig(url_buckets=5)


def run(spark, sf_dir, cfg=CFG):
    return replication(event_requests(spark, sf_dir), cfg, ("ts", "event_id"))


COUNTS = f"""WITH {REQUESTS_SQL},
counts AS (
  SELECT CAST(('0x' || substr(md5, 1, 4))::BIGINT % 5 AS INTEGER) AS shard, md5,
    count(DISTINCT ip) AS copies, min_by(size, (ts, event_id)) AS size
  FROM requests GROUP BY ALL),
by_shard AS (SELECT shard, copies, count(*) AS objects, CAST(sum(size) AS BIGINT) AS bytes
  FROM counts GROUP BY ALL)"""


@query("replica_counts", COUNTS + " SELECT shard, md5, copies, size FROM counts")
def replica_counts(spark, sf_dir):
    return run(spark, sf_dir).counts.select("shard", object_hex(F.col("obj")).alias("md5"),
                                            "copies", "size")


@query("replication_by_shard", COUNTS + " SELECT * FROM by_shard")
def replication_by_shard(spark, sf_dir):
    return run(spark, sf_dir).by_shard


@query("replication_dist", COUNTS + """
SELECT copies, CAST(sum(objects) AS BIGINT) AS objects,
  sum(objects) * 100.0 / sum(sum(objects)) OVER () AS object_pct, CAST(sum(bytes) AS BIGINT) AS bytes,
  sum(bytes) * 100.0 / sum(sum(bytes)) OVER () AS byte_pct
FROM by_shard GROUP BY copies""")
def replication_dist(spark, sf_dir):
    return run(spark, sf_dir).dist


@query("replication_summary", COUNTS + """
SELECT CAST(sum(objects) AS BIGINT) AS unique_objects,
  CAST(sum(objects * copies) AS BIGINT) AS total_objects,
  CAST(sum(objects * copies) AS DOUBLE) / sum(objects) AS object_factor,
  CAST(sum(bytes) AS BIGINT) AS unique_bytes, CAST(sum(bytes * copies) AS BIGINT) AS total_bytes,
  CAST(sum(bytes * copies) AS DOUBLE) / sum(bytes) AS byte_factor FROM by_shard""")
def replication_summary(spark, sf_dir):
    return run(spark, sf_dir).summary


@query("replication_by_serial", f"""WITH {REQUESTS_SQL}
SELECT shard, md5, count(DISTINCT ip) AS copies FROM (
  SELECT serial % 2039 AS shard, md5, ip FROM requests WHERE cpcode IN (1000, 1001)
    AND ts BETWEEN 1704500000 AND 1705500000)
GROUP BY ALL""")
def replication_by_serial(spark, sf_dir):
    cfg = ReplicationConfig(cpcodes="1000,1001", start_s=1704500000, end_s=1705500000)
    return run(spark, sf_dir, cfg).counts.select(
        "shard", object_hex(F.col("obj")).alias("md5"), "copies")


@query("replication_wrapped", f"""WITH {REQUESTS_SQL},
far AS (SELECT * REPLACE (CAST(1 + event_id * 37 % 9000 AS INTEGER) AS serial) FROM requests)
SELECT serial % 2039 AS shard, md5, count(DISTINCT ip) AS copies FROM far GROUP BY ALL""")
def replication_wrapped(spark, sf_dir):
    """Serials above the modulus."""
    requests = event_requests(spark, sf_dir).withColumn("serial", F.expr("cast(1 + event_id * 37 % 9000 as int)"))
    return replication(requests, ReplicationConfig(), ("ts", "event_id")).counts.select(
        "shard", object_hex(F.col("obj")).alias("md5"), "copies")


@query("replication_ties", f"""WITH {REQUESTS_SQL},
tied AS (SELECT * REPLACE (floor(ts / 86400) AS ts, size + event_id % 5 AS size) FROM requests)
SELECT CAST(('0x' || substr(md5, 1, 4))::BIGINT % 5 AS INTEGER) AS shard, md5,
  count(DISTINCT ip) AS copies, min_by(size, (ts, event_id)) AS size FROM tied GROUP BY ALL""")
def replication_ties(spark, sf_dir):
    """Many first records at one time; the line order settles whose size counts."""
    tied = event_requests(spark, sf_dir).withColumns({
        "ts": F.floor(F.col("ts") / 86400).cast("double"), "size": F.expr("size + event_id % 5"),
        "file": F.lit("x"), "block_start": F.lit(0), "line_no": F.col("event_id")})
    return replication(tied, CFG).counts.select(
        "shard", object_hex(F.col("obj")).alias("md5"), "copies", "size")
