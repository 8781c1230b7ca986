"""Whole jobs over log files made from the given tables, and results in parts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig, PathFilter, ReplicationConfig
from cachecurve.functions.columns import object_hex
from cachecurve.plans.jobs import FootprintJob, LogFiles, ReplicationJob, merged_parts
from cachecurve.plans.options import footprint_job, parse_options
from cachecurve.plans.replication import replication
from cachecurve.scratch import scratch_root
from cachecurve.sinks import tables
from workload.registry import ORACLES, query
from workload.replication_queries import CFG, COUNTS
from workload.request_queries import _line, with_requests
from workload.stack_queries import SUMMARY, header_sql, stack
from workload.views import REQUESTS_SQL, VMN_LABELS, event_requests

SERVERS = ("10.0.0.2", "10.0.0.0")
PATHS = {"day": "concat('2024-01-0', 1 + event_id % 3)", "arl": "10 + event_id % 2",
         "metro": "if((event_id div 2) % 2 = 0, 'ams', 'fra')", "server": "concat('10.0.0.', (event_id div 4) % 3)"}
SUFFIXES = (".gz", ".gz.key2", ".gz.key11")
#: Lines of a log file, which one task unpacks, at most.
FILE_LINES = 1 << 18


def scratch(spark, name):
    return f"{scratch_root(spark)}/cachecurve/{uuid.uuid4().hex}/{name}"


def write_tree(spark, sf_dir):
    """Events as log lines in ``<day>/<arl>/<metro>/fd_storelog_<server>_<n><suffix>``."""
    rows = event_requests(spark, sf_dir).select(
        F.expr(_line("format_string('%.3f', ts)")).alias("value"), *[F.expr(e).alias(c) for c, e in PATHS.items()])
    path, out = scratch(spark, "written"), scratch(spark, "log tree")
    rows.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).partitionBy(*PATHS).text(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for n, status in enumerate(store.globStatus(hadoop.Path(path, "*/*/*/*/part-*"))):
        day, arl, metro, server = (part.split("=")[1] for part in status.getPath().toString().split("/")[-5:-1])
        folder = hadoop.Path(f"{out}/{day}/{arl}/{metro}")
        store.mkdirs(folder)
        store.rename(status.getPath(), hadoop.Path(folder, f"fd_storelog_{server}_{n}{SUFFIXES[n % 3]}"))
    return out


def job(spark, sf_dir):
    files = LogFiles(write_tree(spark, sf_dir), PathFilter("2024-01-01", "2024-01-02", "10:ams, 11:ams:fra"))
    return FootprintJob(spark, files, FootprintConfig(servers=SERVERS, sample_pct=60.0, sample_seed=5))


_KEPT_SQL = REQUESTS_SQL + f""",
logged AS (SELECT *, {_line("printf('%.3f', ts)")} AS value FROM requests),
sampled AS (
  SELECT * FROM logged
  WHERE event_id % 3 IN (0, 1) AND (event_id % 2 = 1 OR (event_id // 2) % 2 = 0) AND (event_id // 4) % 3 IN (0, 2)
    AND ('0x' || substr(md5('5:' || value), 1, 8))::BIGINT < 2576980377)"""


@query("job_counters", f"""WITH {_KEPT_SQL},
reasons AS (
  SELECT CASE event_id % 10 WHEN 0 THEN 'comment' WHEN 5 THEN 'layout' WHEN 6 THEN 'serial' WHEN 7 THEN 'layout'
    WHEN 9 THEN 'layout' ELSE CASE WHEN objstatus = 'g' AND event_id % 10 <> 1 THEN 'icp' ELSE 'ok' END END AS reason
  FROM sampled),
names AS (SELECT unnest(['comment', 'layout', 'serial', 'icp', 'prefetch', 'time', 'filter', 'ok']) AS reason)
SELECT n.reason, count(r.reason) AS lines FROM names n LEFT JOIN reasons r USING (reason) GROUP BY ALL
UNION ALL SELECT 'routed', count(*) FROM reasons WHERE reason = 'ok'""")
def job_counters(spark, sf_dir):
    return job(spark, sf_dir).counter_table()


_JOB_STACK = stack(_KEPT_SQL + """,
routed AS (
  SELECT * REPLACE (CASE event_id % 10 WHEN 3 THEN max_age ELSE -1 END AS max_age), serial AS shard,
    serial AS true_serial, event_id AS tie1, 0 AS tie2, false AS sampled_out
  FROM sampled WHERE event_id % 10 IN (1, 2, 3, 4, 8) AND (objstatus <> 'g' OR event_id % 10 = 1))""")


@query("job_header", _JOB_STACK + SUMMARY + header_sql())
def job_header(spark, sf_dir):
    out = scratch(spark, "job")
    job(spark, sf_dir).write(out)
    return spark.read.parquet(f"{out}/header").withColumn("label", F.col("label").cast("string"))


@query("serial_text", _JOB_STACK + SUMMARY + """,
fresh AS (SELECT * FROM lnk WHERE NOT prewarm AND (prev_ts IS NULL OR trunc(prev_ts) < compute_start)),
news AS (SELECT shard, true_serial, count(*) AS n, sum(size) AS b FROM fresh GROUP BY ALL),
used AS (SELECT shard, true_serial, count(*) AS n, sum(bytes) AS b FROM req WHERE NOT prewarm GROUP BY ALL)
SELECT CAST(shard AS VARCHAR) AS label, concat_ws(' ', true_serial, u.n, u.b, period_s, coalesce(w.n, 0),
                                                  coalesce(w.b, 0)) AS line
FROM used u LEFT JOIN news w USING (shard, true_serial) JOIN summary USING (shard)""")
def serial_text(spark, sf_dir):
    out = scratch(spark, "job")
    tables.write_text(tables.serial_text(job(spark, sf_dir).footprint.serial_info), out)
    return spark.read.text(out).select(F.col("label").cast("string").alias("label"), F.col("value").alias("line"))


# --- replication in parts -------------------------------------------------------------------


def part_of(spark, sf_dir, where, path):
    """A part of the events' replication, as a job writes it."""
    from cachecurve.operators import replication as ops
    from cachecurve.plans.replication import replication_records

    records = replication_records(event_requests(spark, sf_dir).where(where), CFG)
    ops.server_rows(records, ("ts", "event_id")).write.parquet(path)
    return path


@query("replication_parts", COUNTS + " SELECT shard, md5, copies, size FROM counts")
def replication_parts(spark, sf_dir):
    """Two days that overlap and the rest, merged."""
    parts = [part_of(spark, sf_dir, where, scratch(spark, "part")) for where in
             ("event_id % 3 = 0", "event_id % 3 = 1 or event_id % 7 = 0", "event_id % 3 > 0 and event_id % 7 > 0")]
    return merged_parts(spark, *parts).counts.select(
        "shard", object_hex(F.col("obj")).alias("md5"), "copies", "size")


@query("replication_shard_text", COUNTS + " SELECT * FROM by_shard")
def replication_shard_text(spark, sf_dir):
    out = scratch(spark, "by_shard")
    tables.write_text(tables.replication_shard_text(
        replication(event_requests(spark, sf_dir), CFG, ("ts", "event_id")).by_shard), out)
    return tables.read_shard_text(spark, out)


@query("replication_job", f"""WITH {_KEPT_SQL.replace("sampled AS", "unused AS")},
marked AS (
  SELECT *, concat('10.0.0.', (event_id // 4) % 3) AS server FROM logged
  WHERE event_id % 3 IN (0, 1) AND event_id % 10 IN (1, 2, 3, 4, 8))
SELECT serial AS shard, md5, count(DISTINCT server) AS copies FROM marked GROUP BY ALL""")
def replication_job(spark, sf_dir):
    files = LogFiles(write_tree(spark, sf_dir), PathFilter("2024-01-01", "2024-01-02", "10:ams:fra, 11:ams:fra"))
    path = scratch(spark, "part")
    ReplicationJob(spark, files, ReplicationConfig(ip_from="filename")).write_part(path)
    return merged_parts(spark, path).counts.select("shard", object_hex(F.col("obj")).alias("md5"), "copies")


# --- jobs from option strings -----------------------------------------------------------------

_FULL_LINE = ("concat_ws(':', map, serial, format_string('%.3f', ts), md5, size, bytes, cpcode, if(objstatus = '', '-', objstatus),"
              " arlid, network, mapname, region, vcd, product)")


def write_logs(spark, sf_dir):
    out = scratch(spark, "full logs")
    event_requests(spark, sf_dir).select(F.expr(_FULL_LINE)).write.option("compression", "gzip") \
        .option("maxRecordsPerFile", FILE_LINES).text(out)
    return out


def write_list(spark, name, *lines):
    out = scratch(spark, name)
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(out)
    return out


@query("options_standard_job", ORACLES["standard_job"])
def options_standard_job(spark, sf_dir):
    """The standard run from option lines over log files."""
    options = parse_options("""NETWORK=FF
START_TIME=1704067200
END_TIME=1706000000
PREWARM_CONFIG_RELATIVE=1
URL_BUCKET=5
SAMPLE_ON_ATTEMPT=0
SAMPLE_BUCKETS=2
THINNING_PCT_JUMP=5
""")
    job, _, _ = footprint_job(spark, write_logs(spark, sf_dir), options)
    return job.footprint.curve


@query("options_expansion_job", ORACLES["expansion_job"])
def options_expansion_job(spark, sf_dir):
    """The expansion run: labels from a file, served and missed copies, overrides."""
    labels = write_list(spark, "labels", "# vcd map network label", *(" ".join(map(str, row)) for row in VMN_LABELS))
    out = scratch(spark, "expansion")
    options = {
        "START_TIME": "1704067200", "END_TIME": "1706700000", "PREWARM_CONFIG_RELATIVE": "true",
        "SPLIT_BY_VCD_MAP_NETWORK": "true", "VCD_MAP_NETWORK_FILE": labels, "COMPUTE_BOTH_SERVED_AND_MISS_FDS": "true",
        "IGNORE_PREFETCH_LINES": "true", "IGNORE_PREFETCH_OVERRIDE": "101:f:false", "SAMPLE_ON_ATTEMPT": "0",
        "SAMPLE_BUCKETS": "2", "SAMPLE_BUCKETS_OVERRIDE": "m1:f:1:4", "OUTPUT_DIR": out, "WRITE_SERIAL_INFO_FILE": "true"}
    job, folder, serials = footprint_job(spark, write_logs(spark, sf_dir), {f"JOB_{k}": v for k, v in options.items()}, "JOB_")
    job.write(folder, serials)
    return spark.read.parquet(f"{folder}/header")
