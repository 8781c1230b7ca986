"""Path rules, configuration lists and log files made from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cachecurve.config import PathFilter
from cachecurve.operators import parse
from cachecurve.scratch import scratch_root
from cachecurve.sources import lists, logs, paths
from workload.registry import query
from workload.request_queries import event_lines, with_requests
from workload.views import REQUESTS_SQL, SERVERS, event_requests

DAY = "date_format(cast(timestamp_seconds(ts) as date), 'yyyy-MM-dd')"
DAY_SQL = "strftime(make_timestamp(CAST(floor(ts) AS BIGINT) * 1000000), '%Y-%m-%d')"


def listing(spark, sf_dir):
    """One log path per event, some of them outside every rule."""
    suffix = "element_at(array('.gz', '.gz.key2', '.GZ.KEY13', '.key2.gz'), cast(event_id % 4 + 1 as int))"
    return event_requests(spark, sf_dir).withColumns({
        "day": F.expr(DAY), "suffix": F.expr(suffix)}).select(
        "event_id", "suffix", "ip",
        F.expr("""concat('/logs/', case when event_id % 11 = 0 then 'today' else day end,
                  case when event_id % 13 = 0 then '' else concat('/', arlid, '/', map) end,
                  '/fd_storelog_', case when event_id % 2 = 0 then '' else concat(region, '_') end,
                  ip, '_', event_id, suffix)""").alias("file"),
        F.expr("""concat('/logs/', day, '/', map, '/', network, '/', vcd, '/', region,
                  case when event_id % 13 = 0 then '' else '/part' end)""").alias("deep_file"))


@query("path_filter_date_metro", with_requests(f"""
SELECT event_id FROM (SELECT *, {DAY_SQL} AS day FROM requests)
WHERE event_id % 11 <> 0 AND day BETWEEN '2024-01-05' AND '2024-01-20' AND event_id % 13 <> 0
  AND ((arlid = 10 AND map IN ('m1', 'm2')) OR (arlid = 12 AND map = '101'))"""))
def path_filter_date_metro(spark, sf_dir):
    rule = PathFilter("2024-01-05", "2024-01-20", "10:m1:m2, 12:101")
    return paths.filter_paths(listing(spark, sf_dir), rule, base="/logs").select("event_id")


@query("path_whitelist", with_requests(f"""
SELECT event_id FROM (SELECT *, {DAY_SQL} AS day FROM requests)
WHERE event_id % 13 <> 0 AND day IN ('2024-01-05', '2024-01-06', '2024-01-07')
  AND map IN ('m1', 'm2', '101') AND network = 'f' AND vcd IN (0, 2) AND region IN (1, 3)"""))
def path_whitelist(spark, sf_dir):
    files = listing(spark, sf_dir)
    allowed = paths.whitelist_table(files, [
        "# comment", "2024-01-05 m1 f:0 1", "2024-01-06  m2 f:2 3", "2024-01-07 101 f:0 1", "short"])
    return paths.whitelist_paths(files, allowed, base="/logs", path="deep_file").select("event_id")


@query("path_whitelist_strict", with_requests(f"""
SELECT event_id FROM (SELECT *, {DAY_SQL} AS day FROM requests)
WHERE event_id % 13 <> 0 AND ((day = '2024-01-05' AND map = 'm1' AND vcd = 0 AND region = 1)
  OR (day = '2024-01-06' AND map = 'm2' AND vcd = 2 AND region = 3))"""))
def path_whitelist_strict(spark, sf_dir):
    files = listing(spark, sf_dir)
    allowed = paths.whitelist_table(files, ["2024-01-05 m1 f:0 1", "2024-01-06 m2 f:2 3"])
    return paths.whitelist_paths(files, allowed, base="/logs", path="deep_file",
                                 strict=True).select("event_id")


@query("server_file_filter", with_requests(f"""
SELECT event_id, ip, CAST(split_part(ip, '.', 3) AS INTEGER) AS server_index FROM requests
WHERE ip IN {SERVERS}"""))
def server_file_filter(spark, sf_dir):
    return logs.keep_servers(listing(spark, sf_dir), list(SERVERS)) \
        .select("event_id", "ip", "server_index")


@query("key_index", with_requests("""
SELECT event_id, CASE event_id % 4 WHEN 1 THEN '2' WHEN 2 THEN '13' ELSE '1' END AS key_index
FROM requests"""))
def key_index(spark, sf_dir):
    return listing(spark, sf_dir).select("event_id", logs.key_index(F.col("file")).alias("key_index"))


# --- lists ------------------------------------------------------------------------------


def _list_lines(spark, sf_dir, text):
    return lists.content_lines(event_requests(spark, sf_dir).select(
        F.col("event_id").alias("line_no"), F.expr(text).alias("value")))


@query("id_list", with_requests("""
SELECT event_id AS line_no, CAST(user_id AS INTEGER) AS id FROM ev
WHERE event_id % 4 <> 0 AND user_id > 0"""))
def id_list(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("line_no"), F.expr(
            "case event_id % 4 when 0 then concat('# ', user_id) else concat(user_id, ' x') end")
        .alias("value"))
    return lists.id_table(lists.content_lines(lines))


@query("ip_list", with_requests("""
SELECT event_id AS line_no, ip, CAST(split_part(ip, '.', 1) AS INTEGER) * 16777216
    + CAST(split_part(ip, '.', 2) AS INTEGER) * 65536
    + CAST(split_part(ip, '.', 3) AS INTEGER) * 256 + CAST(split_part(ip, '.', 4) AS INTEGER) AS packed
FROM requests WHERE event_id % 5 <> 0"""))
def ip_list(spark, sf_dir):
    lines = _list_lines(spark, sf_dir, "if(event_id % 5 = 0, concat(' ', ip), ip)")
    return lists.ip_table(lines)


@query("account_ids", with_requests("""
SELECT cpcode, min(account_id) AS account_id, min_by(account, account_id) AS account FROM (
  SELECT cpcode, p.account, account_id FROM pairs p JOIN (
    SELECT account, CAST(row_number() OVER (ORDER BY min(event_id)) - 1 AS INTEGER) AS account_id
    FROM pairs GROUP BY account) USING (account))
GROUP BY cpcode""", """
pairs AS (SELECT event_id, CAST(10 + user_id % 200 AS INTEGER) AS cpcode,
                 concat('acc', (user_id * 7) % 31) AS account FROM ev)"""))
def account_ids(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("line_no"),
        F.expr("concat(10 + user_id % 200, ' acc', (user_id * 7) % 31)").alias("value"))
    return lists.account_table(lists.content_lines(lines))


@query("vmn_ids", with_requests("""
SELECT vcd, map, network, concat(map, '^f^', region) AS label,
  CAST(row_number() OVER (ORDER BY event_id) - 1 AS INTEGER) AS id
FROM requests WHERE event_id % 3 <> 0"""))
def vmn_ids(spark, sf_dir):
    lines = _list_lines(spark, sf_dir, """case event_id % 3 when 0 then '# c'
        else concat(vcd, ' ', map, '  ', network, ' ', map, '^f^', region) end""")
    return lists.vmn_table(lines)


@query("arl_vcds", with_requests("""
SELECT CAST(user_id AS INTEGER) AS arlid, max_by(CAST(k AS INTEGER), event_id) AS vcd
FROM ev GROUP BY 1"""))
def arl_vcds(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("line_no"),
        F.expr("concat(user_id, ' ', get_json_object(props, '$.k'))").alias("value"))
    return lists.arl_table(lists.content_lines(lines))


# --- files ------------------------------------------------------------------------------


def _write_logs(spark, sf_dir, name):
    """Event lines as gzip logs in the shared scratch folder."""
    path = f"{scratch_root(spark)}/cachecurve/{uuid.uuid4().hex}/{name}"
    event_lines(spark, sf_dir).withColumn("arlid", F.expr("event_id % 3")) \
        .select("value", "arlid").write.option("compression", "gzip") \
        .partitionBy("arlid").text(path)
    return path


_FILE_SQL = """
typed AS (
  SELECT *, CASE event_id % 10 WHEN 1 THEN 7 WHEN 2 THEN 8 WHEN 3 THEN 13 WHEN 4 THEN 14
                               WHEN 8 THEN 8 END AS layout FROM requests)"""


@query("gz_read", with_requests("""
SELECT layout, count(*) AS lines, CAST(sum(bytes) AS BIGINT) AS bytes FROM typed
WHERE layout IS NOT NULL GROUP BY layout""", _FILE_SQL))
def gz_read(spark, sf_dir):
    lines = logs.read_logs(spark, _write_logs(spark, sf_dir, "logs"))
    return parse.parse_requests(lines).where("reject_reason is null").groupBy("layout") \
        .agg(F.count("*").alias("lines"), F.sum("bytes").alias("bytes"))


def _name_logs(spark, path):
    """Give the files of ``_write_logs`` names of logs, most of them with a key."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for arl, suffix in enumerate((".gz", ".gz.key2", ".gz.key13")):
        for n, status in enumerate(store.globStatus(hadoop.Path(folder, f"arlid={arl}/part-*")) or []):
            store.rename(status.getPath(), hadoop.Path(folder, f"arlid={arl}/fd_storelog_10.0.{arl}.1_{n}{suffix}"))


@query("gz_key_read", with_requests("""
SELECT layout, CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '13' END AS key_index,
       concat('10.0.', event_id % 3, '.1') AS ip, count(*) AS lines, CAST(sum(bytes) AS BIGINT) AS bytes
FROM typed WHERE layout IS NOT NULL GROUP BY ALL""", _FILE_SQL))
def gz_key_read(spark, sf_dir):
    path = _write_logs(spark, sf_dir, "keyed logs 100%")
    _name_logs(spark, path)
    typed = parse.parse_requests(logs.read_logs(spark, path)).where("reject_reason is null")
    return typed.groupBy("layout", logs.key_index(F.col("file")).alias("key_index"),
                         logs.server_ip(F.col("file")).alias("ip")) \
        .agg(F.count("*").alias("lines"), F.sum("bytes").alias("bytes"))


@query("comment_servers", f"""
WITH {REQUESTS_SQL},
marked AS (
  SELECT *, max(CASE WHEN event_id % 10 = 0 THEN event_id END)
    OVER (PARTITION BY cpcode ORDER BY event_id) AS mark FROM requests)
SELECT m.event_id, coalesce(c.ip, '10.9.9.9') AS ip FROM marked m
LEFT JOIN requests c ON c.event_id = m.mark""")
def comment_servers(spark, sf_dir):
    lines = event_lines(spark, sf_dir).join(
        event_requests(spark, sf_dir).select("event_id", "cpcode"), "event_id")
    blocks = lines.select(
        "event_id", "value",
        F.concat(F.lit("/x/fd_storelog_10.9.9.9_"), "cpcode", F.lit(".gz")).alias("file"),
        F.expr("event_id div 500").alias("block_start"), F.col("event_id").alias("line_no"))
    return logs.add_server(blocks).select("event_id", "ip")


@query("debug_stage_text", with_requests("""
SELECT serial AS shard, ts, md5, size, bytes, cpcode, serial AS true_serial, max_age FROM requests"""))
def debug_stage_text(spark, sf_dir):
    from cachecurve.sinks.tables import routed_text
    from workload.views import routed_events

    path = f"{scratch_root(spark)}/cachecurve/{uuid.uuid4().hex}/routed"
    routed_text(routed_events(spark, sf_dir)).select("value").write.text(path)
    return parse.parse_routed(logs.read_lines(spark, path)).select(
        "shard", "ts", "md5", "size", "bytes", "cpcode", "true_serial", "max_age")
