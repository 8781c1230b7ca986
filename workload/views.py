"""Request logs derived from the given tables, the same way in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.sources.logs import spread

CPCODE_ACCOUNTS = ((1000, "a1"), (1001, "a1"), (1002, "a1"), (1003, "a2"), (1004, "a2"),
                   (1004, "a1"))
VMN_LABELS = ((0, "m1", "f", "m1^f^v0"), (1, "m1", "f", "m1^f^v1"), (1, "m2", "f", "m2^f^v1"),
              (2, "m3", "f", "m3^f^v2"), (0, "101", "f", "101^f^v0"))
ARL_VCD = ((10, 1), (11, 7), (11, 2))
SERVERS = ("10.0.0.0", "10.0.1.1", "10.0.2.2", "10.0.3.3", "10.0.4.4", "10.0.5.5", "10.0.6.6")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _millis(ts: str):
    return F.expr(f"(unix_micros(cast({ts} as timestamp)) + 500) div 1000")


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event: few objects, much reuse, fractional timestamps."""
    e = spread(_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts", "props"), "event_id").select(
        "event_id", "user_id", "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (_millis("ts") / 1000.0).cast("double").alias("ts"))
    e = e.withColumn("size", F.expr("if(event_id % 97 = 0, 0, 1048576 * (1 + k % 7))")
                     .cast("bigint"))
    maps = F.create_map(*[F.lit(x) for p in (("click", "m1"), ("view", "m2"), ("error", "m3"),
                                             ("purchase", "101"), ("signup", "102")) for x in p])
    flags = F.create_map(*[F.lit(x) for p in (("click", "-"), ("view", "p"), ("error", "o"),
                                              ("purchase", "K"), ("signup", "g")) for x in p])
    return e.select(
        "event_id",
        maps[F.col("event_type")].alias("map"),
        F.expr("1 + user_id % 8").cast("int").alias("serial"),
        "ts",
        F.upper(F.substring(F.md5(F.col("k").cast("string")), 1, 16)).alias("md5"),
        "size",
        F.expr("greatest(size - (event_id % 3) * 1000, 0)").alias("bytes"),
        F.expr("1000 + user_id % 5").cast("int").alias("cpcode"),
        flags[F.col("event_type")].alias("objstatus"),
        F.expr("10 + user_id % 3").cast("int").alias("arlid"),
        F.lit("f").alias("network"),
        maps[F.col("event_type")].alias("mapname"),
        F.expr("1 + user_id % 4").cast("int").alias("region"),
        F.expr("user_id % 3").cast("int").alias("vcd"),
        F.lit("x").alias("product"),
        F.expr("if(k % 2 = 0, 3600, -1)").alias("max_age"),
        F.expr("concat('10.0.', user_id % 7, '.', user_id % 11)").alias("ip"))


def item_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per line item: many objects, many requests at the same time."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    li = spread(_table(spark, sf_dir, "lineitem").select(*columns, "l_shipdate"),
                "l_orderkey", "l_partkey").select(
        *columns, (_millis("l_shipdate") / 1000.0).cast("double").alias("ts"))
    part = _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.expr("65536L * p_size").alias("size"))
    return li.join(part, "l_partkey").select(
        "l_orderkey", "l_linenumber",
        F.expr("1 + l_suppkey % 16").cast("int").alias("serial"),
        "ts",
        F.upper(F.substring(F.md5(F.col("l_partkey").cast("string")), 1, 16)).alias("md5"),
        "size",
        F.expr("cast(floor(size * l_quantity / 50) as bigint)").alias("bytes"),
        F.expr("cast(1000 + l_suppkey % 5 as int)").alias("cpcode"),
        F.lit(-1).alias("max_age"))


def routed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events routed by serial, with every request kept."""
    return event_requests(spark, sf_dir).withColumns(
        {"shard": F.col("serial"), "true_serial": F.col("serial")})


def routed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_requests(spark, sf_dir).withColumns(
        {"shard": F.col("serial"), "true_serial": F.col("serial")})


EVENT_KEYS = ("event_id",)
ITEM_KEYS = ("l_orderkey", "l_linenumber")
PLAIN = FootprintConfig()

# --- the same views in SQL --------------------------------------------------------------

REQUESTS_SQL = """
ev AS (
  SELECT event_id, user_id, event_type, CAST(props->>'$.k' AS INTEGER) AS k,
         ((epoch_us(ts) + 500) // 1000) / 1000.0 AS ts
  FROM events),
ev_sized AS (
  SELECT *, CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE 1048576 * (1 + k % 7) END AS BIGINT) AS size
  FROM ev),
requests AS (
  SELECT event_id,
    CASE event_type WHEN 'click' THEN 'm1' WHEN 'view' THEN 'm2' WHEN 'error' THEN 'm3'
                    WHEN 'purchase' THEN '101' WHEN 'signup' THEN '102' END AS map,
    CAST(1 + user_id % 8 AS INTEGER) AS serial,
    CAST(ts AS DOUBLE) AS ts,
    upper(substr(md5(CAST(k AS VARCHAR)), 1, 16)) AS md5,
    size,
    greatest(size - (event_id % 3) * 1000, 0) AS bytes,
    CAST(1000 + user_id % 5 AS INTEGER) AS cpcode,
    CASE event_type WHEN 'click' THEN '-' WHEN 'view' THEN 'p' WHEN 'error' THEN 'o'
                    WHEN 'purchase' THEN 'K' WHEN 'signup' THEN 'g' END AS objstatus,
    CAST(10 + user_id % 3 AS INTEGER) AS arlid,
    'f' AS network,
    CASE event_type WHEN 'click' THEN 'm1' WHEN 'view' THEN 'm2' WHEN 'error' THEN 'm3'
                    WHEN 'purchase' THEN '101' WHEN 'signup' THEN '102' END AS mapname,
    CAST(1 + user_id % 4 AS INTEGER) AS region,
    CAST(user_id % 3 AS INTEGER) AS vcd,
    'x' AS product,
    CASE WHEN k % 2 = 0 THEN 3600 ELSE -1 END AS max_age,
    concat('10.0.', user_id % 7, '.', user_id % 11) AS ip
  FROM ev_sized)"""

ITEMS_SQL = """
items AS (
  SELECT l_orderkey, l_linenumber, CAST(1 + l_suppkey % 16 AS INTEGER) AS serial,
    ((epoch_us(l_shipdate) + 500) // 1000) / 1000.0 AS ts,
    upper(substr(md5(CAST(l_partkey AS VARCHAR)), 1, 16)) AS md5,
    CAST(65536 * p_size AS BIGINT) AS size,
    CAST(floor(CAST(65536 * p_size AS BIGINT) * l_quantity / 50) AS BIGINT) AS bytes,
    CAST(1000 + l_suppkey % 5 AS INTEGER) AS cpcode, -1 AS max_age
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""
