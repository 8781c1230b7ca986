"""Routed requests kept for later jobs as a bucketed table.

Buckets are by shard and object part, so a hot shard lies in many of them, and all requests of an object lie
in one. Jobs that group by shard, part and object, or by these and more, read the table without any
exchange of requests; only their sums are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cachecurve.config import HORIZON_S
from cachecurve.functions.columns import is_digest, object_id, record_tail

BUCKETED = ("shard", "part")
SORTED = ("shard", "part", "obj", "ts")
#: Requests of a bucket, which one task writes and one task reads.
BUCKET_ROWS = 1 << 20


def bucket_count(routed: DataFrame, least: int) -> int:
    """Buckets for the requests: ``least`` times a power of two, so that one holds BUCKET_ROWS of them on average at most."""
    return least << math.ceil(math.log2(max(1.0, routed.count() / (least * BUCKET_ROWS))))


def write_bucketed(routed: DataFrame, table: str, path: str, buckets: int, parts: int = 1024) -> DataFrame:
    """Save routed requests with digests as ``table`` in the folder ``path``.

    ``parts`` is how many buckets at most hold one shard. Rows go to the task of their bucket first, so that each
    bucket is one sorted file.
    """
    rows = routed.where(is_digest(F.col("md5"))).withColumn("obj", object_id(F.col("md5"))) \
        .withColumn("part", F.pmod(F.xxhash64("obj"), F.lit(parts)).cast("int"))
    rows.repartition(buckets, *BUCKETED).write.bucketBy(buckets, *BUCKETED).sortBy(*SORTED) \
        .option("path", path).saveAsTable(table)
    return routed.sparkSession.table(table)


def attach_bucketed(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """The table of ``write_bucketed`` in another session, from its folder."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet OPTIONS (path '{path}') "
              f"CLUSTERED BY ({', '.join(BUCKETED)}) SORTED BY ({', '.join(SORTED)}) INTO {buckets} BUCKETS")
    return spark.table(table)


def reuse_counts(stage: DataFrame, horizon_s: int = HORIZON_S, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Re-references per shard and whole second of their interval, of requests of positive size."""
    by_object = Window.partitionBy(*BUCKETED, "obj").orderBy("ts", record_tail(), *tiebreak)
    t = (F.col("ts") - F.lag("ts").over(by_object)).try_cast("int")
    seen = stage.where("size > 0").select("shard", t.alias("t"))
    return seen.where(F.col("t").between(0, horizon_s - 1)).groupBy("shard", "t") \
        .agg(F.count("*").alias("requests"))


def object_totals(stage: DataFrame) -> DataFrame:
    """Requests, objects, objects seen once and bytes of every shard."""
    objects = stage.where("size > 0").groupBy(*BUCKETED, "obj").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("b"))
    return objects.groupBy("shard").agg(
        F.sum("n").alias("requests"), F.count("*").alias("objects"),
        F.count_if(F.col("n") == 1).alias("single_objects"), F.sum("b").alias("bytes"))
