"""Profiles and heads of the routed requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def route_profile(routed: DataFrame) -> DataFrame:
    """Lines, distinct shards and distinct digests of the routed requests."""
    pairs = routed.groupBy("shard", "md5").agg(F.count("*").alias("n"))
    return pairs.agg(F.sum("n").alias("lines"), F.count_distinct("shard").alias("shards"),
                     F.count_distinct("md5").alias("digests"))


def top_shards(routed: DataFrame, n: int = 20) -> DataFrame:
    """Shards with most requests; equal counts by shard number."""
    return routed.groupBy("shard").agg(F.count("*").alias("requests")) \
        .orderBy(F.desc("requests"), "shard").limit(n)


def head_per_shard(ordered: DataFrame, n: int = 5) -> DataFrame:
    """First requests of every shard. Each task cuts its rows to ``n`` per shard
    before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("shard").orderBy("pos"))
    return ordered.where("access").withColumn("rank", rank).where(F.col("rank") <= n)


def recency_rank(linked: DataFrame, k: int) -> DataFrame:
    """The ``k``-th most recently used object of every shard. An object's last access
    is the one without a successor; tasks cut to ``k`` per shard before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("shard").orderBy(F.desc("pos")))
    return linked.where("next_pos is null").withColumn("rank", rank).where(F.col("rank") == k)
