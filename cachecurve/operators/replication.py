"""How many servers hold each object."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def server_rows(records: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """A row for each server of an object, with the size and the place in ``order`` of its first
    record there. A hot object is reduced to its servers before it is shuffled."""
    key = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return records.groupBy("shard", "obj", "ip").agg(
        F.min(key).alias("first"), F.min_by("size", key).alias("size"))


def merged_servers(rows: DataFrame) -> DataFrame:
    """One row for each server of an object from the rows of several parts."""
    return rows.groupBy("shard", "obj", "ip").agg(
        F.min("first").alias("first"), F.min_by("size", "first").alias("size"))


def counts_of(servers: DataFrame) -> DataFrame:
    """Servers per (shard, object); the size is that of the object's first record."""
    return servers.groupBy("shard", "obj").agg(
        F.count("*").alias("copies"), F.min_by("size", "first").alias("size"))


def replica_counts(records: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    return counts_of(server_rows(records, order))


def replication_by_shard(counts: DataFrame) -> DataFrame:
    return counts.groupBy("shard", "copies").agg(
        F.count("*").alias("objects"), F.sum("size").alias("bytes"))


def replication_dist(by_shard: DataFrame) -> DataFrame:
    """Objects and bytes per copy count over all shards, with their shares in percent."""
    merged = by_shard.groupBy("copies").agg(F.sum("objects").alias("objects"),
                                            F.sum("bytes").alias("bytes"))
    every = Window.partitionBy()  # one row per copy count
    return merged.select(
        "copies", "objects",
        F.try_divide(F.col("objects") * 100.0, F.sum("objects").over(every)).alias("object_pct"),
        "bytes",
        F.try_divide(F.col("bytes") * 100.0, F.sum("bytes").over(every)).alias("byte_pct"))


def replication_summary(by_shard: DataFrame) -> DataFrame:
    """Unique and total objects and bytes, and their ratios."""
    copies = F.col("copies")
    return by_shard.agg(
        F.sum("objects").alias("unique_objects"),
        F.sum(F.col("objects") * copies).alias("total_objects"),
        F.sum("bytes").alias("unique_bytes"),
        F.sum(F.col("bytes") * copies).alias("total_bytes")) \
        .where("unique_objects > 0").select(
        "unique_objects", "total_objects",
        F.try_divide(F.col("total_objects") * 1.0, F.col("unique_objects")).alias("object_factor"),
        "unique_bytes", "total_bytes",
        F.try_divide(F.col("total_bytes") * 1.0, F.col("unique_bytes")).alias("byte_factor"))
