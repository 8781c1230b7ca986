"""Descriptor and replication outputs, as parquet tables and in their text form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cachecurve.functions.columns import record_text

HEADER_FIELDS = ("requests", "bytes", "period_s", "total_mib", "footprint_objects",
                 "footprint_bytes", "peak_requests", "peak_bytes")
CURVE_FIELDS = ("t", "std_mib", "std_objects", "requests", "bytes", "transition_bytes",
                "transition_requests")
SERIAL_FIELDS = ("serial", "requests", "bytes", "period_s", "unique_objects", "unique_bytes")


def write_table(table: DataFrame, path: str, label: str = "label") -> None:
    """Parquet, one folder per label; rows of a label are brought together first so
    that a run does not leave a small file per task and label."""
    table.repartition(label).write.mode("overwrite").partitionBy(label).parquet(path)


def descriptor_text(header: DataFrame, curve: DataFrame) -> DataFrame:
    """``label``, ``line_no`` and ``line``: a ``#`` header line and the curve rows."""
    head = header.select("label", F.lit(-1).alias("line_no"),
                         F.concat_ws(" ", F.lit("#"), *HEADER_FIELDS).alias("line"))
    rows = curve.select("label", F.col("t").alias("line_no"),
                        F.concat_ws(" ", *CURVE_FIELDS).alias("line"))
    return head.unionByName(rows)


def serial_text(info: DataFrame) -> DataFrame:
    return info.select("label", F.col("serial").alias("line_no"),
                       F.concat_ws(" ", *SERIAL_FIELDS).alias("line"))


def write_text(text: DataFrame, path: str) -> None:
    """One ordered text file per label, below ``label=<label>``."""
    text.repartition("label").sortWithinPartitions("label", "line_no") \
        .select("label", "line").write.mode("overwrite").partitionBy("label").text(path)


def replication_text(summary: DataFrame, dist: DataFrame) -> DataFrame:
    """Merged replication report: factors, then the distribution by copy count."""

    def two(name: str):
        return F.format_string("%.2f", name)

    # The titles of the report.
    titles = [
        (0, "uniqueCount, totalCount, countReplFactor, uniqueSize, totalSize, sizeReplFactor"),
        (2, "CopyCount objectCount countFraction uniqueFootprintSize sizeFraction")]
    heads = summary.sparkSession.createDataFrame(titles, "line_no bigint, line string")
    factors = summary.select(F.lit(1).cast("bigint").alias("line_no"), F.concat(
        F.lit(" "), F.concat_ws(" ", "unique_objects", "total_objects", two("object_factor"),
                                "unique_bytes", "total_bytes", two("byte_factor"))).alias("line"))
    rows = dist.select((F.col("copies") + 2).alias("line_no"), F.concat_ws(
        " ", "copies", "objects", two("object_pct"), "bytes", two("byte_pct")).alias("line"))
    return heads.unionByName(factors).unionByName(rows)


def replication_shard_text(by_shard: DataFrame) -> DataFrame:
    """The distribution of every shard, as ``copies objects bytes`` lines for ``write_text``."""
    return by_shard.select(F.col("shard").cast("string").alias("label"), F.col("copies").alias("line_no"),
                           F.concat_ws(" ", "copies", "objects", "bytes").alias("line"))


def read_shard_text(spark: SparkSession, *paths: str) -> DataFrame:
    """``shard copies objects bytes`` from files of ``replication_shard_text``; other lines fail."""
    lines = spark.read.option("basePath", paths[0]).text(paths[0])
    for path in paths[1:]:
        lines = lines.unionByName(spark.read.option("basePath", path).text(path))
    fields = F.split(F.trim("value"), r"\s+")
    typed = [F.get(fields, F.lit(k)).cast("bigint").alias(name)
             for k, name in enumerate(("copies", "objects", "bytes"))]
    return lines.select(F.col("label").cast("int").alias("shard"), *typed)


def routed_text(routed: DataFrame) -> DataFrame:
    """Routed records as text, for inspection and for a later run."""
    return routed.select("shard", record_text().alias("value"))


def write_stage(stage: DataFrame, path: str) -> None:
    """Dump of an intermediate table."""
    stage.write.mode("overwrite").parquet(path)
