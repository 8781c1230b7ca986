"""Log files as lines that know their file and their order in it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cachecurve.functions.columns import pack_ip
from cachecurve.sources.views import as_gzip, listed_name

LINE_ORDER = ("file", "block_start", "line_no")
_CHUNK_BITS = 18


def list_logs(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``length`` of all files below ``path`` with ``.gz`` in the name."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True) \
        .option("pathGlobFilter", "*.gz*").load(path).select(F.col("path").alias("file"), "length")


def key_index(path: Column) -> Column:
    """Number of a ``.keyN`` suffix, ``1`` without one."""
    return F.coalesce(F.nullif(F.regexp_extract(path, r"(?i)\.key(\d+)$", 1), F.lit("")),
                      F.lit("1"))


Prune = Callable[[DataFrame], DataFrame]


def read_lines(spark: SparkSession, *paths: str, glob: str | None = None,
               prune: Prune | None = None) -> DataFrame:
    """Text or gzip lines; Spark picks the codec by file name.

    ``(file, block_start, line_no)`` is the order of a file's lines. ``prune`` filters on
    ``file``; its conditions reach the file listing, so that other files are not read.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(list(paths)).select(
        "value", listed_name(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"))
    lines = prune(lines) if prune else lines
    return lines.withColumn("line_no", F.monotonically_increasing_id())


def spread(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """Deal an input that comes in few partitions, such as a few large gzip files, to ``tasks``
    tasks, by default as many as the cluster runs at once. Leave it out where the input fills the cluster.

    ``keys`` that tell rows apart save the sort of a round-robin shuffle. The number is given, as adaptive
    execution would merge small partitions into one task again.
    """
    return df.repartition(tasks or df.sparkSession.sparkContext.defaultParallelism, *keys)


def read_gzip_lines(files: DataFrame) -> DataFrame:
    """Lines of gzip files whose name hides the codec, such as ``x.gz.key2``.

    ``files`` needs ``file``, as ``list_logs`` spells it. Spark reads the files by another name
    (see ``views``), so they are opened through the session's file systems and unpacked in the JVM, each as one
    stream, and dealt to tasks by their sizes. Names go to the driver, as those of any input do.
    """
    spark = files.sparkSession
    lines = None
    for prefix, names in as_gzip(spark, [row.file for row in files.select("file").toLocalIterator()]):
        found = spark.read.text(names).select(
            "value", listed_name(F.col("_metadata.file_path"), prefix).alias("file"),
            F.col("_metadata.file_block_start").alias("block_start"))
        lines = found if lines is None else lines.unionByName(found)
    if lines is None:
        lines = spark.createDataFrame([], "value string, file string, block_start bigint")
    return lines.withColumn("line_no", F.monotonically_increasing_id())


def read_logs(spark: SparkSession, path: str, prune: Prune | None = None) -> DataFrame:
    """Lines of all logs below ``path``, or of the files that ``prune`` keeps.

    Plain ``.gz`` files go through Spark's text reader, the others through
    ``read_gzip_lines``.
    """
    hidden = list_logs(spark, path).where(~F.col("file").rlike(r"\.gz$"))
    hidden = prune(hidden) if prune else hidden
    plain = read_lines(spark, path, glob="*.gz", prune=prune)
    return plain.unionByName(read_gzip_lines(hidden))


def server_ip(path: Column) -> Column:
    """Server of a log file ``fd_storelog_[<region>_]<a.b.c.d>_...``, else null."""
    found = F.regexp_extract(
        path, r"(?:^|/)fd_storelog_(?:-?\d+_)?(\d+\.\d+\.\d+\.\d+)[^/]*$", 1)
    return F.nullif(found, F.lit(""))


def _packed(ip: str) -> int:
    value = int.from_bytes(bytes(map(int, ip.split("."))), "big")
    return value - (1 << 32) if value >> 31 else value


def listed_server(path: Column, servers: list[str]) -> Column:
    """Whether a log file's server is listed; as ``prune`` it skips whole files."""
    return pack_ip(server_ip(path)).isin([_packed(ip) for ip in servers])


def keep_servers(lines: DataFrame, servers: list[str], file: str = "file") -> DataFrame:
    """Lines of files of the listed servers, with the server's position in the list.

    Files of other servers, or with no server in their name, contribute nothing.
    """
    if not servers:
        return lines
    table = lines.sparkSession.createDataFrame(
        list({_packed(ip): i for i, ip in enumerate(servers)}.items()),
        "_server int, server_index int")
    return lines.join(table, pack_ip(server_ip(F.col(file))) == F.col("_server")).drop("_server")


def comment_ip(value: Column) -> Column:
    """Server of a comment line ``# <region> <a.b.c.d>``, else null."""
    found = F.regexp_extract(value, r"^#\s*-?\d+\s+(\d+\.\d+\.\d+\.\d+)", 1)
    return F.nullif(found, F.lit(""))


def add_server(lines: DataFrame, ip_from: str = "comment") -> DataFrame:
    """``ip`` of every line: the last comment before it in its file, else the file name.

    A file is handled in chunks of its lines, and what a chunk passes on is one row,
    so that a huge file does not end up in one task.
    """
    named = server_ip(F.col("file"))
    if ip_from == "filename":
        return lines.withColumn("ip", named)
    lines = lines.withColumn("_comment", comment_ip(F.col("value")))
    lines = lines.withColumn("_chunk", F.shiftright("line_no", _CHUNK_BITS))
    chunk = ["file", "block_start", "_chunk"]
    tails = lines.groupBy(*chunk).agg(F.max_by(
        "_comment", F.when(F.col("_comment").isNotNull(), F.col("line_no"))).alias("_tail"))
    before = Window.partitionBy("file").orderBy("block_start", "_chunk") \
        .rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*chunk, F.last("_tail", ignorenulls=True).over(before).alias("_carry"))
    within = Window.partitionBy(*chunk).orderBy("line_no") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = lines.withColumn("_here", F.last("_comment", ignorenulls=True).over(within))
    return here.join(carried, chunk) \
        .withColumn("ip", F.coalesce("_here", "_carry", named)) \
        .drop("_comment", "_here", "_carry", "_chunk")
