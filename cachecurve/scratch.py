"""Intermediate tables in the cluster's shared checkpoint folder.

Row numbers depend on how rows fell into partitions, so a numbered table must be
computed once and read many times. It is written as parquet to shared storage:
later stages prune columns, Spark knows the real sizes, and a lost executor costs
a re-read and never a renumbering.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; where it is unset, a folder of this
    machine in a local trial and an error on a cluster, whose machines share none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _local_roots.setdefault(app, "") or tempfile.mkdtemp(prefix="cachecurve-")
        _local_roots[app] = root
    return root.rstrip("/")


def save(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/cachecurve/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
