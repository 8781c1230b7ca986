"""Joins with configuration tables.

No broadcast hint is given: a table built from configuration has a known size, so
Spark broadcasts it while it is under the threshold and shuffles it otherwise. ``attach_split`` is
for lists read from files, which may be too long for that.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.scratch import save


def config_table(df: DataFrame, rows: Iterable[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(list(rows), schema)


def attach(df: DataFrame, table: DataFrame, **keys: Column) -> DataFrame:
    """Left join ``table`` on equality of its columns with the given expressions."""
    renamed = table.select(*[F.col(c).alias(f"_k_{c}") if c in keys else c
                             for c in table.columns])
    on = None
    for name, expr in keys.items():
        match = F.col(f"_k_{name}") == expr
        on = match if on is None else on & match
    return df.join(renamed, on, "left").drop(*[f"_k_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: dict[str, Column], parts: int) -> DataFrame:
    """Keys with more than a ``parts``-th of the rows, so fewer than ``parts`` of them, and into
    how many ``splits`` their rows are to be dealt. Counts are combined before the shuffle."""
    counts = save(df.select(*[c.alias(k) for k, c in keys.items()]).groupBy(*keys)
                  .agg(F.count("*").alias("n")), "key_counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    share = F.col("n") * parts
    return save(counts.where(share > total)
                .select(*keys, F.ceil(share / max(total, 1)).cast("int").alias("splits")), "hot_keys")


def attach_split(df: DataFrame, table: DataFrame, parts: int | None = None,
                 **keys: Column) -> DataFrame:
    """``attach`` for a table of any size, with any key as frequent as it likes.

    The rows of a hot key are dealt over its splits by a digest of the whole row, and the
    table's row of that key is repeated once a split; other keys have one split. ``parts`` is
    the number of tasks that a join has, by default the shuffle partitions.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(df, keys, parts)

    def splits(rows: DataFrame, named: dict[str, Column]) -> DataFrame:
        marked = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.col("splits").alias("_splits"))
        on = [F.col(f"_h_{k}") == c for k, c in named.items()]
        return rows.join(marked, on, "left").drop(*[f"_h_{k}" for k in keys]) \
            .withColumn("_splits", F.coalesce("_splits", F.lit(1)))

    dealt = splits(df, keys).withColumn(
        "_salt", F.pmod(F.xxhash64(*df.columns), F.col("_splits")).cast("int")).drop("_splits")
    repeated = splits(table, {k: F.col(k) for k in keys}).withColumn(
        "_split", F.explode(F.sequence(F.lit(0), F.col("_splits") - 1))).drop("_splits")
    return attach(dealt, repeated, **keys, _split=F.col("_salt")).drop("_salt")
