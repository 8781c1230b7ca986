"""Lists as tables: skew-split joins, and a list of millions of lines."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.operators.lookup import attach, attach_split, hot_keys
from cachecurve.operators.route import _split_id
from cachecurve.sources.lists import Lists, content_lines


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 2, 7, 50])
def test_split_join_is_the_plain_join(spark, no_broadcast, parts):
    left = spark.range(2000).select(
        "id", F.expr("case when id % 3 = 0 then 5 when id % 11 = 0 then null else id % 400 end").alias("k"),
        F.expr("if(id % 2 = 0, 'x', 'y')").alias("m"))
    table = spark.range(300).select((F.col("id") % 290).alias("key"), F.expr("if(id % 3 = 0, 'x', 'y')").alias("name"),
                                    F.col("id").alias("found"))
    keys = {"key": F.col("k"), "name": F.col("m")}
    assert rows(attach_split(left, table, parts, **keys)) == rows(attach(left, table, **keys))
    assert rows(attach_split(left.limit(0), table, parts, **keys)) == []
    assert rows(attach_split(left, table.limit(0), parts, **keys)) == rows(attach(left, table.limit(0), **keys))


def test_hot_keys_are_few_and_known(spark):
    df = spark.range(1000).select(F.expr("if(id % 3 = 0, 0, id)").alias("k"))
    hot = hot_keys(df, {"k": F.col("k")}, 20).collect()
    assert [(r.k, r.splits) for r in hot] == [(0, 7)]


def test_hot_rows_are_spread(spark, no_broadcast):
    df = spark.range(40_000).select("id", F.lit(3).alias("k"))
    table = spark.createDataFrame([(3, "three")], "key int, name string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = attach_split(df, table, 16, key=F.col("k")).where("name = 'three'") \
            .groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) == 40_000 and len(sizes) == 4  # all shuffle partitions of the tests


def test_millions_of_list_lines(spark):
    n = 5_000_000
    lines = content_lines(spark.range(n).select(
        F.col("id").alias("line_no"), F.expr("concat(id, ' a', id % 1000000)").alias("value")))
    cfg = FootprintConfig(split_by="account", lists=Lists.of(accounts=lines))
    assert cfg.copies_base() == 1_000_000
    requests = spark.range(300_000).select("id", F.expr("cast(if(id % 3 = 0, 77, id * 16) as int)").alias("cpcode"))
    found = _split_id(requests, cfg)
    wrong = found.where(~F.col("_id").eqNullSafe(F.expr("if(cpcode < 5000000, cpcode % 1000000, null)")))
    assert found.count() == 300_000 and wrong.count() == 0


def test_options_that_do_not_go_together(spark):
    lines = spark.createDataFrame([(0, "1 f m l")], "line_no bigint, value string")
    lists = Lists.of(accounts=spark.createDataFrame([(0, "1 a")], "line_no bigint, value string"))
    with pytest.raises(ValueError):
        FootprintConfig(lists=lists, accounts="a")
    with pytest.raises(ValueError):
        FootprintConfig(split_by="vmn", lists=lists)
    assert FootprintConfig(split_by="vmn", mode="both", lists=Lists.of(vmns=lines)).expected_shards() == 2
    with pytest.raises(ValueError):
        replace(FootprintConfig(split_by="account", mode="both", lists=lists), num_shards=1)
