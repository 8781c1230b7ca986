"""Shapes the plans must keep at any scale."""

import re

import pytest

from cachecurve.config import FootprintConfig
from cachecurve.operators import describe, filters, profile
from cachecurve.plans.footprint import Footprint
from tests.test_distance import _random_trace, requests_df


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def job(spark):
    rows = _random_trace(1, 400, 3, 30, 0.4)
    return Footprint(requests_df(spark, rows), FootprintConfig(slice_rows=32, thinning_pct=5.0),
                     ("key",))


@pytest.mark.parametrize("table", ["linked", "distances", "histogram", "curve", "header",
                                   "serial_info", "hit_rates"])
def test_no_cross_joins_and_no_single_task(job, table):
    text = plan(getattr(job, table))
    assert not re.search("CartesianProduct|NestedLoopJoin|SinglePartition", text)


def test_histogram_shuffles_slices_and_sums_only(job):
    built = describe.reuse_histogram(job.linked, job.distance_parts)
    physical = plan(built).split("== Physical Plan ==")[1]
    keys = re.findall(r"Exchange hashpartitioning\(([a-z_]+)", physical)
    # the cells: laid out by q, summed by s, which is the slice they go to
    assert sorted(keys) == ["q", "s", "s", "shard", "slice"]
    assert "partial_sum" in physical


def test_curve_and_hit_rates_share_one_histogram(job):
    assert "CoGroup" in plan(describe.reuse_histogram(job.linked, job.distance_parts))
    for table in (job.curve, job.hit_rates, job.raw_curve):
        assert "CoGroup" not in plan(table)


def test_requests_meet_the_facts_of_their_shard_by_ranges(spark, job):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        physical = plan(job.requests.select("pos", "seq", "prewarm", "size")).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", physical)
    assert keys and all(k.startswith("_part") for k in keys)


def test_pieces_hold_each_shard_once_a_range(job):
    rows = job.pieces.collect()
    assert len({(r["_part"], r.shard) for r in rows}) == len(rows)
    assert sum(r.accesses for r in rows) == job.ordered.where("access").count()
    assert sum(r.lead for r in rows) == len({r.shard for r in rows})


def test_heads_are_cut_before_the_shuffle(job):
    for df in (profile.head_per_shard(job.ordered), profile.recency_rank(job.linked, 3)):
        assert "WindowGroupLimit" in plan(df)


def test_scan_reads_only_the_columns_asked_for(job):
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan(job.ordered.select("shard").distinct()))
    assert "bytes" not in schema[0] and "obj" not in schema[0]


def test_time_and_id_filters_reach_the_scan(spark, tmp_path):
    columns = ("map string, serial int, ts double, md5 string, size bigint, bytes bigint, cpcode int,"
               "objstatus string, arlid int, network string, mapname string, region int, vcd int,"
               "product string, max_age int")
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "r"))
    cfg = FootprintConfig(start_s=5, end_s=9, cpcodes="1,2")
    kept = filters.keep(filters.prepare(spark.read.parquet(str(tmp_path / "r")), cfg), cfg)
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(kept))[0]
    assert "GreaterThanOrEqual(ts,5.0)" in pushed and "In(cpcode" in pushed
