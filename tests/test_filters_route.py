import pytest
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig, ReplicationConfig
from cachecurve.operators import filters
from cachecurve.operators.parse import parse_requests
from cachecurve.plans.footprint import routed_requests
from cachecurve.plans.replication import replication_records
from tests.lru_model import digest

SCHEMA = ("i int, map string, serial int, ts double, md5 string, size bigint, bytes bigint, "
          "cpcode int, objstatus string, arlid int, network string, mapname string, region int, "
          "vcd int, product string, max_age int")


def request(i, map_="m", serial=3, ts=5.0, size=10, bytes_=4, cpcode=1, status="-", arlid=1,
            region=1, vcd=1):
    return (i, map_, serial, ts, digest(str(i)), size, bytes_, cpcode, status, arlid, "f", map_,
            region, vcd, "x", -1)


def routed(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    out = routed_requests(df, FootprintConfig(**options)).collect()
    return sorted((r.i, r.shard, r.bytes) for r in out)


def test_absent_region_passes_and_absent_vcd_fails(spark):
    rows = [request(1, region=None), request(2, region=9), request(3, vcd=None)]
    assert [r[0] for r in routed(spark, rows, regions="9")] == [1, 2]
    assert [r[0] for r in routed(spark, rows, regions="9", exclude_regions=True)] == [1, 3]
    with pytest.raises(Exception, match="no vcd"):
        routed(spark, rows, vcds="1")


def test_time_bounds_are_inclusive_also_with_or(spark):
    rows = [request(i, ts=float(i)) for i in range(1, 6)]
    assert [r[0] for r in routed(spark, rows, start_s=2, end_s=4)] == [2, 3, 4]
    assert [r[0] for r in routed(spark, rows, start_s=2, end_s=4, combine="OR", cpcodes="1")] == \
        [2, 3, 4]


def test_time_bounds_hold_for_the_time_before_rounding(spark):
    """Half a millisecond outside the range is outside, and records have rounded times."""
    times = ["9.9996", "10", "10.0004", "99.9996", "100", "100.0004"]
    lines = spark.createDataFrame(
        [(i, f"m:3:{t}:{digest(str(i))}:10:5:1:-") for i, t in enumerate(times)], "i int, value string")
    requests = parse_requests(lines)
    out = routed_requests(requests, FootprintConfig(start_s=10, end_s=100))
    assert "raw_ts" not in out.columns
    assert sorted((r.i, r.ts) for r in out.collect()) == [(1, 10.0), (2, 10.0), (3, 100.0), (4, 100.0)]
    records = replication_records(requests.withColumn("vcd", F.lit(1)), ReplicationConfig(start_s=10, end_s=100))
    assert sorted(r.i for r in records.collect()) == [1, 2, 3, 4]


def test_misses_only_inflates_and_ignores_prefetch_rules(spark):
    rows = [request(1, status="o"), request(2, status="pK"), request(3), request(4, status="og")]
    assert routed(spark, rows, mode="miss", ignore_prefetch=True) == [(1, 3, 10), (2, 3, 10)]


def test_both_copies(spark):
    rows = [request(1, status="o"), request(2, status="K"), request(3, status="oK"), request(4)]
    got = routed(spark, rows, split_by="cpcode", cpcodes="9,1", mode="both", ignore_prefetch=True)
    assert got == [(1, 1, 4), (1, 3, 10), (3, 3, 10), (4, 1, 4)]


def test_unknown_cpcode_is_dropped_unless_parity(spark):
    rows = [request(1, cpcode=1), request(2, cpcode=5, region=2)]
    options = dict(split_by="cpcode", cpcodes="7,1", regions="1,2", combine="OR")
    assert routed(spark, rows, **options) == [(1, 1, 4)]
    assert routed(spark, rows, parity=True, **options) == [(1, 1, 4), (2, 0, 4)]


def test_url_hash_falls_through_to_rehash_and_serial(spark):
    rows = [request(1, "a"), request(2, "b", serial=4), request(3, "b", serial=5)]
    got = routed(spark, rows, url_buckets=4, map_rules="a", cpcodes="1", combine="OR",
                 rehash_serials="4", rehash_buckets=1)
    assert got == [(1, int(digest("1")[:4], 16) % 4, 4), (2, 2048, 4), (3, 5, 4)]


def test_first_drop_rule_is_named(spark):
    rows = [request(1, status="g", ts=99.0), request(2, ts=99.0), request(3)]
    cfg = FootprintConfig(end_s=50)
    df = filters.classify(filters.prepare(spark.createDataFrame(rows, SCHEMA), cfg), cfg)
    assert {r.i: r.reject_reason for r in df.collect()} == {1: "icp", 2: "time", 3: None}


def test_sampling_keeps_whole_objects_and_scales(spark):
    from cachecurve.plans.footprint import Footprint

    rows = [request(i % 40, ts=float(i), serial=1) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = {i for i in range(40) if int(digest(str(i))[8:16], 16) % 3 == 0}
    cfg = FootprintConfig(sample_at="map", sample_buckets=3)
    head = Footprint(routed_requests(df, cfg), cfg, ("i",)).header.collect()[0]
    assert (head.requests, head.footprint_objects) == (len(kept) * 30, len(kept) * 3)
    cfg = FootprintConfig(sample_at="reduce", sample_buckets=3)
    head = Footprint(routed_requests(df, cfg), cfg, ("i",)).header.collect()
    scale = 400 // (10 * len(kept))
    if len(kept) / 40 > 0.7 / 3:
        assert (head[0].requests, head[0].footprint_objects) == (len(kept) * 10 * scale, 40 * scale)
    else:
        assert head == []
