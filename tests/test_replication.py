from cachecurve.config import ReplicationConfig
from cachecurve.plans.replication import replication
from cachecurve.sinks.tables import replication_text
from tests.lru_model import digest

SCHEMA = "map string, serial int, ts double, md5 string, size bigint, cpcode int, region int, ip string"


def _requests(spark):
    rows = [("m", 3, 1.0, digest("A"), 10, 7, 1, "10.0.0.1"),
            ("m", 3, 2.0, digest("A"), 99, 7, 1, "10.0.0.2"),
            ("m", 3, 3.0, digest("A"), 10, 7, 1, "10.0.0.2"),
            ("m", 3, 1.0, digest("B"), 5, 7, 1, "10.0.0.1"),
            ("m", 3, 9.0, digest("C"), 1, 8, 1, "10.0.0.3"),
            ("m", 2042, 1.0, digest("D"), 2, 7, 1, "10.0.0.1")]
    return spark.createDataFrame(rows, SCHEMA)


def test_copies_and_factors(spark):
    r = replication(_requests(spark), ReplicationConfig())
    assert {(x.shard, x.copies): (x.objects, x.bytes) for x in r.by_shard.collect()} == \
        {(3, 2): (1, 10), (3, 1): (3, 8)}  # 2042 folds onto 3, sizes are the first seen
    s = r.summary.collect()[0]
    assert (s.unique_objects, s.total_objects, s.unique_bytes, s.total_bytes) == (4, 5, 18, 28)
    assert s.object_factor == 1.25
    shares = {d.copies: (d.object_pct, round(d.byte_pct, 2)) for d in r.dist.collect()}
    assert shares == {1: (75.0, 44.44), 2: (25.0, 55.56)}
    lines = [x.line for x in replication_text(r.summary, r.dist).orderBy("line_no").collect()]
    assert lines[1] == " 4 5 1.25 18 28 1.56" and lines[3:] == ["1 3 75.00 8 44.44", "2 1 25.00 10 55.56"]


def test_filters_and_url_shards(spark):
    cfg = ReplicationConfig(url_buckets=2, cpcodes="7", end_s=5)
    counts = replication(_requests(spark), cfg).counts.collect()
    assert {(c.shard, c.copies) for c in counts} == \
        {(int(digest(n)[:4], 16) % 2, c) for n, c in (("A", 2), ("B", 1), ("D", 1))}
    assert len(counts) == 3
