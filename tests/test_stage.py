"""The bucketed stage: later jobs exchange sums only, and give what the requests give."""

import re
import uuid
from collections import Counter

from pyspark.sql import functions as F

from cachecurve.sinks.stage import attach_bucketed, bucket_count, object_totals, reuse_counts, write_bucketed
from tests.lru_model import digest
from tests.test_distance import _random_trace, requests_df


def stage(spark, tmp_path, rows, buckets=6, parts=64):
    name = f"stage_{uuid.uuid4().hex}"
    write_bucketed(requests_df(spark, rows), name, str(tmp_path / "stage"), buckets, parts)
    return name


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_later_jobs_exchange_sums_only(spark, tmp_path):
    table = spark.table(stage(spark, tmp_path, _random_trace(2, 500, 3, 40, 0.5)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, keys in ((reuse_counts(table), "shard"), (object_totals(table), "shard")):
            found = exchanges(df)
            assert len(found) == 1 and found[0].startswith(keys)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.index("partial_count") > plan.index("Exchange")  # printed from the top
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_results_of_the_stage(spark, tmp_path):
    rows = _random_trace(3, 600, 3, 30, 0.4)
    name = stage(spark, tmp_path, rows)
    seen = {}
    counts: Counter = Counter()
    for key, shard, ts, obj, size in sorted(rows, key=lambda r: (r[1], r[2], digest(r[3]), f"{r[4]}:{r[4]}:", r[0])):
        if size > 0:
            if (shard, obj) in seen:
                counts[shard, int(ts - seen[shard, obj])] += 1
            seen[shard, obj] = ts
    for table in (spark.table(name), attach_bucketed(spark, f"{name}_again", str(tmp_path / "stage"), 6)):
        found = {(r.shard, r.t): r.requests for r in reuse_counts(table, tiebreak=("key",)).collect()}
        assert found == dict(counts)
        per_object = Counter((r[1], r[3]) for r in rows if r[4] > 0)
        for r in object_totals(table).collect():
            own = [n for (s, _), n in per_object.items() if s == r.shard]
            assert (r.requests, r.objects, r.single_objects) == (sum(own), len(own), own.count(1))
            assert r.bytes == sum(x[4] for x in rows if x[1] == r.shard)
        assert len(exchanges(object_totals(table))) == 1


def test_a_hot_shard_lies_in_many_buckets(spark, tmp_path):
    rows = [(i, 1, i, f"o{i % 200}", 5) for i in range(800)]
    table = spark.table(stage(spark, tmp_path, rows, buckets=8))
    sizes = table.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 8 and sum(r["count"] for r in sizes) == 800
    assert max(r["count"] for r in sizes) < 400
    empty = stage(spark, tmp_path / "none", [])
    assert reuse_counts(spark.table(empty)).count() == object_totals(spark.table(empty)).count() == 0


def test_buckets_grow_with_the_requests(spark, monkeypatch):
    monkeypatch.setattr("cachecurve.sinks.stage.BUCKET_ROWS", 10)
    assert [bucket_count(spark.range(n), 8) for n in (0, 80, 81, 160, 1000)] == [8, 8, 16, 16, 128]
