import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.operators import describe
from cachecurve.plans.footprint import Footprint
from tests.lru_model import digest, thin
from tests.test_distance import SCHEMA, requests_df

CURVE = ("shard int, t int, std_mib bigint, std_objects bigint, requests bigint, bytes bigint, "
         "transition_bytes bigint, transition_requests bigint")


def _curves(seed):
    rng = random.Random(seed)
    curves = {}
    for shard in range(12):
        seconds = sorted(rng.sample(range(0, 400), rng.randint(1, 60)))
        curves[shard] = [(t, rng.choice([0, 0, 1, 5, 6, 100]), rng.randint(0, 9),
                          rng.randint(0, 3), rng.randint(0, 50), rng.randint(0, 5),
                          rng.randint(0, 2)) for t in seconds]
    return curves


@pytest.mark.parametrize("jump", [0, 5, 50, 100, 150])
def test_thinning_equals_the_scan(spark, jump):
    curves = _curves(jump)
    rows = [(s, *r) for s, curve in curves.items() for r in curve]
    random.Random(1).shuffle(rows)
    got = {}
    for r in sorted(map(tuple, describe.thin_curve(spark.createDataFrame(rows, CURVE), jump)
                        .collect())):
        got.setdefault(r[0], []).append(r[1:])
    if jump == 0:
        assert got == curves
    else:
        assert got == {s: k for s, c in curves.items() if (k := thin(c, jump))}


@pytest.mark.parametrize("jump", [0.5, 5, 50, 100, 150])
@pytest.mark.parametrize("batch", [1, 7, 64, 10_000])
def test_walk_from_kept_row_to_kept_row(jump, batch):
    """Long runs, steps and noise, across batch borders; sizes up to 2 ** 61."""
    rng = random.Random(jump)
    curves = {}
    for shard in range(8):
        size, rows = rng.choice([0, 1, 1000, 1 << 55]), []
        for t in sorted(rng.sample(range(5000), rng.choice([1, 3, 300, 1200]))):
            size = rng.choice([size] * 30 + [size * 2, size // 2, size + 1, max(size - 1, 0), size * 105 // 100, 0, 7])
            rows.append((t, min(size, 1 << 61), rng.randint(0, 9), rng.randint(0, 3), 5, 1, rng.randint(0, 2)))
        curves[shard] = rows
    table = np.array([(s, *r) for s, c in curves.items() for r in c], np.int64)
    thinner, parts = describe._Thinner(jump), []
    for k in range(0, len(table), batch):
        parts += thinner.batch(table[k:k + batch])
    got = {}
    for r in np.concatenate([np.empty((0, 8), np.int64), *parts, *thinner.rest()]).tolist():
        got.setdefault(r[0], []).append(tuple(r[1:]))
    assert got == {s: k for s, c in curves.items() if (k := thin(c, jump))}


@pytest.mark.parametrize("jump", [0.1, 3, 5, 33.3, 100, 250])
def test_bounds_are_those_of_the_rule(jump):
    rng = random.Random(3)
    for base in [1, 2, 3, 19, 20, 21, 400, 10**6, 2**53 + 1, 2**60 + 12345, *(rng.randrange(1, 1 << 45) for _ in range(200))]:
        late, large, small = describe.print_bounds(base, base, jump)
        def change(v):
            return abs((v - base) * 100.0 / base)
        assert change(late) > jump and not change(late - 1) > jump
        assert change(large) >= jump and not change(large - 1) >= jump
        assert small < 0 or change(small) >= jump
        assert small + 1 >= base or not change(small + 1) >= jump
    assert describe.print_bounds(0, 0, jump) == (1, 1, -1)


def test_rates_run_over_blocks(spark):
    rng = random.Random(8)
    rows = [(s, t, rng.randint(0, 5), rng.randint(0, 90)) for s in (1, 2, 3)
            for t in sorted(rng.sample(range(30_000), 40))]
    curve = spark.createDataFrame(rows, "shard int, t int, requests bigint, bytes bigint")
    totals = spark.createDataFrame([(1, 200, 9000), (2, 0, 0), (3, 500, 4500)], "shard int, requests bigint, bytes bigint")
    whole = {r.shard: r for r in totals.collect()}
    got = {(r.shard, r.t): (r.request_hit_pct, r.byte_hit_pct) for r in describe.hit_rate_curve(curve, totals).collect()}
    for s, t, _, _ in rows:
        n, b = (sum(r[k] for r in rows if r[0] == s and r[1] <= t) for k in (2, 3))
        want = (n * 100.0 / whole[s].requests, b * 100.0 / whole[s].bytes) if s != 2 else (None, None)
        assert got[s, t] == want
    assert len(got) == len(rows)


def test_thinning_keeps_sums(spark):
    rows = [(s, *r) for s, curve in _curves(9).items() for r in curve]
    df = spark.createDataFrame(rows, CURVE).where("requests > 0")
    sums = [F.sum(c) for c in ("requests", "bytes", "transition_bytes", "transition_requests")]
    assert describe.thin_curve(df, 30).agg(*sums).collect() == df.agg(*sums).collect()


def test_shards_without_statistics_emit_nothing(spark):
    rows = [(0, 1, 5, "A", 1), (1, 1, 5, "A", 1),                 # one timestamp only
            (2, 2, 1, "A", 1), (3, 2, 9, "B", 1),                 # no re-reference
            (4, 3, 1, "A", 0), (5, 3, 9, "A", 0),                 # nothing of positive size
            (6, 4, 1, "A", 2), (7, 4, 9, "A", 2)]
    f = Footprint(requests_df(spark, rows), FootprintConfig(), ("key",))
    assert [r.shard for r in f.header.collect()] == [4]
    assert [r.shard for r in f.curve.collect()] == [4]


def test_header_of_a_small_shard(spark):
    m = 1 << 20
    rows = [(0, 1, 0.0, digest("A"), 3 * m, m, 1, 7, -1), (1, 1, 100.0, digest("B"), m, m, 1, 8, -1),
            (2, 1, 400.0, digest("A"), 9 * m, m, 1, 7, -1), (3, 1, 700.0, digest("C"), 0, 0, 1, 7, -1)]
    f = Footprint(spark.createDataFrame(rows, SCHEMA), FootprintConfig(), ("key",))
    h = f.header.collect()[0]
    assert (h.requests, h.bytes, h.period_s) == (3, 3 * m, 700)
    assert h.total_mib == 2 * m + 0 + 2 * m                       # the sticky size counts
    assert (h.footprint_objects, h.footprint_bytes) == (3, 4 * m)  # the empty object is seen
    assert (h.peak_requests, h.peak_bytes) == (2, 2 * m)
    c = f.curve.collect()
    assert [(r.t, r.std_mib, r.std_objects, r.requests, r.bytes) for r in c] == [(400, 4, 2, 1, 3 * m)]
    info = {r.serial: (r.requests, r.unique_objects, r.unique_bytes) for r in f.serial_info.collect()}
    assert info == {7: (2, 1, 3 * m), 8: (1, 1, m)}


def test_parity_switch_empties_the_peaks(spark):
    rows = [(0, 1, 0, "A", 1), (1, 1, 9, "A", 1)]
    f = Footprint(requests_df(spark, rows), FootprintConfig(parity=True), ("key",))
    assert [(r.peak_requests, r.peak_bytes) for r in f.header.collect()] == [(0, 0)]


def test_staleness_is_strict_and_from_whole_seconds(spark):
    def row(key, ts, age):
        return (key, 1, ts, digest("A"), 1, 1, 1, 1, age)

    rows = [row(0, 0.9, 10), row(1, 10.0, 10), row(2, 20.5, 10), row(3, 21.0, -1), row(4, 21.5, 0)]
    f = Footprint(spark.createDataFrame(rows, SCHEMA), FootprintConfig(consider_ttl=True), ("key",),
                  ("key",))
    stale = {r.key: r.stale for r in f.linked.collect()}
    assert stale == {0: False, 1: False, 2: True, 3: False, 4: True}


def test_requests_of_the_curve_and_first_accesses_make_the_total(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(1, 3), rng.random() * 1000, f"o{rng.randint(1, 30)}", 5)
            for i in range(500)]
    f = Footprint(requests_df(spark, rows), FootprintConfig(slice_rows=64), ("key",))
    curve = {r.shard: r.n for r in f.curve.groupBy("shard").agg(F.sum("requests").alias("n"))
             .collect()}
    for h in f.header.collect():
        assert curve[h.shard] + h.footprint_objects == h.requests
    assert sum(r.dist_objects for r in f.histogram.collect()) == \
        sum(r.dist_objects for r in f.distances.collect())
