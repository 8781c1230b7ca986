import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.operators.distance import halves, limbs, nested_before, wide_sum
from cachecurve.plans.footprint import Footprint
from tests.lru_model import LruList, digest

SCHEMA = ("key int, shard int, ts double, md5 string, size bigint, bytes bigint, cpcode int, "
          "true_serial int, max_age int")


def requests_df(spark, rows):
    """Rows (key, shard, ts, name, size) in any order; the key breaks ties."""
    data = [(k, s, float(ts), digest(o), size, size, 1, s, -1) for k, s, ts, o, size in rows]
    return spark.createDataFrame(data, SCHEMA)


def distances(spark, rows, **options):
    f = Footprint(requests_df(spark, rows), FootprintConfig(**options), ("key",), ("key",))
    found = f.distances.join(f.linked, "pos").select("key", "t", "dist_objects", "dist_bytes")
    return {r.key: (r.t, r.dist_objects, r.dist_bytes) for r in found.collect()}


def expected(rows, start=None):
    found = {}
    for shard in {r[1] for r in rows}:
        ordered = sorted((r for r in rows if r[1] == shard),
                         key=lambda r: (r[2], digest(r[3]), f"{r[4]}:{r[4]}:", r[0]))
        for a in LruList(start).run((k, ts, o, size) for k, _, ts, o, size in ordered):
            found[a.key] = (a.t, a.objects, a.size)
    return found


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100, 1000])
def test_nested_before_against_pairs(n):
    rng = np.random.default_rng(n)
    values = rng.permutation(3 * n)[:n]
    weights = rng.integers(0, 1 << 40, (2, n))
    counts, sums = nested_before(values, weights)
    for i in range(n):
        greater = values[:i] > values[i]
        assert counts[i] == greater.sum()
        assert (sums[:, i] == weights[:, :i][:, greater].sum(axis=1)).all()


@pytest.mark.parametrize("slice_rows", [2, 16, 64, 512, None])
def test_sizes_whose_sums_exceed_64_bits(spark, slice_rows):
    """1,000 requests of up to 2 ** 54 bytes weigh 2 ** 64 together, one slice of 512 of them 2 ** 63."""
    rng = random.Random(slice_rows or 0)
    rows = [(i, 1, i, f"o{i % 90}", (1 << 54) - i % 3) for i in range(1000)]
    rows += [(1000 + k, 2 + s, ts, o, rng.choice([1, 1 << 31, (1 << 32) - 1, 1 << 54])) for k, s, ts, o, _ in
             _random_trace(9, 500, 3, 40, 0.4)]
    assert distances(spark, rows, slice_rows=slice_rows) == expected(rows)


def test_a_distance_beyond_64_bits_is_an_error(spark):
    rows = [(i, 1, i, f"o{i % 600}", 1 << 54) for i in range(1200)]
    with pytest.raises(Exception, match="exceeds 64 bits"):
        distances(spark, rows, slice_rows=64)
    f = Footprint(requests_df(spark, rows), FootprintConfig(slice_rows=64), ("key",), ("key",))
    whole = f.distance_parts.agg(wide_sum(F.col("hi"), F.col("lo")).alias("sum")).first()["sum"]
    assert whole == 600 * (600 << 54)


def test_halves():
    weights = np.array([(1 << 62) + 5, 1, (1 << 40) + 7], np.int64)
    high, low = halves(np.cumsum(limbs(weights), axis=1))
    assert [(int(h) << 32) + int(v) for h, v in zip(high, low)] == \
        [(1 << 62) + 5, (1 << 62) + 6, (1 << 62) + (1 << 40) + 13]
    assert len(limbs(np.array([1, 2, 3]))) == 1 and len(limbs(np.array([], np.int64))) == 1


@pytest.mark.parametrize("trace", ["AA", "ABA", "ABBA", "ABCBA", "ABCABC", "AAABAA"])
def test_golden_traces(spark, trace):
    rows = [(i, 1, 10 * i, o, 100 + ord(o)) for i, o in enumerate(trace)]
    assert distances(spark, rows) == expected(rows)


def test_nothing_between_is_distance_zero(spark):
    assert distances(spark, [(0, 1, 0, "A", 5), (1, 1, 9, "A", 5)]) == {1: (9, 0, 0)}


def test_first_size_sticks(spark):
    rows = [(0, 1, 0, "A", 10), (1, 1, 1, "B", 7), (2, 1, 2, "A", 99), (3, 1, 3, "B", 1)]
    assert distances(spark, rows) == {2: (2, 2, 17), 3: (2, 2, 17)}


def _random_trace(seed, n, shards, objects, hot):
    rng = random.Random(seed)
    rows = []
    for key in range(n):
        shard = 1 if rng.random() < hot else rng.randint(1, shards)
        obj = "hot" if rng.random() < hot else f"o{rng.randint(1, objects)}"
        ts = rng.randint(0, 60) + rng.choice([0, 0.25, 0.5])
        rows.append((key, shard, ts, obj, rng.choice([0, 1, 5, 1 << 33])))
    return rows


@pytest.mark.parametrize("slice_rows", [2, 16, 64, 1 << 20, None])
def test_random_traces_in_slices(spark, slice_rows):
    """Hot shard, hot object, tied timestamps; most re-references cross many slices."""
    rows = _random_trace(slice_rows or 3, 700, 4, 60, 0.4)
    assert distances(spark, rows, slice_rows=slice_rows) == expected(rows)


def test_slices_that_grow_give_the_same_distances(spark, monkeypatch):
    monkeypatch.setattr("cachecurve.config.FEW_SLICES", 4)
    rows = _random_trace(8, 700, 4, 60, 0.4)
    assert FootprintConfig(slice_rows=2).sliced(len(rows)).slice_rows > 2
    assert distances(spark, rows, slice_rows=2) == expected(rows)


def test_one_shard_of_distinct_objects_scanned_twice(spark):
    """Largest distances: everything seen lies between two accesses."""
    rows = [(i, 1, i, f"o{i % 150}", 3) for i in range(300)]
    assert distances(spark, rows, slice_rows=16) == expected(rows)


def test_order_of_input_and_partitions_do_not_matter(spark):
    rows = _random_trace(5, 300, 3, 20, 0.3)
    want = expected(rows)
    for seed, partitions in ((1, 1), (2, 7)):
        mixed = rows[:]
        random.Random(seed).shuffle(mixed)
        assert distances(spark, mixed, slice_rows=32, partitions=partitions) == want


def test_prewarm_rows_build_the_stack_without_counting(spark):
    rows = [(0, 1, 0, "A", 1), (1, 1, 5, "A", 1), (2, 1, 10, "A", 1), (3, 1, 12, "A", 1)]
    # Statistics start at second 10, and a request at the boundary counts.
    assert {k: v[0] for k, v in distances(spark, rows, prewarm_s=10).items()} == \
        {1: None, 2: 5, 3: 2}


def test_copies_of_one_record_fall_into_many_partitions(spark):
    rows = [(i, 1, 7, "A", 3) for i in range(400)] + [(400, 1, 8, "B", 1), (401, 1, 9, "A", 3)]
    f = Footprint(requests_df(spark, rows), FootprintConfig(partitions=8), ("key",), ("key",))
    files = f.ordered.select(F.col("key")).inputFiles()
    assert len(files) > 4
    got = {r.pos: r.dist_objects for r in f.distances.collect()}
    assert got == {**{i: 0 for i in range(1, 400)}, 401: 2}


def test_admission_bypasses_until_the_first_lucky_draw(spark):
    import hashlib

    rows = [(i, 1, i, f"o{i % 9}", 4) for i in range(200)]
    seen, stack = set(), []
    for seq, row in enumerate(rows, 1):
        name = digest(row[3])
        draw = int(hashlib.md5(f"{name}:{seq}".encode()).hexdigest()[:7], 16) % 100
        if name in seen or draw <= 20:
            seen.add(name)
            stack.append(row)
    got = distances(spark, rows, admission_pct=20, slice_rows=16)
    assert 0 < len(stack) < len(rows)
    assert got == expected(stack)
