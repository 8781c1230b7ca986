"""Jobs from option strings and list files."""

import gzip

import pytest

from cachecurve.plans.options import footprint_job, parse_options, replication_job
from tests.lru_model import digest
from tests.test_jobs import line


def test_option_lines():
    assert parse_options("") == {}
    assert parse_options("VCDS_FILE=/tmp/vcds") == {"VCDS_FILE": "/tmp/vcds"}
    assert parse_options("A_FILE=/tmp/vcds\nB_FILE=/tmp/cp\n") == {"A_FILE": "/tmp/vcds", "B_FILE": "/tmp/cp"}
    assert parse_options("VCDS_FILE=/tmp/a=b") == {"VCDS_FILE": "/tmp/a=b"}
    assert parse_options("no sign\n=x\nK=") == {"K": ""}


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    top = tmp_path_factory.mktemp("option logs")
    for n, (day, server, region) in enumerate((("2024-01-01", "10.0.0.1", 4), ("2024-01-02", "10.0.0.2", 5))):
        folder = top / day / "ams" / "f" / "n" / str(region)
        folder.mkdir(parents=True)
        rows = [f"# 7 10.7.7.{n}"] + [line("m1", 1 + i % 2, 100 + i, f"o{i % 5}", 10, 1000 + i % 4, region=region, vcd=i % 3,
                                           arl=20 + i % 2) for i in range(24)]
        with gzip.open(folder / f"fd_storelog_{server}_x.gz.key{n + 2}", "wt") as out:
            out.write("".join(f"{r}\n" for r in rows))
    return str(top)


def write(tmp_path, name, *lines):
    (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
    return str(tmp_path / name)


def routed(spark, base, **options):
    job, _, _ = footprint_job(spark, base, options)
    return job.routed.collect(), job


def test_lists_from_files(spark, base, tmp_path):
    rows, job = routed(spark, base, CPCODES="1003", CPCODES_FILE=write(tmp_path, "cp", "# x", "1001 y", "", " 1000", "0", "1002"),
                       SPLIT_BY_CPCODE="")
    assert {(r.cpcode, r.shard) for r in rows} == {(1003, 0), (1001, 1), (1002, 2)}
    assert job.counters["filter"] == 12  # cpcode 1000
    rows, _ = routed(spark, base, CPCODE_MAP_FILE=write(tmp_path, "acc", "1000 a", "1001 b", "1002 b", "1002 a"), SPLIT_BY_ACCOUNT="0")
    assert {(r.cpcode, r.shard) for r in rows} == {(1000, 0), (1001, 1), (1002, 0)}
    rows, _ = routed(spark, base, CPCODE_MAP_FILE=str(tmp_path / "acc"), ACCOUNTS="b")
    assert {r.cpcode for r in rows} == {1001, 1002}
    rows, _ = routed(spark, base, VCDS="1", VCDS_FILE=write(tmp_path, "vcds", "2"))
    assert {r.vcd for r in rows} == {1, 2}
    rows, _ = routed(spark, base, VCDS_FILE=str(tmp_path / "vcds"), EXCLUDE_SPECIFIED_VCDS="")
    assert {r.vcd for r in rows} == {0, 1}
    rows, _ = routed(spark, base, REGIONS_FILE=write(tmp_path, "regions", "5"))
    assert {r.region for r in rows} == {5}
    rows, job = routed(spark, base, GHOSTIP_FILE=write(tmp_path, "servers", "# x", "10.0.0.9", "10.0.0.2"), URL_BUCKET="2")
    assert {r.region for r in rows} == {5} and {r.shard // 2 for r in rows} == {1}
    rows, _ = routed(spark, base, PATH_FILTER_FILE=write(tmp_path, "white", "2024-01-01 ams f:n 4"))
    assert {r.region for r in rows} == {4}
    assert routed(spark, base, PATH_FILTER_FILE=write(tmp_path, "empty", "# none"))[0] == []
    labels = write(tmp_path, "vmn", "0 m1 f one", "2 m1 f two")
    arls = write(tmp_path, "arl", "20 2", "20 0", "21 2")
    rows, job = routed(spark, base, SPLIT_BY_VCD_MAP_NETWORK="1", VCD_MAP_NETWORK_FILE=labels, ARL_VCD_TRANSLATION_FILE=arls,
                       COMPUTE_BOTH_SERVED_AND_MISS_FDS="1")
    assert {(r.arlid, r.vcd, r.shard) for r in rows} == {(20, 0, 0), (21, 2, 1), (20, 2, 1)}
    assert job.cfg.copies_base() == 2 and job.cfg.mode == "both"


def test_later_splits_replace_earlier_ones(spark, base):
    def split(**options):
        return footprint_job(spark, base, options)[0].cfg.split_by

    assert split(SPLIT_BY_CPCODE="x", SPLIT_BY_MAPID="x", MAPRULES="m1") == "mapid"
    assert split(SPLIT_BY_CPCODE="x", SPLIT_BY_ARLID="x") is None
    assert split(SPLIT_BY_ACCOUNT="0", SPLIT_BY_VCD_MAP_NETWORK="0") == "account"


def test_values(spark, base):
    cfg = footprint_job(spark, base, {
        "P_SAMPLE_ON_ATTEMPT": "2", "P_SAMPLE_BUCKETS": "3", "P_IGNORE_ICP_LINES": "no", "P_FILTER_COMBINE": "or", "P_CPCODES": "1:2",
        "P_RANDOM_SAMPLING_PCT": "12.5", "P_PROCESS_MISSES_ONLY": "TRUE", "P_REHASH_RANGE_FROM_0": "1", "P_NETWORK": "cw",
        "P_SERIALS": "1-3", "P_ENTRY_PROBABILITY_PCT": "30"}, "P_", partitions=3)[0].cfg
    assert (cfg.sample_at, cfg.sample_buckets, cfg.ignore_icp, cfg.combine, cfg.sample_pct, cfg.mode, cfg.rehash_from_zero,
            cfg.serial_modulus, cfg.rehash_serials, cfg.admission_pct, cfg.partitions) == \
        ("reduce", 3, False, "OR", 12.5, "miss", False, 4096, "1-3", 30, 3)


@pytest.mark.parametrize("options", [
    {"RAM_SIZE": "1"}, {"UNKNOWN": "1"}, {"START_TIME": "x"}, {"ACCOUNTS": "a"}, {"SPLIT_BY_VCD_MAP_NETWORK": "1"},
    {"PROCESS_MISSES_ONLY": "1", "COMPUTE_BOTH_SERVED_AND_MISS_FDS": "1"}, {"START_TIME": "5", "END_TIME": "5"},
    {"SPLIT_BY_CPCODE": "1", "REHASH_ONLY": "1"}, {"GHOSTIP": "1.2.3"}, {"CPCODES": "0"}])
def test_wrong_options_fail(spark, base, options):
    with pytest.raises(ValueError):
        footprint_job(spark, base, options)


def test_replication_options(spark, base, tmp_path):
    job, out = replication_job(spark, base, {"REGION_IP_IN_LOG": "1", "REGIONS": "5", "URL_BUCKET": "4",
                                             "OUTPUT_DIR": str(tmp_path / "part")})
    job.write_part(out)
    rows = spark.read.parquet(out).collect()
    assert {r.ip for r in rows} == {"10.7.7.1"} and len(rows) == 5
    assert {r.shard for r in rows} == {int(digest(f"o{i}")[:4], 16) % 4 for i in range(5)}
    with pytest.raises(ValueError):
        replication_job(spark, base, {"VCDS": "1"})
