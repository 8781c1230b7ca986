"""Jobs from files to results: every option shows, counters come with the pass, parts merge."""

import gzip
import re
from dataclasses import fields, replace

import pytest
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig, PathFilter, ReplicationConfig
from cachecurve.operators import parse
from cachecurve.plans.footprint import footprint
from cachecurve.plans.jobs import FootprintJob, LogFiles, ReplicationJob, full_name, merged_parts
from cachecurve.plans.replication import replication
from cachecurve.sinks import tables
from cachecurve.sources import logs
from tests.lru_model import digest


def line(map_, serial, ts, name, size, cpcode, status="-", region=1, vcd=0, arl=10):
    return f"{map_}:{serial}:{ts}:{digest(name)}:{size}:{size - 1}:{cpcode}:{status}:{arl}:f:{map_}:{region}:{vcd}:x"


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    top = tmp_path_factory.mktemp("job logs")
    maps, flags = ("m1", "m2", "101"), ("-", "o", "p", "g", "K")
    n = 0
    for day in ("2024-01-01", "2024-01-02", "2024-02-01"):
        for arl, metro in ((10, "ams"), (10, "fra"), (11, "ams")):
            for server in (1, 2):
                rows = ["# comment", f"# 4 10.9.9.{server}", "broken:1:2", "m:0:5:0123456789ABCDEF:1:1:1", ""]
                for i in range(12):
                    n += 1
                    rows.append(line(maps[n % 3], 1 + n % 4, 1000 + n * 7 % 900 + 0.25, f"o{n % 17}", 10 + n % 3, 1000 + n % 3,
                                     flags[n % 5], 1 + n % 2, n % 3, 10 + n % 2))
                path = top / day / str(arl) / metro / f"fd_storelog_10.0.0.{server}_{n}.gz{('', '.key2')[server % 2]}"
                path.parent.mkdir(parents=True, exist_ok=True)
                with gzip.open(path, "wt") as out:
                    out.write("".join(f"{r}\n" for r in rows))
    return str(top)


LISTS = dict(cpcode_accounts=((1000, "a"), (1001, "b"), (1002, "b")), url_buckets=0,
             vmn_labels=((0, "m1", "f", "m1^f^x"), (1, "m2", "f", "m2^f^y"), (2, "101", "f", "101^f^z")))
PLAIN = FootprintConfig(**LISTS)


def routed_rows(spark, base, cfg, files=None):
    job = FootprintJob(spark, files or LogFiles(base), cfg)
    keep = [c for c in job.routed.columns if c not in ("line_no", "file")]
    return sorted(map(str, job.routed.select(*keep).collect())), job.counters


# what the option is set to, and on top of which other options
CHANGES = {
    "start_s": (1300, {}), "end_s": (1700, {}), "map_rules": ("m1,m2", {}), "cpcodes": ("1000", {}),
    "exclude_cpcodes": (True, dict(cpcodes="1000")), "vcds": ("1", {}), "exclude_vcds": (True, dict(vcds="1")),
    "regions": ("1", {}), "exclude_regions": (True, dict(regions="1")),
    "combine": ("OR", dict(regions="1", cpcodes="1000")), "network": ("ESSL", dict(slot_exceptions={1: 77})),
    "slot_exceptions": ({2: 99}, dict(network="ESSL")), "mode": ("miss", {}), "ignore_icp": (False, {}),
    "ignore_prefetch": (True, {}), "prefetch_overrides": ("m1:f:true", {}), "servers": ("10.0.0.2", {}),
    "accounts": ("b", dict(split_by="account")), "cpcode_accounts": (((1000, "b"), (1001, "c")), dict(split_by="account")),
    "vmn_labels": (((0, "m1", "f", "L"),), dict(split_by="vmn")), "arl_vcd": (((10, 2),), dict(split_by="vmn")),
    "sample_pct": (40.0, {}), "sample_seed": (99, dict(sample_pct=40.0)), "sample_at": ("map", dict(sample_buckets=3)),
    "sample_buckets": (4, dict(sample_at="map")), "sample_overrides": ("m1:f:5:5", dict(sample_at="map", sample_buckets=2)),
    "url_buckets": (4, {}), "split_by": ("account", {}), "rehash_serials": ("1,2", {}),
    "rehash_buckets": (3, dict(rehash_serials="1,2")), "rehash_only": (True, dict(rehash_serials="1,2")),
    "rehash_from_zero": (True, dict(rehash_serials="1,2", rehash_only=True)), "num_shards": (2, {}),
    "parity": (True, dict(split_by="cpcode", cpcodes="1001", combine="OR", regions="1")),
}
# these bear on the stack or on the run only, or are tested as lists
LATER = {"label_rehashed_serial", "prewarm_s", "prewarm_from_config", "consider_ttl", "admission_pct", "thinning_pct",
         "partitions", "stage_routed", "slice_rows", "lists"}


def test_every_option_is_listed():
    assert {f.name for f in fields(FootprintConfig)} == set(CHANGES) | LATER


class ReadLines(LogFiles):
    """Lines that are read already."""

    read = None

    def lines(self, spark, servers=()):
        return logs.keep_servers(self.read, list(servers))


@pytest.fixture(scope="module")
def read(spark, base):
    files = ReadLines(base)
    files.read = logs.read_logs(spark, base).coalesce(1).cache()
    yield files
    files.read.unpersist()


@pytest.fixture(scope="module")
def known():
    """Rows by options, as most options are compared with the same ones."""
    return {}


@pytest.mark.parametrize("option", sorted(CHANGES))
def test_every_option_shows(spark, base, read, known, option):
    value, others = CHANGES[option]
    cfg = replace(PLAIN, **others)
    if repr(cfg) not in known:
        known[repr(cfg)] = routed_rows(spark, base, cfg, read)[0]
    assert routed_rows(spark, base, replace(cfg, **{option: value}), read)[0] != known[repr(cfg)]


@pytest.mark.parametrize("option, value, others, table", [
    ("prewarm_s", 300, {}, "header"), ("prewarm_from_config", True, dict(start_s=900, prewarm_s=300), "header"),
    ("consider_ttl", True, {}, "curve"), ("admission_pct", 30, {}, "header"), ("thinning_pct", 150.0, dict(url_buckets=1), "curve"),
    ("label_rehashed_serial", True, dict(rehash_serials="1-5", rehash_only=True, rehash_buckets=1, rehash_from_zero=True), "header"),
])
def test_every_later_option_shows(read, option, value, others, table):
    def rows(cfg):
        requests = parse.parse_requests(read.read)
        if option == "consider_ttl":
            requests = requests.withColumn("max_age", F.lit(20))
        return sorted(map(str, getattr(footprint(requests, cfg), table).collect()))

    cfg = replace(PLAIN, **others)
    assert rows(replace(cfg, **{option: value})) != rows(cfg)


def test_options_about_lines_fail_without_lines(spark, base):
    requests = parse.parse_requests(logs.read_logs(spark, base))
    for cfg in (replace(PLAIN, sample_pct=50.0), replace(PLAIN, servers="10.0.0.1")):
        with pytest.raises(ValueError):
            footprint(requests, cfg)
    with pytest.raises(ValueError):
        replication(requests, ReplicationConfig())


def test_counters_equal_the_counting_query_and_need_no_second_scan(spark, base):
    cfg = replace(PLAIN, mode="both", split_by="account", regions="1", sample_pct=80.0, start_s=1100)
    job = FootprintJob(spark, LogFiles(base), cfg)
    counted = {r.reason: r["count"] for r in job.classified().groupBy(
        F.coalesce("reject_reason", F.lit("ok")).alias("reason")).count().collect()}
    assert job.counters == {}
    emitted = job.routed.count()
    assert {k: v for k, v in job.counters.items() if v and k != "routed"} == counted
    assert job.counters["routed"] == emitted > counted["ok"]
    plan = job.classified()._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Scan text", plan)) == 2  # plain and keyed files, once each


def test_files_are_chosen_before_they_are_read(spark, base, tmp_path):
    rule = PathFilter("2024-01-01", "2024-01-31", "10:ams, 11:ams")
    rows, counters = routed_rows(spark, base, PLAIN, LogFiles(base, rule))
    assert counters["comment"] == 2 * 2 * 2 * 2  # two days, two folders, two servers, two comments
    one, few = routed_rows(spark, base, replace(PLAIN, servers="10.0.0.2"), LogFiles(base, rule))
    assert few["comment"] == counters["comment"] // 2 and len(one) < len(rows)
    for name in ("x.gz", "x.gz.key1"):
        folder = tmp_path / "2024-02-01/10/ams"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"fd_storelog_10.0.0.9_{name}").write_bytes(b"no gzip")
    assert routed_rows(spark, str(tmp_path), PLAIN, LogFiles(str(tmp_path), rule))[0] == []
    assert full_name(spark, base) == f"file:{base}"


def test_whitelist(spark, tmp_path):
    for day, metro, region in (("2024-01-01", "ams", "4"), ("2024-01-01", "fra", "5"), ("2024-01-02", "ams", "5")):
        folder = tmp_path / day / metro / "f" / "n" / region
        folder.mkdir(parents=True)
        with gzip.open(folder / "x.gz.key3", "wt") as out:
            out.write(line("m1", 1, 5, day + metro, 10, 1) + "\n")
    entries = ["# x", "2024-01-01 ams f:n 4", "2024-01-02 ams f:n 5"]
    loose, _ = routed_rows(spark, str(tmp_path), PLAIN, LogFiles(str(tmp_path), whitelist=entries))
    strict, _ = routed_rows(spark, str(tmp_path), PLAIN, LogFiles(str(tmp_path), whitelist=entries[:2], strict=True))
    assert len(loose) == 2 and len(strict) == 1


def test_written_results(spark, base, tmp_path):
    out = str(tmp_path / "out")
    job = FootprintJob(spark, LogFiles(base), replace(PLAIN, url_buckets=2))
    job.write(out)
    for name, table in (("header", job.footprint.header), ("curve", job.footprint.curve),
                        ("serials", job.footprint.serial_info), ("hit_rates", job.footprint.hit_rates)):
        read = spark.read.parquet(f"{out}/{name}").withColumn("shard", F.col("shard"))
        columns = [c for c in table.columns if c != "label"]
        assert sorted(map(str, read.select(columns).collect())) == sorted(map(str, table.select(columns).collect()))
    text = spark.read.text(f"{out}/descriptor").where("value like '#%'").count()
    assert text == job.footprint.header.count() > 0
    counters = {r.reason: r.lines for r in spark.read.parquet(f"{out}/counters").collect()}
    assert counters == job.counters and counters["layout"] == 18


@pytest.mark.parametrize("ip_from", ["filename", "comment"])
def test_replication_parts_equal_one_run(spark, base, tmp_path, ip_from):
    cfg = ReplicationConfig(url_buckets=3, ip_from=ip_from)
    rules = [PathFilter(f"2024-0{m}-01", f"2024-0{m}-28", "10:ams:fra, 11:ams") for m in (1, 2)]
    paths = []
    for k, rule in enumerate([*rules, rules[0]]):  # a day that is merged twice does not count twice
        paths.append(str(tmp_path / f"part{k}"))
        job = ReplicationJob(spark, LogFiles(base, rule), cfg)
        job.write_part(paths[-1])
        assert job.counters["comment"] > 0 and job.counters["ok"] > 0
    merged = merged_parts(spark, *paths)
    lines = logs.add_server(logs.read_logs(spark, base), ip_from)
    whole = replication(parse.parse_requests(lines, layouts=parse.REPLICATION_LAYOUTS), cfg)
    assert sorted(merged.counts.collect()) == sorted(whole.counts.collect())
    assert sorted(map(tuple, merged.dist.collect())) == sorted(map(tuple, whole.dist.collect()))
    servers = {"filename": 2, "comment": 2}[ip_from]
    assert max(r.copies for r in whole.counts.collect()) == servers
    tables.write_text(tables.replication_shard_text(whole.by_shard), str(tmp_path / "text"))
    assert sorted(map(tuple, tables.read_shard_text(spark, str(tmp_path / "text")).collect())) == \
        sorted(map(tuple, whole.by_shard.collect()))


def test_where_the_server_comes_from_shows(spark, base, tmp_path):
    found = []
    for ip_from in ("filename", "comment"):
        ReplicationJob(spark, LogFiles(base), ReplicationConfig(ip_from=ip_from)).write_part(str(tmp_path / ip_from))
        found.append({r.ip for r in spark.read.parquet(str(tmp_path / ip_from)).collect()})
    assert found == [{"10.0.0.1", "10.0.0.2"}, {"10.9.9.1", "10.9.9.2"}]


def test_log_files_of_the_queries_have_bounded_lines(spark, tmp_path, monkeypatch):
    from workload import job_queries

    spark.range(60).selectExpr(
        "id as event_id", "id % 7 as user_id", "'view' as event_type", "timestamp_seconds(1704067200 + id) as ts",
        """concat('{"k": ', id % 5, '}') as props""").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(job_queries, "FILE_LINES", 2)
    for write in (job_queries.write_tree, job_queries.write_logs):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(write(spark, str(tmp_path)))
        sizes = [gzip.decompress(row.content).count(b"\n") for row in found.collect()]
        assert sum(sizes) == 60 and max(sizes) <= 2
