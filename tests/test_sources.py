import gzip
import random

import pytest
from pyspark.sql import functions as F

from cachecurve.config import PathFilter
from cachecurve.operators.parse import parse_requests
from cachecurve.plans.footprint import Footprint, routed_requests
from cachecurve.config import FootprintConfig
from cachecurve.sinks import tables
from cachecurve.sources import lists, logs, paths, views


def _gz(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("".join(f"{line}\n" for line in lines))


def _tree(tmp_path):
    _gz(tmp_path / "2024-01-01/10/ams/fd_storelog_10.0.0.1_a.gz", ["p1", "p2"])
    _gz(tmp_path / "2024-01-02/10/ams/fd_storelog_4_10.0.0.2_b.gz.key2", ["k1", "", "k2", "ü"])
    _gz(tmp_path / "2024-01-02/11/fra/fd_storelog_10.0.0.3_c.GZ.KEY13", ["skipped by the glob"])
    _gz(tmp_path / "2024-02-02/10/ams/other.gz", ["late"])
    (tmp_path / "2024-01-01/10/ams/notes.txt").write_text("no log\n")
    return str(tmp_path)


def test_listing_and_reading(spark, tmp_path):
    base = _tree(tmp_path)
    names = {r.file.rsplit("/", 1)[1] for r in logs.list_logs(spark, base).collect()}
    assert names == {"fd_storelog_10.0.0.1_a.gz", "fd_storelog_4_10.0.0.2_b.gz.key2", "other.gz"}
    lines = logs.read_logs(spark, base).collect()
    assert sorted(r.value for r in lines) == ["", "k1", "k2", "late", "p1", "p2", "ü"]


def test_path_rules_prune_files_before_reading(spark, tmp_path):
    base = _tree(tmp_path)
    # Reading these would fail.
    (tmp_path / "2024-02-02/10/ams/broken.gz").write_bytes(b"no gzip")
    (tmp_path / "2024-02-02/10/ams/broken.gz.key1").write_bytes(b"no gzip")
    rule = PathFilter("2024-01-01", "2024-01-31", "10:ams")

    def prune(files):
        return paths.filter_paths(files, rule, base=f"file:{base}")

    lines = logs.read_logs(spark, base, prune)
    assert sorted(r.value for r in lines.collect()) == ["", "k1", "k2", "p1", "p2", "ü"]


def test_names_of_any_signs(spark, tmp_path):
    names = ["a b.gz.key1", "50%25.gz.key2", "p+q.gz.key3", "x[1]{y}*?.gz.key4", "é#&=;,'.gz.KEY5", "d%20/e f.gz.key10",
             "d%20/plain p+q%.gz"]
    for i, name in enumerate(names):
        _gz(tmp_path / "top dir%41" / name, [f"{i}"])
    lines = logs.read_logs(spark, str(tmp_path)).collect()
    assert {r.file: r.value for r in lines} == \
        {f"file:{tmp_path}/top dir%41/{name}": str(i) for i, name in enumerate(names)}
    assert {r.file for r in lines} == {r.file for r in logs.list_logs(spark, str(tmp_path)).collect()}


def test_keyed_files_of_a_store_that_only_spark_reads(spark, tmp_path):
    _gz(tmp_path / "2024 01/x.gz.key1", ["kept", "too"])
    spark.conf.set("fs.viewfs.mounttable.logstore.link./in", f"file:{tmp_path}")
    lines = logs.read_logs(spark, "viewfs://logstore/in").collect()
    assert [(r.value, r.file, r.block_start) for r in lines] == \
        [(v, "viewfs://logstore/in/2024 01/x.gz.key1", 0) for v in ("kept", "too")]


def test_stores():
    for uri, found in (("file:/a/b", ("file://", "/a/b")), ("file:///a/b", ("file://", "/a/b")),
                       ("s3a://bucket/a b/c", ("s3a://bucket", "/a b/c")),
                       ("hdfs://nn:8020/x//y", ("hdfs://nn:8020", "/x//y"))):
        assert views.store_of(uri) == found
    with pytest.raises(ValueError):
        views.store_of("a/b.gz")


def test_keyed_files_are_dealt_by_size(spark, tmp_path):
    rng = random.Random(1)

    def noise(n):
        return ["%032x" % rng.getrandbits(128) for _ in range(n)]

    _gz(tmp_path / "large.gz.key1", noise(20_000))
    for i in range(63):
        _gz(tmp_path / f"small{i}.gz.key2", noise(200))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = logs.read_gzip_lines(logs.list_logs(spark, str(tmp_path))) \
            .groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("*").alias("lines"), F.count_distinct("file").alias("files")).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(r.lines for r in got) == 20_000 + 63 * 200 and sum(r.files for r in got) == 64
    large = max(got, key=lambda r: r.lines)
    assert large.files == 1 and large.lines == 20_000
    others = [r.lines for r in got if r != large]
    assert len(others) >= 3 and sum(2 * n < max(others) for n in others) <= 1  # the rest


def test_no_keyed_files(spark, tmp_path):
    _gz(tmp_path / "a.gz", ["x"])
    assert [r.value for r in logs.read_logs(spark, str(tmp_path)).collect()] == ["x"]


def test_long_keyed_file_keeps_its_order(spark, tmp_path):
    _gz(tmp_path / "x.gz.key1", [str(i) for i in range(50_001)])
    got = logs.read_gzip_lines(logs.list_logs(spark, str(tmp_path))).orderBy("line_no") \
        .select("value").toPandas()["value"]
    assert list(got) == [str(i) for i in range(50_001)]


def test_servers_of_files(spark):
    names = ["x/fd_storelog_10.0.0.1_1.gz", "fd_storelog_7_10.0.0.2_1.gz", "a/b_10.0.0.1_1.gz",
             "fd_storelog_10.0.0.9_1.gz", "fd_storelog_10.0.0.1_/other.gz"]
    df = spark.createDataFrame([(n,) for n in names], "file string")
    ips = [r.ip for r in df.select(logs.server_ip(F.col("file")).alias("ip")).collect()]
    assert ips == ["10.0.0.1", "10.0.0.2", None, "10.0.0.9", None]
    kept = logs.keep_servers(df, ["10.0.0.2", "10.0.0.1"]).collect()
    assert {(r.file, r.server_index) for r in kept} == {(names[0], 1), (names[1], 0)}
    listed = df.where(logs.listed_server(F.col("file"), ["10.0.0.9"])).collect()
    assert [r.file for r in listed] == [names[3]]


def test_server_from_comments(spark):
    rows = [("f", 0, 0, "a"), ("f", 0, 1, "# 5 10.0.0.1"), ("f", 0, 2, "b"), ("f", 64, 0, "c"),
            ("f", 64, 1, "# words"), ("f", 64, 2, "# 6 10.0.0.2"), ("f", 128, 0, "d"),
            ("fd_storelog_10.1.1.1_x.gz", 0, 0, "e")]
    df = spark.createDataFrame(rows, "file string, block_start long, line_no long, value string")
    got = {r.value: r.ip for r in logs.add_server(df).collect()}
    assert {k: got[k] for k in "abcde"} == {"a": None, "b": "10.0.0.1", "c": "10.0.0.1",
                                            "d": "10.0.0.2", "e": "10.1.1.1"}


def test_comment_server_of_a_split_text_file(spark, tmp_path):
    (tmp_path / "big.txt").write_text(
        "# 1 10.0.0.1\n" + "line one\n" * 400 + "# 1 10.0.0.2\n" + "line two\n" * 400)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = logs.read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        got = logs.add_server(lines).groupBy("value", "ip").count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {(r.value, r.ip): r["count"] for r in got if not r.value.startswith("#")} == \
        {("line one", "10.0.0.1"): 400, ("line two", "10.0.0.2"): 400}


def test_path_filter_levels(spark):
    names = ["2024-01-05/10/ams/x.gz", "2024-01-05", "2024-01-05/10", "2024-01-05/11/ams/x.gz",
             "2024-01-05/10/fra/x.gz", "2024-01-04/10/ams/x.gz", "today/10/ams/x.gz",
             "2024-01-07/10/ams/x.gz"]
    df = spark.createDataFrame([(f"/base/{n}",) for n in names], "file string")
    kept = paths.filter_paths(df, PathFilter("2024-01-05", "2024-01-07", "10:ams"), "/base/")
    assert {r.file for r in kept.collect()} == {f"/base/{names[i]}" for i in (0, 1, 2, 7)}
    assert paths.filter_paths(df, None) is df


def test_whitelist_sets_are_independent(spark):
    df = spark.createDataFrame([("d1/m1/t1/n1/r1/f",), ("d1/m2/t1/n1/r2/f",), ("d1/m1/t1/n2/r1/f",),
                                ("d1/m1/t1/n1/r1",), ("d2/m2/t2/n2/r2/f/g",)], "file string")
    allowed = paths.whitelist_table(df, ["d1 m1 t1:n1 r1", " # no", "d2 m2 t2:n2 r2", "d3 m3 t3"])
    loose = {r.file for r in paths.whitelist_paths(df, allowed).collect()}
    assert loose == {"d1/m1/t1/n1/r1/f", "d1/m2/t1/n1/r2/f", "d2/m2/t2/n2/r2/f/g"}
    strict = {r.file for r in paths.whitelist_paths(df, allowed, strict=True).collect()}
    assert strict == {"d1/m1/t1/n1/r1/f", "d2/m2/t2/n2/r2/f/g"}
    rows = lists.load_rows(allowed)
    assert {r.file for r in paths.whitelist_paths(df, rows).collect()} == loose
    assert {r.file for r in paths.whitelist_paths(df, rows, strict=True).collect()} == strict
    assert paths.whitelist_paths(df, []).count() == 0


def test_lists_from_files(spark, tmp_path):
    def file(name, text):
        (tmp_path / name).write_text(text)
        return lists.config_lines(spark, str(tmp_path / name))

    ids = lists.id_table(file("ids", "# c\n12\n\n 13\n-4\n0\n15 x\n"))
    assert [r.id for r in ids.orderBy("line_no").collect()] == [12, 15]
    accounts = file("acc", "1 b\nbad\n2 a\n1 a\n3 a\n")
    assert sorted(lists.load_rows(lists.account_table(accounts))) == \
        [(1, 0, "b"), (2, 1, "a"), (3, 1, "a")]
    assert sorted(lists.load_rows(lists.account_table(accounts, ["a"]))) == \
        [(1, 0, "a"), (2, 0, "a"), (3, 0, "a")]
    assert lists.load_rows(lists.arl_table(file("arl", "1 5\n2 6\n1 7\n").orderBy("line_no"))
                           .orderBy("arlid")) == [(1, 7), (2, 6)]
    assert lists.load_rows(lists.vmn_table(file("vmn", "#\n5 m f m^f^x\n6 n g n^g^y\n"))
                           .orderBy("id")) == [(5, "m", "f", "m^f^x", 0), (6, "n", "g", "n^g^y", 1)]


def test_text_outputs(spark, tmp_path):
    lines = [f"m1:3:{100 + i}.5:{'AB'[i % 2] * 16}:1048576:1000:7" for i in range(6)]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    f = Footprint(routed_requests(parse_requests(df), FootprintConfig()), FootprintConfig())
    text = tables.descriptor_text(f.header, f.curve)
    tables.write_text(text, str(tmp_path / "text"))
    written = [r.value for r in spark.read.text(str(tmp_path / "text/label=3")).collect()]
    assert written == ["# 6 6000 5 6285456 2 2097152 6 6000", "2 2 2 4 4194304 2097152 2"] or \
        written[0] == "# 6 6000 5 6285456 2 2097152 6 6000"
    assert written[1].startswith("2 2 2 4 4194304 ")
    tables.write_table(f.curve, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 1
    tables.write_text(tables.serial_text(f.serial_info), str(tmp_path / "serial"))
    assert [r.value for r in spark.read.text(str(tmp_path / "serial/label=3")).collect()] == \
        ["3 6 6000 5 2 2097152"]
