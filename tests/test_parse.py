import pytest
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.operators import parse

HEAD = "m1:12:100.2504:0123456789ABCDEF:10:5:77"


def parsed(spark, *lines, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    return {r.i: r for r in parse.parse_requests(df, **options).collect()}


@pytest.mark.parametrize("line, layout", [
    (HEAD, 7), (HEAD + "x", 7), (HEAD + ":", 7), (HEAD + ":op", 8), (HEAD + ":o:3:f", 8),
    (HEAD + ":o:3:f:mm:4:3600", 13), (HEAD + ":o:3:f:mm:4:3600:", 13),
    (HEAD + ":o:3:f:mm:4:5:prod", 14), (HEAD + ":o:3:f:mm:4:5:prod:more", 14),
    (HEAD + ":o:3:f:mm:x:5:prod", 8), (HEAD + ":o:3:f:mm:4:none:prod", 8)])
def test_layout_of_a_line(spark, line, layout):
    row = parsed(spark, line)[0]
    assert (row.layout, row.reject_reason) == (layout, None)
    assert (row.map, row.serial, row.ts, row.size, row.bytes, row.cpcode) == \
        ("m1", 12, 100.25, 10, 5, 77)
    assert row.max_age == (3600 if layout == 13 else -1)
    assert row.vcd == (5 if layout == 14 else None)
    assert (row.region is None) == (layout < 13)


def test_status_ends_at_a_colon_and_product_does_not(spark):
    rows = parsed(spark, HEAD + ":oK:rest", HEAD + "::x", HEAD + ":o:3:f:mm:4:5:prod:more end")
    assert [rows[i].objstatus for i in range(3)] == ["oK", "", "o"]
    assert rows[2].product == "prod:more"


@pytest.mark.parametrize("line, reason", [
    ("# 4 10.0.0.1", "comment"), (":12:1:ab:1:1:1", "layout"), ("m1:12:x:ab:1:1:1", "layout"),
    ("m1:0:1:ab:1:1:1", "serial"), ("m1:-4:1:ab:1:1:1", "serial"),
    ("m1:40000:1:ab:1:1:1", "layout"), ("m1:1:1:ab:1.5:1:1", "layout"), ("words", "layout"),
    ("m1:99999999999:1:ab:1:1:1", "layout")])
def test_rejected_lines(spark, line, reason):
    assert parsed(spark, line)[0].reject_reason == reason


def test_blank_lines_are_not_lines(spark):
    assert list(parsed(spark, "", HEAD, "")) == [1]


def test_replication_layouts_leave_out_thirteen(spark):
    row = parsed(spark, HEAD + ":o:3:f:mm:4:3600", layouts=parse.REPLICATION_LAYOUTS)[0]
    assert (row.layout, row.objstatus, row.max_age) == (8, "o", -1)


def test_counters(spark):
    df = spark.createDataFrame([(HEAD,), ("# c",), ("x",), (HEAD + ":o",)], "value string")
    counts = parse.reject_counters(parse.parse_requests(df)).collect()
    assert {r.reason: r.lines for r in counts} == {"ok": 2, "comment": 1, "layout": 1}


def test_routed_records(spark):
    lines = ["5:1.5:0123456789ABCDEF:10:5:7:9:60", "5:1.5:0123456789ABCDEF:10:5:7",
             "5:1.5:short:10:5:7", "5:1.5:0123456789ABCDEF:x:5:7", " "]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    rows = parse.parse_routed(df).select("shard", "ts", "true_serial", "max_age").collect()
    assert [tuple(r) for r in rows] == [(5, 1.5, 9, 60), (5, 1.5, -1, -1)]


def test_serial_translation(spark):
    df = spark.createDataFrame([(2049,), (5153,), (4095,)], "s int")
    for network, want in (("FF", [1, 1057, 2047]), ("CW", [2049, 1057, 4095]),
                          ("ESSL", [49, 2007, 95]), ("other", [1, 1057, 2047])):
        cfg = FootprintConfig(network=network)
        got = df.select(parse.translate_serial(F.col("s"), cfg).alias("t")).collect()
        assert [r.t for r in got] == want
        assert [cfg.translate(s) for s in (2049, 5153, 4095)] == want


def test_routed_lines_are_made_and_split_once(spark):
    lines = spark.range(0, 4, 1, 1).select(F.concat_ws(
        ":", F.lit(1), F.lit("2.500"), F.lit("A" * 16), "id", "id", F.lit(7)).alias("value"))
    parsed = parse.parse_routed(lines)
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert sorted(r.size for r in parsed.collect()) == [0, 1, 2, 3]
    blank = spark.createDataFrame([(None,), ("",), ("  ",), ("::::::",)], "value string")
    assert parse.parse_routed(blank).isEmpty()
