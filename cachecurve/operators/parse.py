"""Raw log lines to typed requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.functions.columns import is_miss, has_flag
from cachecurve.config import FootprintConfig

REQUEST_LAYOUTS = (14, 13, 8, 7)
REPLICATION_LAYOUTS = (14, 8, 7)

_LEADING_INT = r"^\s*([+-]?[0-9]+)"
_TOKEN = r"^\s*(\S+)"

# Field patterns. A number must fill its field, but only start the last field of a line.
_TEXT = r"[^:]+"
_INT = r"\s*[+-]?[0-9]{1,10}"
_LONG = r"\s*[+-]?[0-9]{1,19}"
_REAL = r"\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_INT_FIRST = _INT + ".*"
_REST = r"\s*\S.*"

_STEM = [_TEXT, _INT, _REAL, _TEXT, _LONG, _LONG]
_WIDE = [*_STEM, _INT, _TEXT, _INT, _TEXT, _TEXT, _INT]
_LAYOUTS = {
    14: [*_WIDE, _INT, _REST],
    13: [*_WIDE, _INT_FIRST],
    8: [*_STEM, _INT, _REST],
    7: [*_STEM, _INT_FIRST],
}
_MAX_SERIAL = 32767


def parse_requests(lines: DataFrame, value: str = "value",
                   layouts: Sequence[int] = REQUEST_LAYOUTS) -> DataFrame:
    """Type every line by the first layout that fits; other columns are kept.

    ``reject_reason`` is null for a request and else ``comment``, ``layout`` or
    ``serial``. Blank lines are not lines of the log and are dropped. ``ts`` is rounded to
    milliseconds as in records; the time range is tested on ``raw_ts``, the time of the line.
    """
    text = F.col(value)
    fits = [F.when((F.size("_s") >= n) & text.rlike("^" + ":".join(_LAYOUTS[n]) + "$"), F.lit(n))
            for n in layouts]
    # One struct per line, inlined: filters stay above it, so that a line is matched
    # and split once, and fields are converted only where the layout has checked them.
    split = lines.withColumn("_s", F.split(text, ":", 14)).select(
        *lines.columns, F.inline(F.array(F.struct(
            F.when(~text.startswith("#"), F.coalesce(*fits)).alias("_layout"),
            F.col("_s").alias("_f"))))).where("size(_f) > 1 or _f[0] <> ''")

    def field(i: int, least: int, type_: str = "string") -> Column:
        part = F.get(F.col("_f"), F.lit(i))
        return F.when(F.col("_layout") >= least, part.try_cast(type_))

    def last(i: int, pattern: str) -> Column:
        return F.regexp_extract(F.get(F.col("_f"), F.lit(i)), pattern, 1)

    serial = field(1, 7, "int")
    layout = F.when(serial <= _MAX_SERIAL, F.col("_layout"))
    at = F.col("_layout")
    return split.select(
        *lines.columns,
        layout.alias("layout"),
        F.when(F.startswith(value, F.lit("#")), "comment").when(layout.isNull(), "layout")
        .when(serial <= 0, "serial").alias("reject_reason"),
        field(0, 7).alias("map"),
        serial.alias("serial"),
        F.round(field(2, 7, "double"), 3).alias("ts"),
        field(2, 7, "double").alias("raw_ts"),
        field(3, 7).alias("md5"),
        field(4, 7, "bigint").alias("size"),
        field(5, 7, "bigint").alias("bytes"),
        F.when(at == 7, last(6, _LEADING_INT).try_cast("int")).otherwise(field(6, 8, "int"))
        .alias("cpcode"),
        F.when(at == 8, last(7, _TOKEN)).otherwise(F.coalesce(field(7, 13), F.lit("")))
        .alias("objstatus"),
        field(8, 13, "int").alias("arlid"),
        field(9, 13).alias("network"),
        field(10, 13).alias("mapname"),
        field(11, 13, "int").alias("region"),
        field(12, 14, "int").alias("vcd"),
        F.when(at == 14, last(13, _TOKEN)).alias("product"),
        F.when(at == 13, last(12, _LEADING_INT).try_cast("int")).otherwise(-1).alias("max_age"),
    )


def parse_routed(lines: DataFrame, value: str = "value") -> DataFrame:
    """Routed record text of 8 or 6 fields; lines that fit neither are dropped."""
    others = [c for c in lines.columns if c != value]
    # Inlined as in parse_requests, so that the text of a line is made and split once.
    parts = lines.select(*others, F.inline(F.array(F.struct(F.split(F.col(value), ":").alias("_f")))))

    def text(i: int) -> Column:
        return F.get(F.col("_f"), F.lit(i))

    full = (F.size("_f") >= 8) & text(6).try_cast("int").isNotNull() & \
        text(7).try_cast("int").isNotNull()
    typed = parts.select(
        *others,
        text(0).try_cast("int").alias("shard"),
        text(1).try_cast("double").alias("ts"),
        text(3).try_cast("bigint").alias("size"),
        text(4).try_cast("bigint").alias("bytes"),
        text(5).try_cast("int").alias("cpcode"),
        text(2).alias("md5"),
        F.when(full, text(6).try_cast("int")).otherwise(-1).alias("true_serial"),
        F.when(full, text(7).try_cast("int")).otherwise(-1).alias("max_age"),
    )
    whole = (F.col("shard").isNotNull() & F.col("ts").isNotNull() & F.col("size").isNotNull()
             & F.col("bytes").isNotNull() & F.col("cpcode").isNotNull()
             & (F.length("md5") == 16))
    return typed.where(whole)


def reject_counters(requests: DataFrame) -> DataFrame:
    """Lines per reject reason; accepted lines count as ``ok``."""
    reason = F.coalesce("reject_reason", F.lit("ok")).alias("reason")
    return requests.groupBy(reason).agg(F.count("*").alias("lines"))


def translate_serial(serial: Column, cfg: FootprintConfig) -> Column:
    folded = F.pmod(serial, F.lit(cfg.serial_modulus))
    if cfg.network.upper() != "ESSL" or not cfg.slot_exceptions:
        return folded
    pairs = [F.lit(v) for item in cfg.slot_exceptions.items() for v in item]
    return F.coalesce(F.create_map(*pairs)[serial], folded)


def status_flags(requests: DataFrame) -> DataFrame:
    status = F.col("objstatus")
    return requests.withColumns({
        "is_miss": is_miss(status),
        "is_icp": has_flag(status, "g"),
        "is_prefetch": has_flag(status, "K"),
    })
