"""Request filters, miss handling and sampling.

Each rule is a boolean column that is true for requests to keep. ``keep`` applies them
as plain filters before any shuffle; ``classify`` names the first rule that drops one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.config import (FootprintConfig, RequestFilter, bucket_overrides, flag_overrides,
                               id_list, map_rule_index)
from cachecurve.functions.columns import (hex_prefix, inflated, numeric_map_id, sample_hash)
from cachecurve.operators.lookup import attach, attach_split, config_table
from cachecurve.operators.parse import status_flags, translate_serial


def sample_lines(lines: DataFrame, pct: float, seed: int) -> DataFrame:
    """Random share of the lines, taken before parsing. The coin is a digest of seed and line, so a
    rerun and any other partitioning take the same lines; equal lines share their coin."""
    if pct >= 100:
        return lines
    coin = hex_prefix(F.md5(F.concat(F.lit(f"{seed}:"), "value")), 1, 8)
    return lines.where(coin < int(pct / 100.0 * 2 ** 32))


def add_map_index(requests: DataFrame, cfg: RequestFilter) -> DataFrame:
    """``map_index`` of the matching map rule, -1 without one.

    A numeric map is looked up among the ids only and any other among the names.
    """
    names, ids = map_rule_index(cfg.map_rules, getattr(cfg, "split_by", None) == "mapid")
    rules = [(f"name:{n}", i) for n, i in names.items()] + [(f"id:{n}", i) for n, i in ids.items()]
    if not rules:
        return requests.withColumn("map_index", F.lit(-1))
    number = numeric_map_id(F.col("map"))
    key = F.when(number.isNotNull(), F.concat(F.lit("id:"), number.cast("string"))) \
        .otherwise(F.concat(F.lit("name:"), "map"))
    table = config_table(requests, rules, "rule_key string, _index int")
    return attach(requests, table, rule_key=key) \
        .withColumn("map_index", F.coalesce("_index", F.lit(-1))).drop("_index")


def add_sample_buckets(requests: DataFrame, default: int, overrides: str | None,
                       network: Column | None = None, map_: Column | None = None) -> DataFrame:
    """``filter_buckets`` and ``unshard_buckets`` of the request's map and network."""
    rows = [(m, n, f, u) for (m, n), (f, u) in bucket_overrides(overrides).items()]
    if not rows:
        return requests.withColumns({"filter_buckets": F.lit(default),
                                     "unshard_buckets": F.lit(default)})
    table = config_table(requests, rows, "map_key string, net_key string, _filter int, _unshard int")
    return attach(requests, table,
                  map_key=F.col("mapname") if map_ is None else map_,
                  net_key=F.col("network") if network is None else network) \
        .withColumns({"filter_buckets": F.coalesce("_filter", F.lit(default)),
                      "unshard_buckets": F.coalesce("_unshard", F.lit(default))}) \
        .drop("_filter", "_unshard")


def add_ignore_prefetch(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """``ignore_prefetch`` of the request's map and network."""
    default = cfg.ignore_prefetch and cfg.mode != "miss"
    rows = [(m, n, f) for (m, n), f in flag_overrides(cfg.prefetch_overrides).items()]
    if not rows:
        return requests.withColumn("ignore_prefetch", F.lit(default))
    table = config_table(requests, rows, "map_key string, net_key string, _flag boolean")
    return attach(requests, table, map_key=F.col("mapname"), net_key=F.col("network")) \
        .withColumn("ignore_prefetch", F.coalesce("_flag", F.lit(default))).drop("_flag")


def fill_vcd(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """Translate arl ids to vcds where the vcd is 0; the last mapping of an arl wins."""
    if (listed := cfg.list_of("arls")) is not None:
        table = listed.select(F.col("arlid").alias("arl_key"), F.col("vcd").alias("_vcd"))
        found = attach_split(requests, table, arl_key=F.col("arlid"))
    elif cfg.arl_vcd:
        table = config_table(requests, dict(cfg.arl_vcd).items(), "arl_key int, _vcd int")
        found = attach(requests, table, arl_key=F.col("arlid"))
    else:
        return requests
    return found \
        .withColumn("vcd", F.when(F.col("vcd") == 0, F.coalesce("_vcd", "vcd"))
                    .otherwise(F.col("vcd"))).drop("_vcd")


def mark_listed(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """``cpcode_listed`` where the listed cpcodes are a table."""
    if (listed := cfg.list_of("listed")) is None:
        return requests
    table = listed.select(F.col("cpcode").alias("cp_key"), F.lit(True).alias("cpcode_listed"))
    return attach_split(requests, table, cp_key=F.col("cpcode")) \
        .withColumn("cpcode_listed", F.coalesce("cpcode_listed", F.lit(False)))


def _listed(column: Column, ids: list[int], exclude: bool) -> Column:
    inside = column.isin(ids)
    return ~inside if exclude else inside


def match_filters(cfg: RequestFilter) -> Column:
    """Map, cpcode, vcd and region filters combined; needs ``map_index``.

    AND takes an unset filter as true. OR takes it as false, so OR without any
    filter keeps nothing. A request without region passes the region filter; one
    without vcd fails the job when vcds are filtered.
    """
    names, ids = map_rule_index(cfg.map_rules, False)
    cpcodes = id_list(cfg.cpcodes)
    if isinstance(cfg, FootprintConfig) and cfg.accounts:
        cpcodes = list(cfg.cpcode_positions())
    vcds = id_list(cfg.vcds)
    regions = id_list(cfg.regions)
    tests = []
    if names or ids:
        tests.append(F.col("map_index") >= 0)
    if isinstance(cfg, FootprintConfig) and cfg.list_of("listed") is not None:
        tests.append(~F.col("cpcode_listed") if cfg.exclude_cpcodes else F.col("cpcode_listed"))
    elif cpcodes:
        tests.append(_listed(F.col("cpcode"), cpcodes, cfg.exclude_cpcodes))
    if vcds:
        missing = F.raise_error(F.lit("vcd filter set, but a request has no vcd")).cast("boolean")
        tests.append(F.when(F.coalesce("vcd", F.lit(-1)) == -1, missing)
                     .otherwise(_listed(F.col("vcd"), vcds, cfg.exclude_vcds)))
    if regions:
        tests.append((F.coalesce("region", F.lit(-1)) == -1)
                     | _listed(F.col("region"), regions, cfg.exclude_regions))
    if not tests:
        return F.lit(cfg.combine == "AND")
    combined = tests[0]
    for test in tests[1:]:
        combined = combined & test if cfg.combine == "AND" else combined | test
    return combined


def with_raw_ts(requests: DataFrame) -> DataFrame:
    """The time before rounding, which for requests that were not parsed here is ``ts``."""
    return requests if "raw_ts" in requests.columns else requests.withColumn("raw_ts", F.col("ts"))


def in_time_range(cfg: RequestFilter) -> Column:
    return F.col("raw_ts").between(F.lit(float(cfg.start_s)), F.lit(float(cfg.end_s)))


def prepare(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """All columns that the filters and the routing look at."""
    df = status_flags(with_raw_ts(requests)).withColumns({
        "true_serial": F.col("serial"),
        "serial": translate_serial(F.col("serial"), cfg),
    })
    if cfg.mode == "miss":
        df = df.withColumn("bytes", F.when(F.col("is_miss"), inflated(F.col("bytes"), F.col("size")))
                           .otherwise(F.col("bytes")))
    if cfg.sample_at == "map":
        df = add_sample_buckets(df, cfg.sample_buckets, cfg.sample_overrides)
    df = add_ignore_prefetch(df, cfg)
    df = mark_listed(fill_vcd(df, cfg), cfg)
    return add_map_index(df, cfg)


def keep_rules(cfg: FootprintConfig) -> dict[str, Column]:
    """Rules in the order they are tried, by the reason they give; false means drop."""
    rules: dict[str, Column] = {}
    if cfg.sample_at == "map":
        rules["sampled"] = F.pmod(sample_hash(F.col("md5")), F.col("filter_buckets")) == 0
    if cfg.rehash_only:
        rules["rehash"] = F.col("serial").isin(list(cfg.rehash_starts()))
    if cfg.mode == "miss":
        rules["hit"] = F.col("is_miss")
    if cfg.ignore_icp:
        rules["icp"] = ~F.col("is_icp")
    if cfg.mode == "served":
        rules["prefetch"] = ~(F.col("ignore_prefetch") & F.col("is_prefetch"))
    rules["time"] = in_time_range(cfg)
    rules["filter"] = match_filters(cfg)
    return rules


def keep(prepared: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """Plain filters, so that those on stored columns reach a columnar scan."""
    for rule in keep_rules(cfg).values():
        prepared = prepared.where(rule)
    return prepared


def classify(prepared: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """``reject_reason`` also for the requests that a rule drops."""
    reason = F.col("reject_reason") if "reject_reason" in prepared.columns else F.lit(None)
    rules = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
             for name, rule in keep_rules(cfg).items()]
    return prepared.withColumn("reject_reason", F.coalesce(reason, *rules))
