"""Choice of the shard of every request, and shard labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cachecurve.config import (REPLICATION_SERIAL_MODULUS, FootprintConfig, ReplicationConfig,
                               ip_list, map_rule_index)
from cachecurve.functions.columns import hex_prefix, inflated
from cachecurve.operators.lookup import attach, attach_split, config_table

ROUTED_COLUMNS = ("shard", "ts", "md5", "size", "bytes", "cpcode", "true_serial", "max_age")


def url_shard(cfg: FootprintConfig) -> Column:
    """Shard by url hash; null when the request matches no map rule.

    Spreads one map over ``url_buckets`` shards, and over the listed servers too.
    """
    names, ids = map_rule_index(cfg.map_rules, cfg.split_by == "mapid")
    index = F.col("map_index") if names or ids else F.lit(0)
    buckets = cfg.url_buckets
    hashed = F.pmod(hex_prefix(F.col("md5"), 1, 4), F.lit(buckets)).cast("int")
    servers = ip_list(cfg.servers)
    if servers:
        shard = index * (buckets * len(servers)) + F.col("server_index") * buckets + hashed
    else:
        shard = index * buckets + hashed
    return F.when(index >= 0, shard.cast("int"))


def _split_id(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """``_id`` of the configured split: cpcode position, account or (vcd, map, network)."""
    if cfg.split_by == "cpcode":
        if (listed := cfg.list_of("cpcodes")) is not None:
            table = listed.select(F.col("cpcode").alias("cp_key"), F.col("position").alias("_id"))
            found = attach_split(requests, table, cp_key=F.col("cpcode"))
        else:
            table = config_table(requests, cfg.cpcode_positions().items(), "cp_key int, _id int")
            found = attach(requests, table, cp_key=F.col("cpcode"))
        return found.withColumn("_id", F.coalesce("_id", F.lit(0))) if cfg.parity else found
    if cfg.split_by == "account":
        if (listed := cfg.list_of("accounts")) is not None:
            table = listed.select(F.col("cpcode").alias("cp_key"), F.col("account_id").alias("_id"))
            return attach_split(requests, table, cp_key=F.col("cpcode"))
        table = config_table(requests, cfg.account_ids()[1].items(), "cp_key int, _id int")
        return attach(requests, table, cp_key=F.col("cpcode"))
    if (listed := cfg.list_of("vmns")) is not None:
        table = listed.select(F.col("vcd").alias("v_key"), F.col("map").alias("m_key"),
                              F.col("network").alias("n_key"), F.col("id").alias("_id"))
        return attach_split(requests, table, v_key=F.col("vcd"), m_key=F.col("mapname"),
                            n_key=F.col("network"))
    rows = [(*key, number) for key, number in cfg.vmn_ids().items()]
    table = config_table(requests, rows, "v_key int, m_key string, n_key string, _id int")
    return attach(requests, table, v_key=F.col("vcd"), m_key=F.col("mapname"),
                  n_key=F.col("network"))


def rehash_shard(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """``_rehash`` shard of the listed serials, else null."""
    starts = cfg.rehash_starts()
    if not starts:
        return requests.withColumn("_rehash", F.lit(None).cast("int"))
    table = config_table(requests, starts.items(), "s_key int, _start int")
    shard = F.col("_start") + F.pmod(hex_prefix(F.col("md5"), 1, 2), F.lit(cfg.rehash_buckets))
    return attach(requests, table, s_key=F.col("serial")) \
        .withColumn("_rehash", shard.cast("int")).drop("_start")


def route(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """One row per emitted copy with its ``shard``; unmapped requests are dropped.

    Order of precedence: url hash, cpcode, map id, rehash, account, (vcd, map,
    network), translated serial.
    """
    df = rehash_shard(requests, cfg)
    single = F.lit(None).cast("int")
    if cfg.url_buckets:
        single = url_shard(cfg)
    if cfg.split_by == "mapid":
        single = F.coalesce(single, F.col("map_index"))
    elif cfg.split_by != "cpcode":
        single = F.coalesce(single, F.col("_rehash"))
    if cfg.split_by in (None, "mapid"):
        routed = df.withColumn("shard", F.coalesce(single, F.col("serial")).cast("int"))
        return _finish(routed.drop("_rehash"), cfg)

    df = _split_id(df.withColumn("_single", single), cfg)
    missed = inflated(F.col("bytes"), F.col("size"))
    if cfg.mode != "both":
        routed = df.withColumn("shard", F.coalesce("_single", "_id"))
    else:
        def copy(shard: Column, amount: Column, wanted: Column) -> Column:
            return F.when(wanted, F.struct(shard.cast("int").alias("shard"), amount.alias("bytes")))

        single_copy = F.col("_single").isNotNull()
        split_copy = ~single_copy & F.col("_id").isNotNull()
        served = split_copy & ~(F.col("ignore_prefetch") & F.col("is_prefetch"))
        copies = F.array_compact(F.array(
            copy(F.col("_single"), F.col("bytes"), single_copy),
            copy(F.col("_id"), F.col("bytes"), served),
            copy(F.col("_id") + cfg.copies_base(), missed, split_copy & F.col("is_miss"))))
        routed = df.withColumn("_copy", F.explode(copies)) \
            .withColumns({"shard": F.col("_copy.shard"), "bytes": F.col("_copy.bytes")}) \
            .drop("_copy")
    return _finish(routed.drop("_single", "_id", "_rehash"), cfg)


def _finish(routed: DataFrame, cfg: FootprintConfig) -> DataFrame:
    routed = routed.where(F.col("shard").isNotNull()).drop("raw_ts")
    if cfg.num_shards:
        routed = routed.withColumns({"route_key": F.col("shard").cast("string"),
                                     "shard": F.pmod("shard", F.lit(cfg.num_shards)).cast("int")})
    return routed


def add_labels(shards: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """``label`` of every shard."""
    number = F.col("shard").cast("string")
    if cfg.lists is not None and cfg.lists.split_size(cfg.split_by):
        table = cfg.lists.labels(cfg.split_by, cfg.mode == "both")
        table = table.select(F.col("shard").alias("l_key"), F.col("label").alias("_label"))
        return attach_split(shards, table, l_key=F.col("shard")) \
            .withColumn("label", F.coalesce("_label", number)).drop("_label")
    labels = cfg.shard_labels()
    if not labels:
        return shards.withColumn("label", number)
    table = config_table(shards, labels.items(), "l_key int, _label string")
    return attach(shards, table, l_key=F.col("shard")) \
        .withColumn("label", F.coalesce("_label", number)).drop("_label")


def label_map_network(label: Column) -> tuple[Column, Column]:
    """Map and network of a ``map^network^rest`` label, ``unknown`` for other labels."""
    parts = F.split(label, r"\^", 3)
    whole = (F.size(parts) == 3) & label.rlike(r"^[^^]+\^[^^]+\^\s*\S")
    unknown = F.lit("unknown")
    return (F.when(whole, F.get(parts, F.lit(0))).otherwise(unknown),
            F.when(whole, F.get(parts, F.lit(1))).otherwise(unknown))


def replication_shard(cfg: ReplicationConfig) -> Column:
    if cfg.url_buckets:
        return F.pmod(hex_prefix(F.col("md5"), 1, 4), F.lit(cfg.url_buckets)).cast("int")
    return F.pmod("serial", F.lit(REPLICATION_SERIAL_MODULUS)).cast("int")
