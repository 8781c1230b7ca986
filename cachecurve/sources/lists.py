"""Configuration lists kept in files.

Each reader returns a typed table. ``Lists`` holds such tables for the options of a job,
however long they are; ``load_rows`` brings a short one to the driver instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cachecurve.functions.columns import pack_ip
from cachecurve.operators.sequence import global_positions
from cachecurve.scratch import save
from cachecurve.sources.logs import LINE_ORDER, read_lines


def config_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a configuration file with their number, without comments, blank lines
    and lines that start with a space."""
    lines = read_lines(spark, path).withColumnRenamed("line_no", "_line")
    order = [F.col("_line" if c == "line_no" else c) for c in LINE_ORDER]
    numbered = global_positions(lines, order, "config_lines")
    return content_lines(numbered.select("value", F.col("pos").alias("line_no")))


def content_lines(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").rlike(r"^($|[#\s])"))


def _fields(value: str = "value") -> Column:
    return F.split(F.trim(F.col(value)), r"\s+")


def _int(i: int) -> Column:
    return F.get(_fields(), F.lit(i)).try_cast("int")


def _text(i: int) -> Column:
    return F.get(_fields(), F.lit(i))


def id_table(lines: DataFrame) -> DataFrame:
    """One positive id per line; other lines are skipped. ``line_no`` keeps the order."""
    number = F.regexp_extract("value", r"^\s*(\d+)", 1).try_cast("int")
    return lines.select("line_no", number.alias("id")).where("id > 0")


def ip_table(lines: DataFrame) -> DataFrame:
    """Dotted quads, also packed; a line that is none fails the job."""
    ip = F.regexp_extract("value", r"^(\d+\.\d+\.\d+\.\d+)", 1)
    wrong = F.raise_error(F.concat(F.lit("not an ip: "), "value")).cast("string")
    checked = lines.select("line_no", F.when(ip == "", wrong).otherwise(ip).alias("ip"))
    return checked.withColumn("packed", pack_ip(F.col("ip")))


def account_pairs(lines: DataFrame, accounts: Sequence[str] | None = None) -> DataFrame:
    """``line_no cpcode account`` of every ``cpcode account`` line, or of the given accounts' lines."""
    pairs = lines.select("line_no", _int(0).alias("cpcode"), _text(1).alias("account")) \
        .where("cpcode is not null and account is not null")
    return pairs.where(F.col("account").isin(list(accounts))) if accounts else pairs


def account_names(pairs: DataFrame) -> DataFrame:
    """``account_id account``: ids count accounts in order of first appearance."""
    seen = pairs.groupBy("account").agg(F.min("line_no").alias("_first"))
    return global_positions(seen, [F.col("_first")], "accounts") \
        .select(F.col("pos").cast("int").alias("account_id"), "account")


def account_table(lines: DataFrame, accounts: Sequence[str] | None = None) -> DataFrame:
    """``cpcode``, its lowest account id and that account's name, from lines ``cpcode
    account``."""
    pairs = account_pairs(lines, accounts)
    return lowest_accounts(pairs, account_names(pairs))


def lowest_accounts(pairs: DataFrame, names: DataFrame) -> DataFrame:
    return pairs.join(names, "account").groupBy("cpcode").agg(
        F.min(F.struct("account_id", "account")).alias("_low")) \
        .select("cpcode", "_low.account_id", "_low.account")


def vmn_table(lines: DataFrame) -> DataFrame:
    """``vcd map network label`` lines, numbered in order; a malformed line fails."""
    wrong = F.raise_error(F.concat(F.lit("cannot parse line: "), "value")).cast("int")
    vcd = F.when((F.size(_fields()) < 4) | _int(0).isNull(), wrong).otherwise(_int(0))
    rows = lines.select("line_no", vcd.alias("vcd"), _text(1).alias("map"),
                        _text(2).alias("network"), _text(3).alias("label"))
    return global_positions(rows, [F.col("line_no")], "vmn") \
        .select("vcd", "map", "network", "label", F.col("pos").cast("int").alias("id"))


def arl_table(lines: DataFrame) -> DataFrame:
    """``arlid vcd`` lines; the last line of an arl wins, a malformed line fails."""
    wrong = F.raise_error(F.concat(F.lit("cannot parse line: "), "value")).cast("int")
    broken = _int(0).isNull() | _int(1).isNull()
    return lines.select("line_no", F.when(broken, wrong).otherwise(_int(0)).alias("arlid"),
                        _int(1).alias("vcd")) \
        .groupBy("arlid").agg(F.max_by("vcd", "line_no").alias("vcd"))


def load_rows(table: DataFrame) -> list[tuple]:
    """All rows of a list that is known to be short, for the options."""
    return [tuple(r) for r in table.collect()]


@dataclass(frozen=True)
class Lists:
    """The lists of a job as saved tables, each optional. None of them goes to the driver: the job
    joins them, and only the number of their entries, which settles the shard numbers, is known there.

    ``cpcodes`` (cpcode, position; the last place of a repeated cpcode), ``accounts`` (cpcode, account_id,
    account), ``names`` (account_id, account), ``vmns`` (vcd, map, network, label, id; the last of a
    repeated triple) and ``arls`` (arlid, vcd). With ``listed``, requests of other cpcodes are dropped.
    """

    cpcodes: DataFrame | None = None
    accounts: DataFrame | None = None
    names: DataFrame | None = None
    vmns: DataFrame | None = None
    arls: DataFrame | None = None
    listed: DataFrame | None = None
    entries: dict[str, int] = field(default_factory=dict)

    @classmethod
    def of(cls, cpcodes: DataFrame | None = None, accounts: DataFrame | None = None,
           vmns: DataFrame | None = None, arls: DataFrame | None = None,
           only: Sequence[str] | None = None) -> Lists:
        """From ``config_lines``. ``only`` keeps the lines of the named accounts, whose
        cpcodes then are listed like those of ``cpcodes``."""
        found: dict[str, DataFrame] = {}
        entries: dict[str, int] = {}
        listed = []
        if cpcodes is not None:
            places = save(global_positions(id_table(cpcodes), [F.col("line_no")], "cpcodes")
                          .select(F.col("id").alias("cpcode"), F.col("pos").cast("int").alias("position")),
                          "cpcode_places")
            entries["cpcodes"] = places.count()
            found["cpcodes"] = save(places.groupBy("cpcode").agg(F.max("position").alias("position")), "cpcodes")
            listed.append(found["cpcodes"].select("cpcode"))
        if accounts is not None:
            pairs = save(account_pairs(accounts, only), "account_pairs")
            found["names"] = save(account_names(pairs), "account_names")
            found["accounts"] = save(lowest_accounts(pairs, found["names"]), "accounts")
            entries["names"] = found["names"].count()
            if only:
                listed.append(found["accounts"].select("cpcode"))
        if vmns is not None:
            rows = save(vmn_table(vmns), "vmn_rows")
            entries["vmns"] = rows.count()
            found["vmns"] = save(rows.groupBy("vcd", "map", "network").agg(
                F.max_by("label", "id").alias("label"), F.max("id").alias("id")), "vmns")
        if arls is not None:
            found["arls"] = save(arl_table(arls), "arls")
        if listed:
            every = listed[0] if len(listed) == 1 else listed[0].union(listed[1]).distinct()
            found["listed"] = save(every, "listed")
        return cls(**found, entries=entries)

    @classmethod
    def read(cls, spark: SparkSession, cpcodes: str | None = None, accounts: str | None = None,
             vmns: str | None = None, arls: str | None = None, only: Sequence[str] | None = None) -> Lists:
        """From files."""
        paths = {"cpcodes": cpcodes, "accounts": accounts, "vmns": vmns, "arls": arls}
        return cls.of(**{k: config_lines(spark, p) for k, p in paths.items() if p}, only=only)

    def labels(self, split_by: str, both: bool) -> DataFrame | None:
        """``shard label`` of the shards of a split, and of their miss copies."""
        if split_by == "cpcode":
            rows = self.cpcodes.select(F.col("position").alias("shard"), F.col("cpcode").cast("string").alias("label"))
        elif split_by == "account":
            rows = self.names.select(F.col("account_id").alias("shard"), F.col("account").alias("label"))
        elif split_by == "vmn":
            rows = self.vmns.select(F.col("id").alias("shard"), "label")
        else:
            return None
        if both:
            base = self.split_size(split_by)
            rows = rows.union(rows.select(F.col("shard") + base, F.concat("label", F.lit("^miss"))))
        return rows

    def split_size(self, split_by: str | None) -> int:
        """Entries of the list that a split numbers its shards by."""
        return self.entries.get({"cpcode": "cpcodes", "account": "names", "vmn": "vmns"}.get(split_by), 0)
