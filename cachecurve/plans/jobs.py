"""Whole jobs, from a folder of logs to written results, with every option at work.

The steps, in order: choice of files by path rules, whitelist and server, before any is opened; lines
with their server; line sample; parsing; classification and routing, whose counters are taken in the same pass; the
routed requests are saved once, and all results come from that table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig, PathFilter, ReplicationConfig, ip_list
from cachecurve.operators import filters, parse, replication as ops, route
from cachecurve.plans.footprint import Footprint
from cachecurve.plans.replication import Replication, from_counts, record_order, replication_records
from cachecurve.scratch import save
from cachecurve.sinks import tables
from cachecurve.sources import logs, paths

_PARSE_REASONS = ("comment", "layout", "serial")


def full_name(spark: SparkSession, path: str) -> str:
    """A folder as the listing of its store spells it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.makeQualified(folder).toString()


@dataclass
class LogFiles:
    """Which files below ``path`` a job reads. ``whitelist`` holds rows of ``paths.parse_whitelist``
    brought to the driver (``lists.load_rows``), or whitelist lines."""

    path: str
    rule: PathFilter | None = None
    whitelist: Sequence[tuple | str] = ()
    strict: bool = False

    def prune(self, spark: SparkSession, servers: Sequence[str]) -> logs.Prune:
        base = full_name(spark, self.path)
        entries = list(self.whitelist)
        if entries and isinstance(entries[0], str):
            lines = spark.createDataFrame([(e,) for e in entries], "value string")
            entries = [tuple(row) for row in paths.parse_whitelist(lines).collect()]

        def prune(files: DataFrame) -> DataFrame:
            files = paths.filter_paths(files, self.rule, base)
            if self.whitelist:
                files = paths.whitelist_paths(files, entries, base, strict=self.strict)
            return files.where(logs.listed_server(F.col("file"), servers)) if servers else files

        return prune

    def lines(self, spark: SparkSession, servers: Sequence[str] = ()) -> DataFrame:
        lines = logs.read_logs(spark, self.path, self.prune(spark, servers))
        return logs.keep_servers(lines, list(servers))


def observed(rows: DataFrame, reasons: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``rows`` that count themselves by ``reject_reason`` while some action reads them."""
    counters = Observation()
    reason = F.coalesce("reject_reason", F.lit("ok"))
    counts: list[Column] = [F.count_if(reason == name).alias(name) for name in reasons]
    return rows.observe(counters, *counts), counters


@dataclass
class FootprintJob:
    """Footprint descriptors of a folder of logs.

    ``counters`` are lines by reason, ``ok`` for those routed, and ``routed`` the emitted copies; they come
    from the pass that writes the routed requests.
    """

    spark: SparkSession
    files: LogFiles
    cfg: FootprintConfig
    counters: dict[str, int] = field(default_factory=dict, init=False)

    def classified(self) -> DataFrame:
        """All requests and rejected lines of the sample, with the reason for which they go."""
        lines = self.files.lines(self.spark, ip_list(self.cfg.servers))
        lines = filters.sample_lines(lines, self.cfg.sample_pct, self.cfg.sample_seed)
        return filters.classify(filters.prepare(parse.parse_requests(lines), self.cfg), self.cfg)

    def reasons(self) -> list[str]:
        return [*_PARSE_REASONS, *filters.keep_rules(self.cfg), "ok"]

    @cached_property
    def routed(self) -> DataFrame:
        """Routed requests, saved."""
        rows, by_reason = observed(self.classified(), self.reasons())
        emitted = Observation()
        copies = route.route(rows.where("reject_reason is null").drop("reject_reason"), self.cfg)
        saved = save(copies.observe(emitted, F.count(F.lit(1)).alias("routed")), "routed")
        self.counters = by_reason.get | emitted.get
        return saved

    @cached_property
    def footprint(self) -> Footprint:
        return Footprint(self.routed, self.cfg)

    def counter_table(self) -> DataFrame:
        _ = self.routed
        return self.spark.createDataFrame(list(self.counters.items()), "reason string, lines bigint")

    def write(self, out: str, serials: bool = True) -> None:
        """Tables of header, curve, hit rates, periods and counters and the text form of the
        descriptor, and if wanted table and text of the serials."""
        found = self.footprint
        tables.write_table(found.header, f"{out}/header")
        tables.write_table(found.curve, f"{out}/curve")
        for name in ("hit_rates", "periods"):
            getattr(found, name).write.mode("overwrite").parquet(f"{out}/{name}")
        self.counter_table().coalesce(1).write.mode("overwrite").parquet(f"{out}/counters")
        tables.write_text(tables.descriptor_text(found.header, found.curve), f"{out}/descriptor")
        if serials:
            tables.write_table(found.serial_info, f"{out}/serials")
            tables.write_text(tables.serial_text(found.serial_info), f"{out}/serial_text")


@dataclass
class ReplicationJob:
    """Servers per object over a folder of logs, in parts that merge.

    A part holds a row for each object and server of the logs it was made from; parts of other
    days are merged without reading those logs again.
    """

    spark: SparkSession
    files: LogFiles
    cfg: ReplicationConfig
    counters: dict[str, int] = field(default_factory=dict, init=False)

    def requests(self) -> DataFrame:
        lines = logs.add_server(self.files.lines(self.spark), self.cfg.ip_from)
        return parse.parse_requests(lines, layouts=parse.REPLICATION_LAYOUTS)

    def write_part(self, path: str) -> None:
        rows, by_reason = observed(self.requests(), [*_PARSE_REASONS, "ok"])
        records = replication_records(rows, self.cfg)
        ops.server_rows(records, record_order(rows)).write.parquet(path)
        self.counters = by_reason.get


def merged_parts(spark: SparkSession, *parts: str) -> Replication:
    """The replication of all logs that the parts were made from, which may overlap."""
    rows = spark.read.parquet(*parts)
    return from_counts(ops.counts_of(ops.merged_servers(rows)))
