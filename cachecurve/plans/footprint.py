"""The footprint job: requests to descriptor tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachecurve.config import FootprintConfig
from cachecurve.operators import describe, distance, filters, route, sequence
from cachecurve.scratch import save


def check_options(requests: DataFrame, cfg: FootprintConfig) -> None:
    """Options about lines, which parsed requests cannot follow any more, are an error here."""
    if cfg.sample_pct < 100:
        raise ValueError("sample_pct samples lines: run a FootprintJob or use sample_lines")
    if cfg.servers and "server_index" not in requests.columns:
        raise ValueError("servers needs the server of each line: run a FootprintJob or use keep_servers")


def routed_requests(requests: DataFrame, cfg: FootprintConfig) -> DataFrame:
    """Classify, filter, sample and route parsed requests; all of it before a shuffle."""
    check_options(requests, cfg)
    if "reject_reason" in requests.columns:
        requests = requests.where("reject_reason is null").drop("reject_reason")
    return route.route(filters.keep(filters.prepare(requests, cfg), cfg), cfg)


@dataclass
class Footprint:
    """Tables of one run over routed requests. Each is built when first asked for; the
    ordered and the linked requests are saved once and shared by the rest.

    ``tiebreak`` orders equal records, by default their line number; it lets copies of
    one record spread over tasks. With ``stage_routed`` the routed requests are saved
    first: Spark reads its input twice to find range bounds, which costs more than a
    parquet copy when the input is compressed text.
    """

    routed: DataFrame
    cfg: FootprintConfig
    tiebreak: tuple[str, ...] | None = None
    keep: tuple[str, ...] = ()

    def __post_init__(self):
        if self.tiebreak is None:
            self.tiebreak = ("line_no",) if "line_no" in self.routed.columns else ()

    @cached_property
    def _sequence(self) -> tuple[DataFrame, DataFrame]:
        routed = save(self.routed, "routed") if self.cfg.stage_routed else self.routed
        return sequence.order_requests(routed, self.cfg, self.tiebreak, self.keep)

    @property
    def ordered(self) -> DataFrame:
        return self._sequence[0]

    @property
    def pieces(self) -> DataFrame:
        return self._sequence[1]

    @cached_property
    def facts(self) -> DataFrame:
        return sequence.shard_facts(self.pieces)

    @cached_property
    def requests(self) -> DataFrame:
        """Stack requests with ``seq``, ``prewarm`` and ``bypass``."""
        admitted = sequence.admit(sequence.accesses(self.ordered), self.sliced)
        return admitted if self.cfg.admission_pct >= 100 else save(admitted, "admitted")

    @cached_property
    def linked(self) -> DataFrame:
        stacked = sequence.stack_positions(self.requests, self.sliced)
        linked = save(sequence.link_accesses(stacked, self.sliced, self.slices), "linked")
        return sequence.sampled_links(linked, self.cfg)

    @cached_property
    def stack_requests(self) -> int:
        return sequence.stack_request_count(self.pieces)

    @property
    def sliced(self) -> FootprintConfig:
        """The options with the slice size settled."""
        return self.cfg.sliced(self.stack_requests)

    @property
    def slices(self) -> int:
        return max(-(-self.stack_requests // self.sliced.slice_rows), 1)

    @cached_property
    def distance_parts(self) -> DataFrame:
        return distance.distance_parts(self.linked, self.sliced)

    @cached_property
    def distances(self) -> DataFrame:
        return distance.stack_distance(self.distance_parts)

    @cached_property
    def histogram(self) -> DataFrame:
        """One row per shard and second, saved for the curve and the hit rates."""
        return save(describe.reuse_histogram(self.linked, self.distance_parts), "histogram")

    @cached_property
    def object_intervals(self) -> DataFrame:
        return describe.object_intervals(self.linked)

    @cached_property
    def totals(self) -> DataFrame:
        return describe.served_totals(self.requests, self.cfg)

    @cached_property
    def summary(self) -> DataFrame:
        objects = None if self.cfg.prewarm_s > 0 else describe.distinct_objects(self.ordered)
        skipped = describe.skipped_totals(self.ordered) \
            if self.cfg.sample_at == "reduce" else None
        return save(describe.shard_summary(
            self.facts, self.totals, describe.stack_totals(self.linked),
            objects, skipped, self.cfg), "summary")

    @cached_property
    def raw_curve(self) -> DataFrame:
        transitions = describe.copy_transitions(self.object_intervals)
        return describe.raw_curve(self.histogram, transitions, self.cfg)

    @cached_property
    def header(self) -> DataFrame:
        return describe.fd_header(self.summary)

    @cached_property
    def curve(self) -> DataFrame:
        thinned = describe.thin_curve(self.raw_curve, self.cfg.thinning_pct)
        return describe.fd_curve(thinned, self.summary)

    @cached_property
    def hit_rates(self) -> DataFrame:
        return describe.hit_rate_curve(self.raw_curve, self.totals)

    @cached_property
    def serial_info(self) -> DataFrame:
        return describe.scaled_serial_info(
            describe.serial_info(self.requests, self.linked), self.summary)

    @cached_property
    def periods(self) -> DataFrame:
        configured = sequence.configured_periods(self.cfg)
        return self.facts.select("*", *[F.lit(v).cast("bigint").alias(k)
                                        for k, v in configured.items()])


def footprint(requests: DataFrame, cfg: FootprintConfig,
              tiebreak: tuple[str, ...] | None = None, keep: tuple[str, ...] = ()) -> Footprint:
    return Footprint(routed_requests(requests, cfg), cfg, tiebreak, keep)
