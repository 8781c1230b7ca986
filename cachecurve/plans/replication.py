"""The replication job: requests to copies per object."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachecurve.config import ReplicationConfig
from cachecurve.functions.columns import is_digest, object_id
from cachecurve.operators import filters, replication as ops
from cachecurve.operators.route import replication_shard
from cachecurve.scratch import save


@dataclass
class Replication:
    counts: DataFrame
    by_shard: DataFrame

    @property
    def dist(self) -> DataFrame:
        return ops.replication_dist(self.by_shard)

    @property
    def summary(self) -> DataFrame:
        return ops.replication_summary(self.by_shard)


def replication_records(requests: DataFrame, cfg: ReplicationConfig) -> DataFrame:
    """Filtered requests with the ``shard`` and ``obj`` the job groups by."""
    if "reject_reason" in requests.columns:
        requests = requests.where("reject_reason is null").drop("reject_reason")
    kept = filters.add_map_index(filters.with_raw_ts(requests), cfg) \
        .where(filters.in_time_range(cfg)).where(filters.match_filters(cfg)).drop("raw_ts")
    return kept.where(is_digest(F.col("md5"))).withColumns(
        {"shard": replication_shard(cfg), "obj": object_id(F.col("md5"))})


def record_order(requests: DataFrame) -> tuple[str, ...]:
    """What settles whose size an object has: time, then the place in the logs or,
    without one, all other columns, so that equal times give no choice."""
    place = [c for c in ("file", "block_start", "line_no") if c in requests.columns]
    return ("ts", *(place or sorted(c for c in requests.columns
                                    if c not in ("ts", "raw_ts", "reject_reason"))))


def replication(requests: DataFrame, cfg: ReplicationConfig,
                order: tuple[str, ...] | None = None) -> Replication:
    """Replication of parsed requests, whose ``ip`` is the server (``logs.add_server``)."""
    if "ip" not in requests.columns:
        raise ValueError("requests have no server: run a ReplicationJob or use add_server")
    return from_counts(ops.replica_counts(replication_records(requests, cfg), order or record_order(requests)))


def from_counts(counts: DataFrame) -> Replication:
    return Replication(counts, save(ops.replication_by_shard(counts), "replication"))
