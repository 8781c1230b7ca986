"""Cache request log analytics on Spark: reuse-distance curves and replication."""

from cachecurve.config import FootprintConfig, PathFilter, ReplicationConfig
from cachecurve.plans.footprint import Footprint, footprint, routed_requests
from cachecurve.plans.replication import replication

__all__ = [
    "Footprint",
    "FootprintConfig",
    "PathFilter",
    "ReplicationConfig",
    "footprint",
    "replication",
    "routed_requests",
]
