"""Later jobs over a bucketed stage of routed requests."""

from __future__ import annotations

import uuid

from cachecurve.scratch import scratch_root
from cachecurve.sinks.stage import attach_bucketed, bucket_count, object_totals, reuse_counts, write_bucketed
from workload.registry import query
from workload.stack_queries import EVENT_STACK, ITEM_STACK
from workload.views import EVENT_KEYS, routed_events, routed_items

BUCKETS = 8


def staged(routed):
    name = f"stage_{uuid.uuid4().hex}"
    path = f"{scratch_root(routed.sparkSession)}/cachecurve/{name}"
    buckets = bucket_count(routed, BUCKETS)
    write_bucketed(routed, name, path, buckets)
    return name, path, buckets


@query("stage_reuse_counts", EVENT_STACK + """
SELECT shard, t, count(*) AS requests FROM lnk WHERE t IS NOT NULL GROUP BY ALL""")
def stage_reuse_counts(spark, sf_dir):
    name, _, _ = staged(routed_events(spark, sf_dir))
    return reuse_counts(spark.table(name), tiebreak=EVENT_KEYS)


@query("stage_object_totals", ITEM_STACK + """,
objects AS (SELECT shard, md5, count(*) AS n, sum(bytes) AS b FROM req GROUP BY ALL)
SELECT shard, CAST(sum(n) AS BIGINT) AS requests, count(*) AS objects, count(*) FILTER (n = 1) AS single_objects,
  CAST(sum(b) AS BIGINT) AS bytes FROM objects GROUP BY shard""")
def stage_object_totals(spark, sf_dir):
    """Read as another session would, from the folder of the stage."""
    name, path, buckets = staged(routed_items(spark, sf_dir))
    return object_totals(attach_bucketed(spark, f"{name}_again", path, buckets))
