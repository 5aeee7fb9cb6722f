"""DataFrame -> DataFrame operators: checks, drift, freshness, as-of, graph, lineage."""

from tablewatch.operators.asof import asof_backward  # noqa: F401
from tablewatch.operators.checks import (  # noqa: F401
    check_duplicates,
    check_nulls,
    check_referential_integrity,
    orphan_keys,
    table_checks,
)
from tablewatch.operators.digest import failure_digest  # noqa: F401
from tablewatch.operators.drift import check_schema_drift, last_snapshot, schema_snapshot  # noqa: F401
from tablewatch.operators.edges import combine_edges, lineage_nodes, node_degrees, upsert_edges  # noqa: F401
from tablewatch.operators.faults import break_foreign_key, drop_column, null_out, stale_as_of  # noqa: F401
from tablewatch.operators.freshness import check_freshness, last_successful_write, producing_job  # noqa: F401
from tablewatch.operators.graph import blast_radius, downstream, reachable, upstream  # noqa: F401
from tablewatch.operators.latency import detection_latency  # noqa: F401
from tablewatch.operators.latest import dedupe_latest, latest_per_key  # noqa: F401
from tablewatch.operators.runlog import RunLog, current_runs  # noqa: F401
