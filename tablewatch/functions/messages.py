"""Result texts and their rendering as Spark expressions.

Detail texts are part of the result contract (users and alert readers parse them), so they
are kept verbatim here, and ``render`` turns a template plus column values into one
``concat`` expression (a literal text part for every fixed piece).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Detail texts of check results, drift, freshness, latency, unresolved
# lineage cases and the alert digest. {name} marks a value filled in per row.
NULL_DETAIL = "null_rate={rate}%, threshold={threshold}%, null_count={count}, total_rows={total}"
DUPLICATE_DETAIL = "duplicate_rate={rate}%, threshold={threshold}%, duplicate_count={count}, total_rows={total}"
MISSING_COLUMN_DETAIL = "column '{column}' not found in table (schema drift?)"
ORPHAN_DETAIL = "orphan_key_count={count} (distinct '{column}' values with no matching '{parent_column}' in parent table)"
FRESHNESS_DETAIL = "last_written={last}, staleness={hours}h, threshold={threshold}h"
NO_WRITE_DETAIL = "no successful pipeline run found for this table's source job"
DRIFT_BASELINE = "no prior snapshot -- recording baseline: {schema}"
DRIFT_NO_CHANGES = "no schema changes detected"
DRIFT_REMOVED = "removed columns: {columns}"
DRIFT_TYPE_CHANGES = "type changes: {changes}"
DRIFT_ADDED = "added columns: {columns}"
DRIFT_CURRENT = "{issues} | current_schema: {schema}"
LATENCY_SECONDS = "{n} seconds"
LATENCY_MINUTES = "{n} minutes"
LATENCY_HOURS = "{n} hours"
UNKNOWN_LATENCY = "unknown -- no prior successful write found for this table"
UNRESOLVED_DYNAMIC_TARGET = "<unknown - dynamic table name>"
REASON_DYNAMIC_TARGET = "saveAsTable() argument was not a plain string literal"
REASON_UNTRACED = "could not trace the DataFrame back to a read() call"
REASON_DYNAMIC_SOURCE = "source table name was not a plain string literal (built dynamically)"
DIGEST_HEADER = "Data Quality Alert -- {n} check(s) failing"
DIGEST_GENERATED = "Generated: {at}"
DIGEST_SUBJECT = "[DQ Alert] {n} check(s) failing"
DIGEST_TABLE = "Table:      {v}"
DIGEST_CHECK = "Check type: {v}"
DIGEST_COLUMN = "Column:     {v}"
DIGEST_DETAIL = "Detail:     {v}"
DIGEST_BLAST = "Blast radius: {n} table(s) potentially affected -- {tables}"
DIGEST_NO_BLAST = "Blast radius: none (failure contained to this table)"
DIGEST_HEAVY_RULE = "=" * 60
DIGEST_LIGHT_RULE = "-" * 60

_FIELD = re.compile(r"\{(\w+)\}")


def render(template: str, **values: Column | str) -> Column:
    """``template`` with every ``{name}`` replaced by ``values[name]`` (a column, or a
    driver-side string), as one ``concat`` expression."""
    pieces: list[Column] = []
    pos = 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            pieces.append(F.lit(template[pos:m.start()]))
        v = values[m.group(1)]
        pieces.append(v if isinstance(v, Column) else F.lit(str(v)))
        pos = m.end()
    if pos < len(template):
        pieces.append(F.lit(template[pos:]))
    return F.concat(*pieces) if len(pieces) > 1 else pieces[0]
