"""Scalar column helpers (all JVM-side built-ins; no Python UDFs)."""

from tablewatch.functions.scalar import (  # noqa: F401
    SEVERITY,
    STATUS_MARKER,
    fixed,
    humanize_seconds,
    iso_text,
    json_object_text,
    percent,
    py_list_text,
    py_num,
    seconds_between,
    severity,
    status_over,
    type_string,
)
