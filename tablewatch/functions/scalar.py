"""Scalar functions used by the checks and reports.

Text renderings reproduce what Python's ``format``/``repr``/``json.dumps`` print, so detail
messages read the same as the ones users already parse:

* ``fixed(x, 2)`` is ``f"{x:.2f}"``: ``format_number`` with a ``0.00`` pattern rounds the
  exact binary value half-even, like Python and C ``printf``.
* ``iso_text(ts)`` is ``datetime.isoformat()`` (fraction only when non-zero).
* ``json_object_text`` is ``json.dumps(d, sort_keys=True)`` for string->string maps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tablewatch.functions.messages import LATENCY_HOURS, LATENCY_MINUTES, LATENCY_SECONDS, render

# Check statuses, their severity order and their console markers.
SEVERITY = {"pass": 0, "warn": 1, "fail": 2}
STATUS_MARKER = {"pass": "pass", "warn": "WARN", "fail": "FAIL"}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_num(v: float | int) -> str:
    """A threshold printed the way Python prints it (``1.0``, ``0.5``, ``24``)."""
    return str(v)


def percent(part: Column | str, total: Column | str) -> Column:
    """``part / total * 100`` with the zero-row guard (0.0 for an empty table)."""
    part, total = _c(part), _c(total)
    return F.when(total > 0, part / total * F.lit(100.0)).otherwise(F.lit(0.0))


def status_over(measured: Column | str, threshold: float) -> Column:
    """Strict ``>``: a value exactly at the threshold passes."""
    return F.when(_c(measured) > F.lit(float(threshold)), F.lit("fail")).otherwise(F.lit("pass"))


def fixed(x: Column | str, digits: int) -> Column:
    """``f"{x:.{digits}f}"`` for a double column (half-even on the exact binary value).

    ``format_number(x, '0.00')`` uses a DecimalFormat pattern without grouping separators.
    """
    pattern = "0" if digits == 0 else "0." + "0" * digits
    return F.call_function("format_number", _c(x), F.lit(pattern))


def iso_text(ts: Column | str) -> Column:
    """``datetime.isoformat()`` of a timestamp: microseconds only when non-zero."""
    ts = _c(ts)
    return (
        F.when(ts.isNull(), F.lit(None))
        .when(F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    )


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """``(end - start).total_seconds()`` as a double (microsecond exact, NTZ or LTZ)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1_000_000.0)


def humanize_seconds(seconds: Column | str) -> Column:
    """``N seconds`` below a minute, ``N.N minutes`` below an hour, else ``N.NN hours``."""
    s = _c(seconds)
    return (
        F.when(s.isNull(), F.lit(None))
        .when(s < 60, render(LATENCY_SECONDS, n=fixed(s, 0)))
        .when(s < 3600, render(LATENCY_MINUTES, n=fixed(s / 60, 1)))
        .otherwise(render(LATENCY_HOURS, n=fixed(s / 3600, 2)))
    )


def severity(status: Column | str) -> Column:
    """pass -> 0, warn -> 1, fail -> 2 (NULL for anything else)."""
    m = F.create_map(*[x for k, v in SEVERITY.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(status)]


def type_string(dt: DataType) -> str:
    """Stable type name of a column (``bigint``, ``decimal(10,2)``, ``timestamp_ntz``)."""
    return dt.simpleString()


def _json_str(s: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def json_object_text(entries: Column | str, key: str = "column_name", value: str = "data_type") -> Column:
    """``json.dumps(dict, sort_keys=True)`` of an array of (key, value) string structs."""
    arr = F.array_sort(F.transform(_c(entries), lambda e: F.struct(e[key].alias("k"), e[value].alias("v"))))
    body = F.array_join(F.transform(arr, lambda e: F.concat(_json_str(e["k"]), F.lit(": "), _json_str(e["v"]))), ", ")
    return F.concat(F.lit("{"), F.coalesce(body, F.lit("")), F.lit("}"))


def py_list_text(values: Column | str) -> Column:
    """``str(sorted(list_of_str))``: ``['a', 'b']``."""
    arr = F.array_sort(_c(values))
    return F.concat(F.lit("["), F.array_join(F.transform(arr, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "), F.lit("]"))


def utc_now():
    """The current time as timestamp_ntz in UTC, whatever the session time zone: the clock of all metadata."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
