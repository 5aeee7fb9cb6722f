"""Null, duplicate and referential-integrity checks.

Plan shape per table: ONE aggregate computes the row count, a ``count_if(isnull)`` per
checked column and the distinct-key count; the check rows are generated from that single
row. Referential integrity is one branch per child table whatever the number of its foreign keys: distinct child keys without a
match among the distinct parent keys, then a count. Both distincts are partial (map-side) aggregates that
leave the data hash-partitioned on the key, so the join adds no exchange, and a hot
key is reduced to one row per map task before anything is shuffled. A small parent is
broadcast by AQE from its measured runtime size.

Check row columns: check_type, column_name, status, measured, threshold, detail.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, NumericType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType, _parse_datatype_string)

from tablewatch.functions.messages import DUPLICATE_DETAIL, MISSING_COLUMN_DETAIL, NULL_DETAIL, ORPHAN_DETAIL, render
from tablewatch.functions.scalar import fixed, percent, py_num, status_over

CHECK_SCHEMA = StructType(
    [
        StructField("check_type", StringType(), False),
        StructField("column_name", StringType(), True),
        StructField("status", StringType(), False),
        StructField("measured", DoubleType(), True),
        StructField("threshold", DoubleType(), True),
        StructField("detail", StringType(), True),
    ]
)
CHECK_COLUMNS = [f.name for f in CHECK_SCHEMA.fields]


def check_row(check_type, column_name, status, measured, threshold, detail) -> Column:
    """A check-result struct; Python literals are typed directly, columns are cast."""
    def typed(v, t: str, name: str) -> Column:
        if isinstance(v, Column):
            return v.cast(t).alias(name)
        if v is None:
            return F.lit(None).cast(t).alias(name)
        return F.lit(float(v) if t == "double" else v).alias(name)

    return F.struct(
        typed(check_type, "string", "check_type"),
        typed(column_name, "string", "column_name"),
        typed(status, "string", "status"),
        typed(measured, "double", "measured"),
        typed(threshold, "double", "threshold"),
        typed(detail, "string", "detail"),
    )


def _missing_column_row(check_type: str, column: str) -> Column:
    return check_row(check_type, column, "fail", None, None, MISSING_COLUMN_DETAIL.format(column=column))


def table_checks(
    df: DataFrame,
    null_columns: Sequence[str] = (),
    key_columns: Sequence[str] = (),
    max_null_rate_pct: float = 1.0,
    max_duplicate_rate_pct: float = 0.5,
) -> DataFrame:
    """Null checks for ``null_columns`` and a duplicate check on ``key_columns``, one scan.

    * null rate = null_count / total * 100 (0.0 on an empty table); fail iff rate > threshold.
    * duplicate rate = (total - distinct key tuples) / total * 100, NULL counted as a value.
    * a configured column that is absent gives a fail row instead of an error.
    """
    present = [c for c in null_columns if c in df.columns]
    keys = list(key_columns)
    keys_ok = bool(keys) and all(k in df.columns for k in keys)

    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(present)]
    if keys_ok:
        aggs.append(F.count_distinct(F.struct(*[F.col(k) for k in keys])).alias("_distinct"))
    prof = df.agg(*aggs)

    total = F.col("_total")
    rows: list[Column] = []
    thr = py_num(max_null_rate_pct)
    for c in null_columns:
        if c not in df.columns:
            rows.append(_missing_column_row("null_check", c))
            continue
        n = F.col(f"_null{present.index(c)}")
        rate = percent(n, total)
        detail = render(NULL_DETAIL, rate=fixed(rate, 2), threshold=thr, count=n.cast("string"), total=total.cast("string"))
        rows.append(check_row("null_check", c, status_over(rate, max_null_rate_pct), rate, float(max_null_rate_pct), detail))
    if keys:
        key_text = ",".join(keys)
        if keys_ok:
            dup = total - F.col("_distinct")
            rate = percent(dup, total)
            dthr = py_num(max_duplicate_rate_pct)
            detail = render(DUPLICATE_DETAIL, rate=fixed(rate, 2), threshold=dthr, count=dup.cast("string"),
                            total=total.cast("string"))
            rows.append(check_row("duplicate_check", key_text, status_over(rate, max_duplicate_rate_pct), rate,
                                  float(max_duplicate_rate_pct), detail))
        else:
            absent = [k for k in keys if k not in df.columns]
            rows.append(check_row("duplicate_check", key_text, "fail", None, None,
                                  f"key column(s) not found in table: {','.join(absent)}"))
    if not rows:
        return df.sparkSession.createDataFrame([], CHECK_SCHEMA)
    return prof.select(F.inline(F.array(*rows)))


def check_nulls(df: DataFrame, columns: Sequence[str], max_null_rate_pct: float = 1.0) -> DataFrame:
    return table_checks(df, null_columns=columns, max_null_rate_pct=max_null_rate_pct)


def check_duplicates(df: DataFrame, key_columns: Sequence[str], max_duplicate_rate_pct: float = 0.5) -> DataFrame:
    return table_checks(df, key_columns=key_columns, max_duplicate_rate_pct=max_duplicate_rate_pct)


def orphan_keys(child: DataFrame, fk_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-NULL child keys with no parent row (column ``orphan_key``).

    Written as a left outer join of the two distinct key sets plus an ``IS NULL`` filter
    rather than a left-anti join: Catalyst pushes an anti join below the child's
    aggregate, which would shuffle every child row; this way each side is reduced to
    distinct keys map-side first and both arrive hash-partitioned on the key.
    """
    ct = child.schema[fk_column].dataType
    pt = parent.schema[parent_column].dataType
    ck, pk = F.col(fk_column), F.col(parent_column)
    common = common_key_type(ct, pt)
    if common:  # a text value that is no number, or out of range, is no key of the other side
        text = ck.cast("string")
        ck, pk = ck.try_cast(common), pk.try_cast(common)
        if isinstance(ct, StringType):
            strays = child.select(text.alias("orphan_key")).where(F.col("orphan_key").isNotNull() & ck.isNull()).distinct()
            return _orphans(child.select(ck.alias("orphan_key")), parent.select(pk.alias("orphan_key"))).select(
                F.col("orphan_key").cast("string").alias("orphan_key")).unionByName(strays)
    return _orphans(child.select(ck.alias("orphan_key")), parent.select(pk.alias("orphan_key")))


def common_key_type(a: DataType, b: DataType) -> str | None:
    """The type in which keys of the two types compare, as Spark's own equality does: a wide
    decimal (double if one side is floating) for numbers, timestamps for dates and times, and the other side's type
    for text. None when no cast is needed or only text is common."""
    if a == b:
        return None
    kinds = (a, b)
    if any(isinstance(t, StringType) for t in kinds):
        other = b if isinstance(a, StringType) else a
        if isinstance(other, (FloatType, DoubleType)):
            return "double"
        if isinstance(other, NumericType):
            return "decimal(38,10)"
        return other.simpleString() if isinstance(other, (DateType, TimestampType, TimestampNTZType, BooleanType)) else "string"
    if all(isinstance(t, NumericType) for t in kinds):
        if any(isinstance(t, (FloatType, DoubleType)) for t in kinds):
            return "double"
        scale = max((t.scale for t in kinds if isinstance(t, DecimalType)), default=0)
        return f"decimal(38,{scale})"
    if all(isinstance(t, (DateType, TimestampType, TimestampNTZType)) for t in kinds):
        return "timestamp" if any(isinstance(t, TimestampType) for t in kinds) else "timestamp_ntz"
    return "string"


def _orphans(child_keys: DataFrame, parent_keys: DataFrame) -> DataFrame:
    c = child_keys.where(F.col("orphan_key").isNotNull()).distinct()
    p = parent_keys.distinct().withColumn("_matched", F.lit(True))
    return c.join(p, "orphan_key", "left").where(F.col("_matched").isNull()).select("orphan_key")


def check_referential_integrity(
    child: DataFrame, fk_column: str, parent: DataFrame, parent_column: str, fail_on_any_orphan: bool = True
) -> DataFrame:
    """Count distinct orphan keys; any orphan -> fail (or warn when the flag is off)."""
    return check_foreign_keys(child, [(fk_column, parent, parent_column)], fail_on_any_orphan)


def _filler(kind: DataType) -> Column:
    """A constant for the key column of another type; both sides have it, so it matches itself."""
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    return F.lit("" if isinstance(kind, StringType) else 0).cast(kind)


def check_foreign_keys(
    child: DataFrame, keys: Sequence[tuple[str, DataFrame, str]], fail_on_any_orphan: bool = True, numbered: bool = False
) -> DataFrame:
    """``check_referential_integrity`` for all foreign keys ``(column, parent, parent column)`` of a table.

    The child is read once: each row gives one (number of the key, value) for every key that is not
    NULL, and their distinct set, reduced map-side, meets the distinct values of all parents in one join
    on number and value. Values have a column for each type that keys are compared in (see
    ``common_key_type``); a text that is no value of its parent's type is an orphan by itself.
    ``numbered`` adds the position of the key, ``fk_no``: two keys of one column may have equal rows.
    """
    spark: SparkSession = child.sparkSession
    rows: list[tuple[int, Column]] = []
    pairs: list[tuple[int, Column, Column, DataFrame, bool, str]] = []
    bad = "fail" if fail_on_any_orphan else "warn"
    for i, (fk_column, parent, parent_column) in enumerate(keys):
        if fk_column not in child.columns:
            rows.append((i, _missing_column_row("referential_integrity", fk_column)))
            continue
        if parent_column not in parent.columns:
            rows.append((i, check_row("referential_integrity", fk_column, "fail", None, None,
                                      f"parent column '{parent_column}' not found in parent table")))
            continue
        ct, pt = child.schema[fk_column].dataType, parent.schema[parent_column].dataType
        common = common_key_type(ct, pt)
        ck, pk = child[fk_column], F.col(parent_column)
        if common:
            ck, pk = ck.try_cast(common), pk.try_cast(common)
        pairs.append((i, ck, pk, parent, bool(common) and isinstance(ct, StringType), common or ct.simpleString()))
        n = F.col(f"n{i}")
        detail = render(ORPHAN_DETAIL, count=n.cast("string"), column=fk_column, parent_column=parent_column)
        status = F.when(n > 0, F.lit(bad)).otherwise(F.lit("pass"))
        rows.append((i, check_row("referential_integrity", fk_column, status, n, 0.0, detail)))
    found = F.inline(F.array(*(F.struct(row.alias("row"), F.lit(i).alias("fk_no")) for i, row in rows)))
    columns = ["row.*", "fk_no"] if numbered else ["row.*"]
    if not pairs:
        return spark.range(1).select(found).select(*columns) if rows else spark.createDataFrame([], CHECK_SCHEMA)
    kinds = list(dict.fromkeys(p[5] for p in pairs))
    names = ["fk_no", *(f"key{j}" for j in range(len(kinds))), "stray"]

    def entry(i: int, value: Column, kind: str, stray: Column) -> Column:
        by_kind = [(value if k == kind else _filler(_parsed(k))).alias(f"key{j}") for j, k in enumerate(kinds)]
        return F.struct(F.lit(i).alias("fk_no"), *by_kind, stray.alias("stray"))

    none, entries = F.lit(""), []
    for i, ck, _, _, text, kind in pairs:
        known = F.when(ck.isNotNull(), entry(i, ck, kind, none))
        if text:  # what cannot be cast is told apart by its text
            raw = child[keys[i][0]]
            known = F.when(ck.isNotNull(), entry(i, ck, kind, none)).when(
                raw.isNotNull(), entry(i, _filler(_parsed(kind)), kind, F.concat(F.lit("text "), raw)))
        entries.append(known)
    mine = child.select(F.inline(F.array_compact(F.array(*entries))).alias(*names)).distinct()
    theirs = reduce(DataFrame.unionByName, [
        parent.where(pk.isNotNull()).select(entry(i, pk, kind, none).alias("e")).select("e.*") for i, _, pk, parent, _, kind in pairs])
    matched = mine.join(theirs.distinct().withColumn("_matched", F.lit(True)), names, "left")
    orphan = F.col("_matched").isNull()
    counts = matched.agg(*(F.count_if(orphan & (F.col("fk_no") == i)).alias(f"n{i}") for i, *_ in pairs))
    return counts.select(found).select(*columns)


def _parsed(kind: str) -> DataType:
    return _parse_datatype_string(kind)
