"""Registered queries over the benchmark tables, each with an equivalent DuckDB SQL text.

Every query reads whole tables (or metadata Spark derives from them, see ``derived``);
nothing is sampled or capped, except where the limit is the feature (recent runs,
the n-key fault sample).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.operators import checks as CK
from tablewatch.operators import drift as DR
from tablewatch.operators import freshness as FR
from tablewatch.operators import edges as ED
from tablewatch.operators import graph as GR
from tablewatch.operators.asof import asof_backward
from tablewatch.operators.digest import digest_lines, failure_digest
from tablewatch.operators.extract import extract_lineage, lineage_edges, unresolved_cases
from tablewatch.operators.faults import break_foreign_key, drop_column, stale_as_of
from tablewatch.operators.latency import detection_latency
from tablewatch.operators.latest import dedupe_latest
from tablewatch.operators.runlog import RunLog, current_runs, read_events
from tablewatch.plans import derived as D
from tablewatch.plans import staging as S
from tablewatch.plans import warehouse as WH
from tablewatch.plans import suite as SU
from tablewatch.plans import reports as RP
from tablewatch.plans.default_rules import DEFAULT_RULES
from tablewatch.session import cut_lineage, scratch_path
from tablewatch.sources.catalog import (
    append_results,
    preview,
    read_results,
    table_inventory,
    write_table,
)
from tablewatch.sources.files import read_csv, read_scripts
from tablewatch.sources.versioned import replace_table
from tablewatch.sources.rules import ForeignKey, Rules, TableRule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def T(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return D.load(spark, sf, name)


# =========================================================================================
# Raw-source projections: the benchmark tables shaped like the e-commerce source files
# (text timestamps, padded mixed-case names, zip codes with leading zeros).
# =========================================================================================

def raw_customers(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")).alias("customer_city"),
        F.concat(F.lit(" "), F.col("c_nationkey").cast("string")).alias("customer_state"),
    )


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def raw_orders(orders: DataFrame) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return orders.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.when(k % 101 == 0, F.lit(None)).when(k % 103 == 0, F.lit("bad-ts")).otherwise(_ts_text(d)).alias(
            "order_purchase_timestamp"),
        _ts_text(d + F.expr("INTERVAL 1 DAY")).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") == "F", _ts_text(d + F.expr("INTERVAL 10 DAYS"))).otherwise(
            F.lit("not delivered")).alias("order_delivered_customer_date"),
        F.date_format(d + F.expr("INTERVAL 14 DAYS"), "yyyy-MM-dd").alias("order_estimated_delivery_date"),
    )


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _ts_text(F.col("l_shipdate")).alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    )


def raw_products(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    return part.select(
        p.alias("product_id"),
        F.when(p % 13 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("product_category_name"),
        F.col("p_size").alias("product_weight_g"),
        (F.col("p_size") * 2).alias("product_length_cm"),
        (F.col("p_size") + 1).alias("product_height_cm"),
        (F.col("p_size") % 7).alias("product_width_cm"),
    )


def raw_sellers(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("seller_id"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("seller_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("seller_city"),
        F.col("s_nationkey").cast("string").alias("seller_state"),
    )


RAW_SQL = """
raw_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         '  ' || c_mktsegment || ' ' AS customer_city, ' ' || CAST(c_nationkey AS VARCHAR) AS customer_state
  FROM customer),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN 'bad-ts'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_purchase_timestamp,
         strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS order_approved_at,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d %H:%M:%S')
              ELSE 'not delivered' END AS order_delivered_customer_date,
         strftime(o_orderdate + INTERVAL 14 DAY, '%Y-%m-%d') AS order_estimated_delivery_date
  FROM orders),
raw_order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
         l_extendedprice AS price, l_quantity AS freight_value
  FROM lineitem),
raw_products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS product_category_name,
         p_size AS product_weight_g, p_size * 2 AS product_length_cm, p_size + 1 AS product_height_cm,
         p_size % 7 AS product_width_cm
  FROM part),
raw_sellers AS (
  SELECT s_suppkey AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
         ' ' || s_name || ' ' AS seller_city, CAST(s_nationkey AS VARCHAR) AS seller_state
  FROM supplier)"""

STG_SQL = RAW_SQL + """,
stg_customers AS (
  SELECT customer_id, customer_unique_id, customer_zip_code_prefix, trim(lower(customer_city)) AS customer_city,
         trim(customer_state) AS customer_state FROM raw_customers
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
          customer_zip_code_prefix NULLS FIRST, trim(lower(customer_city)) NULLS FIRST, trim(customer_state) NULLS FIRST) = 1),
stg_orders AS (
  SELECT order_id, customer_id, order_status,
         TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
         TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
         TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
         TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date
  FROM raw_orders
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST, order_status NULLS FIRST,
          TRY_CAST(order_purchase_timestamp AS TIMESTAMP) NULLS FIRST) = 1),
stg_order_items AS (
  SELECT order_id, order_item_id, product_id, seller_id,
         TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date,
         TRY_CAST(price AS DECIMAL(10,2)) AS price, TRY_CAST(freight_value AS DECIMAL(10,2)) AS freight_value
  FROM raw_order_items),
stg_products AS (
  SELECT * FROM raw_products
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_category_name NULLS FIRST) = 1),
stg_sellers AS (
  SELECT seller_id, seller_zip_code_prefix, trim(lower(seller_city)) AS seller_city, trim(seller_state) AS seller_state
  FROM raw_sellers
  QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix NULLS FIRST) = 1)"""

WH_SQL = STG_SQL + """,
dim_customer AS (SELECT customer_id, customer_unique_id, customer_city, customer_state, customer_zip_code_prefix
                 FROM stg_customers),
dim_product AS (SELECT product_id, product_category_name, product_weight_g, product_length_cm, product_height_cm,
                       product_width_cm FROM stg_products),
dim_seller AS (SELECT seller_id, seller_city, seller_state, seller_zip_code_prefix FROM stg_sellers),
dim_date AS (
  SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS full_date,
         CAST(strftime(CAST(order_purchase_timestamp AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         CAST(year(order_purchase_timestamp) AS INTEGER) AS year, CAST(month(order_purchase_timestamp) AS INTEGER) AS month,
         CAST(day(order_purchase_timestamp) AS INTEGER) AS day
  FROM stg_orders WHERE order_purchase_timestamp IS NOT NULL),
fact_order_items AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id,
         CAST(strftime(CAST(o.order_purchase_timestamp AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         i.price, i.freight_value, o.order_status
  FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id)"""


def staged(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "stg_customers": S.stage_customers(raw_customers(T(spark, sf, "customer"))),
        "stg_orders": S.stage_orders(raw_orders(T(spark, sf, "orders"))),
        "stg_order_items": S.stage_order_items(raw_order_items(T(spark, sf, "lineitem"))),
        "stg_products": S.stage_products(raw_products(T(spark, sf, "part"))),
        "stg_sellers": S.stage_sellers(raw_sellers(T(spark, sf, "supplier"))),
    }


def _with(sql_ctes: str, body: str) -> str:
    return f"WITH {sql_ctes}\n{body}"


@register("stage_customers", _with(STG_SQL, "SELECT * FROM stg_customers"))
def q_stage_customers(spark, sf):
    return S.stage_customers(raw_customers(T(spark, sf, "customer")))


@register("stage_orders", _with(STG_SQL, "SELECT * FROM stg_orders"))
def q_stage_orders(spark, sf):
    return S.stage_orders(raw_orders(T(spark, sf, "orders")))


@register("stage_order_items", _with(STG_SQL, "SELECT * FROM stg_order_items"))
def q_stage_order_items(spark, sf):
    return S.stage_order_items(raw_order_items(T(spark, sf, "lineitem")))


@register("stage_parts", _with(STG_SQL, "SELECT * FROM stg_products"))
def q_stage_parts(spark, sf):
    return S.stage_products(raw_products(T(spark, sf, "part")))


@register("stage_suppliers", _with(STG_SQL, "SELECT * FROM stg_sellers"))
def q_stage_suppliers(spark, sf):
    return S.stage_sellers(raw_sellers(T(spark, sf, "supplier")))


@register("dim_customer", _with(WH_SQL, "SELECT * FROM dim_customer"))
def q_dim_customer(spark, sf):
    return WH.dim_customer(staged(spark, sf)["stg_customers"])


@register("dim_product", _with(WH_SQL, "SELECT * FROM dim_product"))
def q_dim_product(spark, sf):
    return WH.dim_product(staged(spark, sf)["stg_products"])


@register("dim_seller", _with(WH_SQL, "SELECT * FROM dim_seller"))
def q_dim_seller(spark, sf):
    return WH.dim_seller(staged(spark, sf)["stg_sellers"])


@register("dim_date", _with(WH_SQL, "SELECT * FROM dim_date"))
def q_dim_date(spark, sf):
    return WH.dim_date(staged(spark, sf)["stg_orders"])


@register("fact_order_items", _with(WH_SQL, "SELECT * FROM fact_order_items"))
def q_fact_order_items(spark, sf):
    st = staged(spark, sf)
    return WH.fact_order_items(st["stg_order_items"], st["stg_orders"])


@register("dedupe_latest", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
  l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
  l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) = 1""")
def q_dedupe_latest(spark, sf):
    return dedupe_latest(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("run_metrics", _with(WH_SQL, """
, per AS (
  SELECT 'read' AS direction, 'stg_customers' AS table_name, count(*) AS row_count FROM stg_customers
  UNION ALL SELECT 'read', 'stg_orders', count(*) FROM stg_orders
  UNION ALL SELECT 'read', 'stg_order_items', count(*) FROM stg_order_items
  UNION ALL SELECT 'read', 'stg_products', count(*) FROM stg_products
  UNION ALL SELECT 'read', 'stg_sellers', count(*) FROM stg_sellers
  UNION ALL SELECT 'written', 'Dim_Customer', count(*) FROM dim_customer
  UNION ALL SELECT 'written', 'Dim_Product', count(*) FROM dim_product
  UNION ALL SELECT 'written', 'Dim_Seller', count(*) FROM dim_seller
  UNION ALL SELECT 'written', 'Dim_Date', count(*) FROM dim_date
  UNION ALL SELECT 'written', 'Fact_Order_Items', count(*) FROM fact_order_items)
SELECT * FROM per
UNION ALL SELECT direction, '*', CAST(sum(row_count) AS BIGINT) FROM per GROUP BY direction"""))
def q_run_metrics(spark, sf):
    st = staged(spark, sf)
    return WH.run_metrics(st, WH.warehouse_tables(st))


# =========================================================================================
# Checks: nulls, duplicates, referential integrity, schema drift, freshness, suite
# =========================================================================================


NULL_THR, DUP_THR, STALE_H = 1.0, 0.5, 24

# Column types of the benchmark tables as Spark names them (for drift texts in SQL).
TABLE_SCHEMAS = {
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
                 ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
               ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"),
             ("p_retailprice", "double")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _fixed_sql(x: str, d: int) -> str:
    return f"printf('%.{d}f', {x})"


def _iso_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN strftime({x}, '%f') = '000000' THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END")


def sql_table_checks(label: str, src: str, present: list[str], null_cols, keys, null_thr=NULL_THR, dup_thr=DUP_THR) -> str:
    """DuckDB rows (table_name, check_type, column_name, status, measured, threshold, detail)."""
    have = [c for c in null_cols if c in present]
    keys_ok = bool(keys) and all(k in present for k in keys)
    aggs = ["count(*) AS _total"] + [f"count_if({c} IS NULL) AS _null{i}" for i, c in enumerate(have)]
    if keys_ok:
        aggs.append(f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {src})) AS _distinct")
    prof = f"(SELECT {', '.join(aggs)} FROM {src})"
    parts = []
    for c in null_cols:
        if c not in present:
            parts.append(f"SELECT {_q(label)} AS table_name, 'null_check' AS check_type, {_q(c)} AS column_name, 'fail' AS status, "
                         f"CAST(NULL AS DOUBLE) AS measured, CAST(NULL AS DOUBLE) AS threshold, "
                         f"{_q(f'column {chr(39)}{c}{chr(39)} not found in table (schema drift?)')} AS detail")
            continue
        n = f"_null{have.index(c)}"
        rate = f"(CASE WHEN _total > 0 THEN {n} / _total * CAST(100.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"
        parts.append(
            f"SELECT {_q(label)} AS table_name, 'null_check' AS check_type, {_q(c)} AS column_name, "
            f"CASE WHEN {rate} > {float(null_thr)} THEN 'fail' ELSE 'pass' END AS status, "
            f"{rate} AS measured, CAST({float(null_thr)} AS DOUBLE) AS threshold, 'null_rate=' || {_fixed_sql(rate, 2)} || "
            f"'%, threshold={null_thr}%, null_count=' || CAST({n} AS VARCHAR) || ', total_rows=' || CAST(_total AS VARCHAR) "
            f"AS detail FROM {prof}")
    if keys:
        kt = ",".join(keys)
        if keys_ok:
            dup = "(_total - _distinct)"
            rate = f"(CASE WHEN _total > 0 THEN {dup} / _total * CAST(100.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"
            parts.append(
                f"SELECT {_q(label)} AS table_name, 'duplicate_check' AS check_type, {_q(kt)} AS column_name, "
                f"CASE WHEN {rate} > {float(dup_thr)} THEN 'fail' ELSE 'pass' END AS status, "
                f"{rate} AS measured, CAST({float(dup_thr)} AS DOUBLE) AS threshold, 'duplicate_rate=' || {_fixed_sql(rate, 2)} || "
                f"'%, threshold={dup_thr}%, duplicate_count=' || CAST({dup} AS VARCHAR) || ', total_rows=' || CAST(_total AS VARCHAR) "
                f"AS detail FROM {prof}")
    return "\nUNION ALL ".join(parts)


def sql_ri(label: str, child: str, fk: str, parent: str, pk: str, cast_text: bool = False) -> str:
    ck, pkx = (f"CAST({fk} AS VARCHAR)", f"CAST({pk} AS VARCHAR)") if cast_text else (fk, pk)
    return (
        f"SELECT {_q(label)} AS table_name, 'referential_integrity' AS check_type, {_q(fk)} AS column_name, "
        f"CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS status, CAST(n AS DOUBLE) AS measured, CAST(0.0 AS DOUBLE) AS threshold, "
        f"'orphan_key_count=' || CAST(n AS VARCHAR) || {_q(f' (distinct {chr(39)}{fk}{chr(39)} values with no matching {chr(39)}{pk}{chr(39)} in parent table)')} AS detail "
        f"FROM (SELECT count(*) AS n FROM (SELECT DISTINCT {ck} AS k FROM {child} WHERE {fk} IS NOT NULL) c "
        f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE {pkx} = c.k))")


FX_FAULT_SQL = """fx_lineitem AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
                    CASE WHEN l_orderkey % 500 = 0 THEN NULL ELSE l_tax END AS l_tax) FROM lineitem),
active_customer AS (SELECT * FROM customer WHERE c_custkey % 11 <> 0)"""

LINEITEM_NULLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_tax", "no_such_column"]
LINEITEM_COLS = [c for c, _ in TABLE_SCHEMAS["lineitem"]]


@register("null_check", f"WITH {FX_FAULT_SQL}\n" + sql_table_checks("lineitem", "fx_lineitem", LINEITEM_COLS, LINEITEM_NULLS, []))
def q_null_check(spark, sf):
    li = D.fx_fault_lineitem(T(spark, sf, "lineitem"))
    return CK.check_nulls(li, LINEITEM_NULLS, NULL_THR).select(F.lit("lineitem").alias("table_name"), "*")


@register("duplicate_check", sql_table_checks("lineitem", "lineitem", LINEITEM_COLS, [], ["l_orderkey", "l_linenumber"])
          + "\nUNION ALL " + sql_table_checks("orders", "orders", ["o_orderkey"], [], ["o_orderkey"]))
def q_duplicate_check(spark, sf):
    a = CK.check_duplicates(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], DUP_THR).select(
        F.lit("lineitem").alias("table_name"), "*")
    b = CK.check_duplicates(T(spark, sf, "orders"), ["o_orderkey"], DUP_THR).select(F.lit("orders").alias("table_name"), "*")
    return a.unionByName(b)


RI_CASES = [  # (child label, child relation, fk, parent relation, pk)
    ("lineitem", "fx_lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "fx_lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "fx_lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "orders", "o_custkey", "active_customer", "c_custkey"),
    ("events", "events", "user_id", "customer", "c_custkey"),
    ("labels", "labels", "doc_id", "documents", "doc_id"),
]


@register("referential_integrity", f"WITH {FX_FAULT_SQL}\n" + "\nUNION ALL ".join(sql_ri(*c) for c in RI_CASES))
def q_referential_integrity(spark, sf):
    rel = {
        "fx_lineitem": D.fx_fault_lineitem(T(spark, sf, "lineitem")),
        "active_customer": D.fx_active_customers(T(spark, sf, "customer")),
    }
    get = lambda n: rel[n] if n in rel else T(spark, sf, n)
    out = None
    for label, child, fk, parent, pk in RI_CASES:
        r = CK.check_referential_integrity(get(child), fk, get(parent), pk).select(F.lit(label).alias("table_name"), "*")
        out = r if out is None else out.unionByName(r)
    return out


# Keys of different types: the parent key as double, decimal and text, the child key as text.
RI_TYPES = [("double_parent", "bigint", "double"), ("decimal_parent", "bigint", "decimal(12,2)"), ("text_parent", "bigint", "string"),
            ("text_child", "string", "bigint"), ("int_child", "int", "bigint")]


@register("referential_integrity_types", f"WITH {FX_FAULT_SQL}\n" + "\nUNION ALL ".join(
    sql_ri(label, "orders", "o_custkey", "active_customer", "c_custkey") for label, _, _ in RI_TYPES))
def q_referential_integrity_types(spark, sf):
    child, parent = T(spark, sf, "orders"), D.fx_active_customers(T(spark, sf, "customer"))
    out = None
    for label, ct, pt in RI_TYPES:
        r = CK.check_referential_integrity(child.select(F.col("o_custkey").cast(ct)), "o_custkey",
                                           parent.select(F.col("c_custkey").cast(pt)), "c_custkey").select(F.lit(label).alias("table_name"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@register("timestamps_zoned", """SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS plain, CAST(o_orderdate AS TIMESTAMP) - INTERVAL 5 HOUR AS east,
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL 90 MINUTE AS west, CAST(o_orderdate AS TIMESTAMP) AS zulu FROM orders""")
def q_timestamps_zoned(spark, sf):
    text = F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    raw = T(spark, sf, "orders").select("o_orderkey", text.alias("plain"), F.concat(text, F.lit("+05:00")).alias("east"),
                                        F.concat(text, F.lit("-01:30")).alias("west"), F.concat(text, F.lit("Z")).alias("zulu"))
    return S.parse_timestamps(raw, ["plain", "east", "west", "zulu"])


# Schema-drift cases derived from part: table tbl_<p>, case p % 6 (0 first snapshot, 1 same,
# 2 column removed, 3 type changed, 4 column added, 5 removed + added).
_BASE = [("id", "bigint"), ("name", "string"), ("size", "int"), ("price", "double")]
_DRIFT_CUR = {
    0: _BASE, 1: _BASE, 2: [c for c in _BASE if c[0] != "size"],
    3: [(c, "bigint" if c == "size" else t) for c, t in _BASE],
    4: _BASE + [("brand", "string")], 5: [c for c in _BASE if c[0] != "price"] + [("brand", "string")],
}


def _drift_snapshots(part: DataFrame, which: str) -> DataFrame:
    p = F.col("p_partkey")
    k = (p % 6).cast("int")
    tbl = F.concat(F.lit("tbl_"), p.cast("string"))
    if which == "prev":
        arr = F.when(k != 0, F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type")) for c, t in _BASE]))
    else:
        arr = F.element_at(F.array(*[F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
                                                for c, t in _DRIFT_CUR[i]]) for i in range(6)]), k + 1)
    return part.select(tbl.alias("table_name"), F.explode(arr).alias("e")).select("table_name", "e.column_name", "e.data_type")


# What the six cases must give, by part key % 6.
DRIFT_EXPECTED_SQL = """WITH expected(k, status, measured, detail, current_schema) AS (VALUES
  (0, 'pass', 0, 'no prior snapshot -- recording baseline: {"id": "bigint", "name": "string", "price": "double", "size": "int"}',
   '{"id": "bigint", "name": "string", "price": "double", "size": "int"}'),
  (1, 'pass', 0, 'no schema changes detected | current_schema: {"id": "bigint", "name": "string", "price": "double", "size": "int"}',
   '{"id": "bigint", "name": "string", "price": "double", "size": "int"}'),
  (2, 'fail', 1, 'removed columns: [''size''] | current_schema: {"id": "bigint", "name": "string", "price": "double"}',
   '{"id": "bigint", "name": "string", "price": "double"}'),
  (3, 'fail', 1, 'type changes: {''size'': (''int'', ''bigint'')} | current_schema: {"id": "bigint", "name": "string", "price": "double", "size": "bigint"}',
   '{"id": "bigint", "name": "string", "price": "double", "size": "bigint"}'),
  (4, 'warn', 1, 'added columns: [''brand''] | current_schema: {"brand": "string", "id": "bigint", "name": "string", "price": "double", "size": "int"}',
   '{"brand": "string", "id": "bigint", "name": "string", "price": "double", "size": "int"}'),
  (5, 'fail', 2, 'removed columns: [''price'']; added columns: [''brand''] | current_schema: {"brand": "string", "id": "bigint", "name": "string", "size": "int"}',
   '{"brand": "string", "id": "bigint", "name": "string", "size": "int"}'))
SELECT 'tbl_' || CAST(p_partkey AS VARCHAR) AS table_name, 'schema_drift' AS check_type, CAST(NULL AS VARCHAR) AS column_name, status,
       CAST(measured AS DOUBLE) AS measured, CAST(NULL AS DOUBLE) AS threshold, detail, current_schema
FROM part JOIN expected ON k = p_partkey % 6"""


@register("schema_drift", DRIFT_EXPECTED_SQL)
def q_schema_drift(spark, sf):
    part = T(spark, sf, "part")
    return DR.check_schema_drift(_drift_snapshots(part, "cur"), _drift_snapshots(part, "prev"))


FX_RESULTS_SQL = """fx_results AS (
  SELECT event_id AS check_result_id, CAST(floor(event_id / 50) AS BIGINT) AS run_id,
         'tbl_' || CAST(user_id AS VARCHAR) AS table_name,
         CASE event_id % 5 WHEN 0 THEN 'null_check' WHEN 1 THEN 'duplicate_check' WHEN 2 THEN 'referential_integrity'
                           WHEN 3 THEN 'schema_drift' ELSE 'freshness' END AS check_type,
         CASE WHEN event_id % 5 = 0 THEN 'c' || CAST(event_id % 3 AS VARCHAR) END AS column_name,
         CASE WHEN event_id % 11 = 0 THEN 'fail' WHEN event_id % 11 = 1 THEN 'warn' ELSE 'pass' END AS status,
         'k=' || json_extract_string(props, '$.k') AS detail,
         date_trunc('hour', ts) AS checked_at
  FROM events)"""

FX_RUNS_SQL = """fx_runs AS (
  SELECT event_id AS run_id, 'job_' || CAST(user_id AS VARCHAR) AS job_name, ts - INTERVAL 20 SECOND AS started_at,
         CASE WHEN event_id % 97 = 1 THEN NULL ELSE ts END AS finished_at,
         CASE WHEN event_id % 97 = 1 THEN 'running' WHEN event_id % 10 = 0 THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN event_id % 97 = 1 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS rows_read,
         CASE WHEN event_id % 97 <> 1 AND event_id % 10 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS rows_written,
         CASE WHEN event_id % 97 = 1 THEN NULL ELSE CAST(20 AS DECIMAL(10,2)) END AS duration_seconds,
         CASE WHEN event_id % 97 <> 1 AND event_id % 10 = 0 THEN 'injected failure' END AS error_message
  FROM events)"""

FX_JOBS_SQL = """fx_jobs AS (
  SELECT 'job_' || CAST(c_custkey AS VARCHAR) AS job_name, 'src_' || CAST(c_custkey AS VARCHAR) AS source_table,
         'tbl_' || CAST(c_custkey AS VARCHAR) AS target_table, 'auto_parsed' AS source_type,
         TIMESTAMP '2024-01-01 00:00:00' AS detected_at
  FROM customer WHERE c_custkey % 7 <> 3)"""


def sql_producing_job(edges: str) -> str:
    return (f"(SELECT target_table AS table_name, job_name FROM {edges} QUALIFY row_number() OVER "
            f"(PARTITION BY target_table ORDER BY detected_at DESC NULLS LAST, job_name) = 1)")


def sql_freshness(tables: str, edges: str, runs: str, as_of: str, thr=STALE_H) -> str:
    now = f"TIMESTAMP '{as_of}'"
    hours = f"(CAST(date_diff('microsecond', w.last_written_at, {now}) AS DOUBLE) / CAST(1000000.0 AS DOUBLE) / CAST(3600.0 AS DOUBLE))"
    return (
        f"SELECT t.table_name, j.job_name, w.last_written_at, 'freshness' AS check_type, CAST(NULL AS VARCHAR) AS column_name, "
        f"CASE WHEN w.last_written_at IS NULL THEN 'fail' WHEN {hours} > {float(thr)} THEN 'fail' ELSE 'pass' END AS status, "
        f"{hours} AS measured, CAST({float(thr)} AS DOUBLE) AS threshold, "
        f"CASE WHEN w.last_written_at IS NULL THEN {_q(FR.NO_WRITE_DETAIL)} ELSE 'last_written=' || {_iso_sql('w.last_written_at')} "
        f"|| ', staleness=' || {_fixed_sql(hours, 2)} || 'h, threshold={thr}h' END AS detail "
        f"FROM {tables} t LEFT JOIN {sql_producing_job(edges)} j ON j.table_name = t.table_name "
        f"LEFT JOIN (SELECT job_name, max(finished_at) AS last_written_at FROM {runs} "
        f"WHERE status = 'success' AND finished_at IS NOT NULL GROUP BY job_name) w ON w.job_name = j.job_name")


@register("freshness", f"WITH {FX_RUNS_SQL}, {FX_JOBS_SQL}, tbls AS (SELECT 'tbl_' || CAST(c_custkey AS VARCHAR) AS table_name FROM customer)\n"
          + sql_freshness("tbls", "fx_jobs", "fx_runs", D.AS_OF))
def q_freshness(spark, sf):
    customer, events = T(spark, sf, "customer"), T(spark, sf, "events")
    return FR.check_freshness(D.fx_checked_tables(customer), D.fx_job_edges(customer), D.fx_runs(events), STALE_H, D.AS_OF)


@register("producing_job", f"WITH {FX_JOBS_SQL}\nSELECT * FROM {sql_producing_job('fx_jobs')}")
def q_producing_job(spark, sf):
    return FR.producing_job(D.fx_job_edges(T(spark, sf, "customer")))


# --- the suite -------------------------------------------------------------------------------------

SUITE_JOBS = {"lineitem": "job_1", "orders": "job_2", "customer": "job_3", "part": "job_4", "supplier": "job_5"}
SUITE_RULES = Rules(tables=(
    TableRule("lineitem", ("l_orderkey", "l_linenumber"), tuple(LINEITEM_NULLS), True,
              (ForeignKey("l_orderkey", "orders", "o_orderkey"), ForeignKey("l_partkey", "part", "p_partkey"),
               ForeignKey("l_suppkey", "supplier", "s_suppkey"))),
    TableRule("orders", ("o_orderkey",), ("o_orderkey", "o_custkey", "o_orderstatus"), True,
              (ForeignKey("o_custkey", "active_customer", "c_custkey"),)),
    TableRule("customer", ("c_custkey",), ("c_custkey", "c_name", "c_mktsegment"), True),
    TableRule("part", ("p_partkey",), ("p_partkey", "p_name", "p_brand"), True),
    TableRule("supplier", ("s_suppkey",), ("s_suppkey",), True),
    TableRule("events", ("event_id",), ("event_id", "ts", "user_id"), False,
              (ForeignKey("user_id", "all_customer", "c_custkey"),)),
    TableRule("labels", ("doc_id",), ("doc_id", "quality"), False, (ForeignKey("doc_id", "documents", "doc_id"),)),
))
SUITE_RUN_ID = 1


def suite_inputs(spark, sf):
    customer = T(spark, sf, "customer")
    tables = {
        "lineitem": D.fx_fault_lineitem(T(spark, sf, "lineitem")),
        "orders": T(spark, sf, "orders"),
        "customer": customer.drop("c_mktsegment"),
        "part": T(spark, sf, "part"),
        "supplier": T(spark, sf, "supplier"),
        "events": T(spark, sf, "events"),
        "labels": T(spark, sf, "labels"),
        "active_customer": D.fx_active_customers(customer),
        "all_customer": customer,
        "documents": T(spark, sf, "documents"),
    }
    previous = DR.schema_snapshot(spark, {n: T(spark, sf, n) for n in
                                          ("lineitem", "orders", "customer", "part", "supplier", "events", "labels")})
    edges = spark.createDataFrame([(j, t) for t, j in SUITE_JOBS.items()], "job_name string, target_table string").withColumn(
        "detected_at", F.lit(D.JOBS_AT).cast("timestamp_ntz"))
    return tables, previous.select("table_name", "column_name", "data_type"), edges, D.fx_runs(T(spark, sf, "events"))


def _suite_sql() -> str:
    rels = {"lineitem": "fx_lineitem", "customer": "customer_nomkt", "active_customer": "active_customer",
            "all_customer": "customer"}
    current = {t: list(cols) for t, cols in TABLE_SCHEMAS.items()}
    current["customer"] = [c for c in current["customer"] if c[0] != "c_mktsegment"]
    parts = []
    for r in SUITE_RULES.tables:
        src = rels.get(r.name, r.name)
        cols = [c for c, _ in current[r.name]]
        parts.append(sql_table_checks(r.name, src, cols, list(r.null_check_columns), list(r.key_columns)))
        for fk in r.referential_integrity:
            parts.append(sql_ri(r.name, src, fk.column, rels.get(fk.parent_table, fk.parent_table), fk.parent_column))
    for r in SUITE_RULES.tables:
        prev, now = dict(TABLE_SCHEMAS[r.name]), dict(current[r.name])
        js = json.dumps(now, sort_keys=True)
        removed = sorted(set(prev) - set(now))
        status = "fail" if removed else "pass"
        body = f"removed columns: {removed}" if removed else "no schema changes detected"
        parts.append(f"SELECT {_q(r.name)}, 'schema_drift', CAST(NULL AS VARCHAR), {_q(status)}, CAST({float(len(removed))} AS DOUBLE), "
                     f"CAST(NULL AS DOUBLE), {_q(body + ' | current_schema: ' + js)}")
    fresh_tables = " UNION ALL ".join(f"SELECT {_q(t)} AS table_name" for t in
                                      [r.name for r in SUITE_RULES.tables if r.freshness_check])
    jobs = " UNION ALL ".join(f"SELECT {_q(j)} AS job_name, {_q(t)} AS target_table, TIMESTAMP '{D.JOBS_AT}' AS detected_at"
                              for t, j in SUITE_JOBS.items())
    fresh = sql_freshness("suite_fresh", "suite_jobs", "fx_runs", D.AS_OF)
    parts.append(f"SELECT table_name, check_type, column_name, status, measured, threshold, detail FROM ({fresh})")
    union = "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    return (f"WITH {FX_FAULT_SQL}, {FX_RUNS_SQL}, customer_nomkt AS (SELECT * EXCLUDE (c_mktsegment) FROM customer),\n"
            f"suite_fresh AS ({fresh_tables}), suite_jobs AS ({jobs}),\n"
            f"res AS (SELECT CAST({SUITE_RUN_ID} AS BIGINT) AS run_id, u.*, TIMESTAMP '{D.AS_OF}' AS checked_at FROM (\n{union}) "
            f"AS u(table_name, check_type, column_name, status, measured, threshold, detail))\n")


@register("dq_suite", _suite_sql() + "SELECT * FROM res")
def q_dq_suite(spark, sf):
    tables, previous, edges, runs = suite_inputs(spark, sf)
    return SU.run_suite(spark, tables, SUITE_RULES, SUITE_RUN_ID, D.AS_OF, previous, edges, runs)


@register("dq_suite_totals", _suite_sql() + """SELECT run_id, count(*) AS checks_run,
  CAST(count_if(status = 'fail') AS BIGINT) AS checks_failed, CAST(count_if(status = 'warn') AS BIGINT) AS checks_warned,
  count(*) AS rows_read, count(*) AS rows_written FROM res GROUP BY run_id""")
def q_dq_suite_totals(spark, sf):
    return SU.suite_totals(q_dq_suite(spark, sf))


# --- latency, run log, snapshots ------------------------------------------------------------------

@register("detection_latency", f"""WITH {FX_RESULTS_SQL}, {FX_RUNS_SQL}, {FX_JOBS_SQL},
c AS (SELECT check_result_id, table_name, check_type, column_name, checked_at FROM fx_results WHERE status = 'fail'),
j AS (SELECT c.*, pj.job_name FROM c LEFT JOIN {sql_producing_job('fx_jobs')} pj ON pj.table_name = c.table_name),
a AS (SELECT j.*, (SELECT max(r.finished_at) FROM fx_runs r WHERE r.job_name = j.job_name AND r.status = 'success'
                   AND r.finished_at <= j.checked_at) AS last_written_at FROM j),
s AS (SELECT a.*, CAST(date_diff('microsecond', last_written_at, checked_at) AS DOUBLE) / CAST(1000000.0 AS DOUBLE) AS latency_seconds FROM a)
SELECT *, CASE WHEN latency_seconds IS NULL THEN 'unknown -- no prior successful write found for this table'
  WHEN latency_seconds < 60 THEN printf('%.0f', latency_seconds) || ' seconds'
  WHEN latency_seconds < 3600 THEN printf('%.1f', latency_seconds / 60) || ' minutes'
  ELSE printf('%.2f', latency_seconds / 3600) || ' hours' END AS latency_human FROM s""")
def q_detection_latency(spark, sf):
    events, customer = T(spark, sf, "events"), T(spark, sf, "customer")
    fails = D.fx_results(events).where(F.col("status") == "fail").select(
        "check_result_id", "table_name", "check_type", "column_name", "checked_at")
    return detection_latency(fails, D.fx_job_edges(customer), D.fx_runs(events))


FX_RUN_EVENTS_SQL = """ev AS (
  SELECT event_id AS run_id, 'job_' || CAST(user_id AS VARCHAR) AS job_name, ts - INTERVAL 20 SECOND AS event_time,
         'running' AS status, CAST(NULL AS BIGINT) AS rows_read, CAST(NULL AS BIGINT) AS rows_written,
         CAST(NULL AS VARCHAR) AS error_message FROM events
  UNION ALL
  SELECT event_id, 'job_' || CAST(user_id AS VARCHAR), ts, CASE WHEN event_id % 10 = 0 THEN 'failed' ELSE 'success' END,
         CAST(json_extract_string(props, '$.k') AS BIGINT),
         CASE WHEN event_id % 10 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END,
         CASE WHEN event_id % 10 = 0 THEN 'injected failure' END
  FROM events WHERE event_id % 97 <> 1)"""


@register("run_log_current", f"""WITH {FX_RUN_EVENTS_SQL},
st AS (SELECT run_id, max(job_name) AS job_name, min(CASE WHEN status = 'running' THEN event_time END) AS started_at
       FROM ev GROUP BY run_id),
fin AS (SELECT * FROM ev WHERE status <> 'running' QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY event_time DESC) = 1)
SELECT st.run_id, st.job_name, st.started_at, fin.event_time AS finished_at, coalesce(fin.status, 'running') AS status,
       fin.rows_read, fin.rows_written,
       CAST(CAST(floor((date_diff('microsecond', st.started_at, fin.event_time) + 5000) / 10000) AS DECIMAL(18,0)) / 100
            AS DECIMAL(10,2)) AS duration_seconds, fin.error_message
FROM st LEFT JOIN fin ON fin.run_id = st.run_id""")
def q_run_log_current(spark, sf):
    return current_runs(D.fx_run_events(T(spark, sf, "events")))


@register("last_snapshot", f"""WITH {FX_RESULTS_SQL},
r AS (SELECT * REPLACE (CASE WHEN check_type = 'schema_drift' THEN
        CASE WHEN check_result_id % 2 = 0 THEN 'no prior snapshot -- recording baseline: ' ELSE 'added columns: [''k''] | current_schema: ' END
        || '{{"k": "' || regexp_replace(detail, '^k=', '') || '", "user": "bigint"}}' ELSE detail END AS detail) FROM fx_results),
l AS (SELECT * FROM r WHERE check_type = 'schema_drift'
      QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY checked_at DESC, check_result_id DESC) = 1),
j AS (SELECT table_name, CASE WHEN instr(detail, 'current_schema: ') > 0 THEN substr(detail, instr(detail, 'current_schema: ') + 16)
        WHEN instr(detail, 'recording baseline: ') > 0 THEN substr(detail, instr(detail, 'recording baseline: ') + 20) END AS js FROM l)
SELECT table_name, e.key AS column_name, e.value ->> '$' AS data_type FROM j, json_each(j.js) e""")
def q_last_snapshot(spark, sf):
    return DR.last_snapshot(D.fx_drift_results(T(spark, sf, "events")))


# =========================================================================================
# Lineage: edges, graph closure, blast radius, extraction
# =========================================================================================



def _fx_edges_sql(name: str, where: str, at: str, type_expr: str = "'auto_parsed'") -> str:
    sel = ("SELECT 'job_' || CAST(p_partkey AS VARCHAR) AS job_name, 'tbl_' || CAST(p_partkey // {d} AS VARCHAR) AS source_table, "
           "'tbl_' || CAST(p_partkey AS VARCHAR) AS target_table, {t} AS source_type, TIMESTAMP '{at}' AS detected_at "
           "FROM part WHERE p_partkey > 0 AND ({w}){extra}")
    return (f"{name} AS (SELECT * FROM ({sel.format(d=3, t=type_expr, at=at, w=where, extra='')} UNION "
            f"{sel.format(d=2, t=type_expr, at=at, w=where, extra=' AND p_partkey % 5 = 0')}) WHERE source_table <> target_table)")


FX_EDGES_SQL = _fx_edges_sql("fx_edges", "true", D.EDGES_AT)
FX_OVERRIDES_SQL = """fx_overrides AS (
  SELECT 'job_' || CAST(p_partkey AS VARCHAR) AS job_name, 'tbl_' || CAST(p_partkey // 3 AS VARCHAR) AS source_table,
         'tbl_' || CAST(p_partkey AS VARCHAR) AS target_table, 'manual_override' AS source_type, TIMESTAMP '2024-01-03 00:00:00' AS detected_at
  FROM part WHERE p_partkey > 0 AND p_partkey % 50 = 0
  UNION ALL SELECT 'job_' || CAST(p_partkey AS VARCHAR), 'tbl_' || CAST(p_partkey // 2 AS VARCHAR), 'tbl_' || CAST(p_partkey AS VARCHAR),
         'manual_override', TIMESTAMP '2024-01-03 00:00:00' FROM part WHERE p_partkey > 0 AND p_partkey % 50 = 0
  UNION ALL SELECT 'job_' || CAST(p_partkey + 1 AS VARCHAR), 'tbl_' || CAST(p_partkey AS VARCHAR), 'tbl_' || CAST(p_partkey + 1 AS VARCHAR),
         'manual_override', TIMESTAMP '2024-01-03 00:00:00' FROM part WHERE p_partkey > 0 AND p_partkey % 50 = 0)"""
GRAPH_SQL = f"""{FX_EDGES_SQL}, {FX_OVERRIDES_SQL},
g AS (SELECT source_table, target_table, job_name, source_type, detected_at FROM (
        SELECT job_name, source_table, target_table, detected_at, 'auto_parsed' AS source_type FROM fx_edges
        UNION ALL SELECT job_name, source_table, target_table, detected_at, 'manual_override' FROM fx_overrides)
      QUALIFY row_number() OVER (PARTITION BY source_table, target_table ORDER BY
        CASE WHEN source_type = 'manual_override' THEN 1 ELSE 0 END DESC, detected_at DESC NULLS LAST, job_name) = 1)"""
CLOSURE_SQL = """down(root, node, depth) AS (
  SELECT source_table, target_table, 1 FROM g WHERE source_table <> target_table
  UNION SELECT d.root, g.target_table, d.depth + 1 FROM down d JOIN g ON g.source_table = d.node),
closure AS (SELECT root, node, min(depth) AS distance FROM down WHERE root <> node GROUP BY root, node)"""


def graph_edges(spark, sf) -> DataFrame:
    part = T(spark, sf, "part")
    return ED.combine_edges(D.fx_edges(part), D.fx_overrides(part))


@register("edges_upsert", f"""WITH {_fx_edges_sql('b1', 'p_partkey % 2 = 0', D.UPSERT_FIRST_AT)},
{_fx_edges_sql('b2', 'true', D.UPSERT_SECOND_AT, "CASE WHEN p_partkey % 3 = 0 THEN 'manual_override' ELSE 'auto_parsed' END")}
SELECT job_name, source_table, target_table, min({{'t': detected_at, 's': source_type}}).s AS source_type, max(detected_at) AS detected_at
FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2) GROUP BY job_name, source_table, target_table""")
def q_edges_upsert(spark, sf):
    first, second = D.fx_upsert_batches(T(spark, sf, "part"))
    return ED.upsert_edges(first, second)


@register("edges_combined", f"WITH RECURSIVE {GRAPH_SQL}\nSELECT * FROM g")
def q_edges_combined(spark, sf):
    return graph_edges(spark, sf)


@register("lineage_nodes", f"""WITH RECURSIVE {GRAPH_SQL}
SELECT DISTINCT t AS table_name FROM (SELECT source_table AS t FROM g UNION ALL SELECT target_table FROM g)""")
def q_lineage_nodes(spark, sf):
    return ED.lineage_nodes(graph_edges(spark, sf))


@register("lineage_roots_leaves", f"""WITH RECURSIVE {GRAPH_SQL},
ends AS (SELECT source_table AS t, 0 AS i, 1 AS o FROM g UNION ALL SELECT target_table, 1, 0 FROM g)
SELECT t AS table_name, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree,
       sum(i) = 0 AS is_root, sum(o) = 0 AS is_leaf FROM ends GROUP BY t""")
def q_lineage_roots_leaves(spark, sf):
    return ED.node_degrees(graph_edges(spark, sf))


LATEST_FAIL_SQL = """latest AS (SELECT * FROM fx_results QUALIFY rank() OVER (PARTITION BY table_name, check_type ORDER BY checked_at DESC) = 1),
fails AS (SELECT * FROM latest WHERE status = 'fail')"""


@register("lineage_downstream", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {LATEST_FAIL_SQL}, {CLOSURE_SQL}
SELECT root AS table_name, node AS downstream_table, CAST(distance AS INTEGER) AS distance FROM closure
WHERE root IN (SELECT table_name FROM fails)""")
def q_lineage_downstream(spark, sf):
    return GR.downstream(graph_edges(spark, sf), failing_tables(spark, sf))


@register("lineage_upstream", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {LATEST_FAIL_SQL}, {CLOSURE_SQL}
SELECT node AS table_name, root AS upstream_table, CAST(distance AS INTEGER) AS distance FROM closure
WHERE node IN (SELECT table_name FROM fails)""")
def q_lineage_upstream(spark, sf):
    return GR.upstream(graph_edges(spark, sf), failing_tables(spark, sf))


WALK_SQL = """walk(root, node, depth, path) AS (
  SELECT table_name, table_name, 0, [table_name] FROM (SELECT DISTINCT table_name FROM fails)
  UNION ALL SELECT w.root, g.target_table, w.depth + 1, list_append(w.path, g.target_table)
  FROM walk w JOIN g ON g.source_table = w.node WHERE NOT list_contains(w.path, g.target_table)),
radius AS (SELECT root AS failing_table, node AS affected_table, min({'d': depth, 'p': path}) AS best FROM walk
           WHERE root <> node GROUP BY root, node)"""


def failing_tables(spark, sf) -> DataFrame:
    return RP.failing_latest(D.fx_results(T(spark, sf, "events"))).select("table_name").distinct()


@register("blast_radius", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {LATEST_FAIL_SQL}, {WALK_SQL}
SELECT failing_table, affected_table, CAST(best.d AS INTEGER) AS distance, array_to_string(best.p, ' -> ') AS path_text FROM radius""")
def q_blast_radius(spark, sf):
    return GR.blast_radius(graph_edges(spark, sf), failing_tables(spark, sf)).drop("path")


@register("failing_with_blast_radius", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {LATEST_FAIL_SQL}, {WALK_SQL}
SELECT f.table_name, f.check_type, f.column_name, f.status, f.detail, f.checked_at,
       CAST(coalesce(c.n, 0) AS BIGINT) AS affected_count
FROM fails f LEFT JOIN (SELECT failing_table, count(*) AS n FROM radius GROUP BY failing_table) c ON c.failing_table = f.table_name""")
def q_failing_with_blast_radius(spark, sf):
    return RP.failing_with_blast_radius(graph_edges(spark, sf), D.fx_results(T(spark, sf, "events")))


@register("failure_drilldown", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {LATEST_FAIL_SQL}, {WALK_SQL}
SELECT f.table_name, f.check_type, f.column_name, r.affected_table, CAST(r.best.d AS INTEGER) AS distance,
       array_to_string(r.best.p, ' -> ') AS path_text
FROM fails f LEFT JOIN radius r ON r.failing_table = f.table_name""")
def q_failure_drilldown(spark, sf):
    return RP.failure_drilldown(graph_edges(spark, sf), D.fx_results(T(spark, sf, "events")))


SCRIPT_EDGES_SQL = """SELECT 'job_' || CAST(p_partkey AS VARCHAR) AS job_name, s AS source_table, t AS target_table FROM (
  SELECT p_partkey, 'src_' || CAST(p_partkey AS VARCHAR) AS s, 'tgt_' || CAST(p_partkey AS VARCHAR) AS t FROM part WHERE p_partkey % 6 = 0
  UNION ALL SELECT p_partkey, 'a_' || CAST(p_partkey AS VARCHAR), 'fact_' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 6 = 1
  UNION ALL SELECT p_partkey, 'b_' || CAST(p_partkey AS VARCHAR), 'fact_' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 6 = 1
  UNION ALL SELECT p_partkey, 'data/raw_' || CAST(p_partkey AS VARCHAR) || '.csv', 'left_' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 6 = 2
  UNION ALL SELECT p_partkey, 'data/raw_' || CAST(p_partkey AS VARCHAR) || '.csv', 'right_' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 6 = 2
  UNION ALL SELECT p_partkey, 'base_' || CAST(p_partkey AS VARCHAR), 'first_' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 6 = 5)"""


@register("extract_lineage", SCRIPT_EDGES_SQL)
def q_extract_lineage(spark, sf):
    ex = extract_lineage(D.fx_scripts(T(spark, sf, "part")))
    return lineage_edges(ex, F.lit(D.EDGES_AT).cast("timestamp_ntz")).select("job_name", "source_table", "target_table")


@register("extract_unresolved", """SELECT 'job_' || CAST(p_partkey AS VARCHAR) AS job_name,
  CASE p_partkey % 6 WHEN 3 THEN 'out_' || CAST(p_partkey AS VARCHAR) WHEN 4 THEN '<unknown - dynamic table name>'
       ELSE 'second_' || CAST(p_partkey AS VARCHAR) END AS target_table,
  CASE p_partkey % 6 WHEN 3 THEN 'source table name was not a plain string literal (built dynamically)'
       WHEN 4 THEN 'saveAsTable() argument was not a plain string literal'
       ELSE 'could not trace the DataFrame back to a read() call' END AS reason
FROM part WHERE p_partkey % 6 IN (3, 4, 5)""")
def q_extract_unresolved(spark, sf):
    return unresolved_cases(extract_lineage(D.fx_scripts(T(spark, sf, "part"))))


# =========================================================================================
# Reports over the check history and run log
# =========================================================================================

LATEST_SQL = "latest AS (SELECT * FROM fx_results QUALIFY rank() OVER (PARTITION BY table_name, check_type ORDER BY checked_at DESC) = 1)"
STATUS_SQL = """status_per_table AS (SELECT table_name, CASE max(CASE status WHEN 'pass' THEN 0 WHEN 'warn' THEN 1 WHEN 'fail' THEN 2 END)
  WHEN 0 THEN 'pass' WHEN 1 THEN 'warn' WHEN 2 THEN 'fail' END AS status FROM latest GROUP BY table_name)"""


def fx_results_df(spark, sf):
    return D.fx_results(T(spark, sf, "events"))


@register("latest_results", f"WITH {FX_RESULTS_SQL}, {LATEST_SQL}\n"
          "SELECT table_name, check_type, column_name, status, detail, checked_at FROM latest ORDER BY table_name, check_type")
def q_latest_results(spark, sf):
    return RP.all_latest_results(fx_results_df(spark, sf))


@register("status_per_table", f"WITH {FX_RESULTS_SQL}, {LATEST_SQL}, {STATUS_SQL}\nSELECT * FROM status_per_table")
def q_status_per_table(spark, sf):
    return RP.status_per_table(fx_results_df(spark, sf))


@register("dq_summary", f"""WITH {FX_RESULTS_SQL}, {LATEST_SQL}
SELECT s.status, (SELECT count(*) FROM latest l WHERE l.status = s.status) AS check_count
FROM (VALUES ('pass'), ('warn'), ('fail')) s(status)""")
def q_dq_summary(spark, sf):
    return RP.dq_summary(fx_results_df(spark, sf))


HISTORY_SQL = f"""history AS (SELECT CAST(checked_at AS DATE) AS check_date, status, count(*) AS check_count FROM fx_results
  WHERE checked_at >= TIMESTAMP '{D.AS_OF}' - INTERVAL 7 DAY GROUP BY ALL)"""


@register("dq_history", f"WITH {FX_RESULTS_SQL}, {HISTORY_SQL}\nSELECT * FROM history ORDER BY check_date, status")
def q_dq_history(spark, sf):
    return RP.dq_history(fx_results_df(spark, sf), 7, D.AS_OF)


@register("dq_history_pivot", f"""WITH {FX_RESULTS_SQL}, {HISTORY_SQL}
SELECT check_date, CAST(coalesce(sum(check_count) FILTER (WHERE status = 'pass'), 0) AS BIGINT) AS pass,
       CAST(coalesce(sum(check_count) FILTER (WHERE status = 'warn'), 0) AS BIGINT) AS warn,
       CAST(coalesce(sum(check_count) FILTER (WHERE status = 'fail'), 0) AS BIGINT) AS fail
FROM history GROUP BY check_date ORDER BY check_date""")
def q_dq_history_pivot(spark, sf):
    return RP.dq_history_pivot(RP.dq_history(fx_results_df(spark, sf), 7, D.AS_OF))


@register("recent_runs", f"""WITH {FX_RUNS_SQL}
SELECT run_id, job_name, started_at, finished_at, status, rows_read, rows_written, duration_seconds FROM fx_runs
ORDER BY started_at DESC NULLS LAST, run_id DESC LIMIT 20""")
def q_recent_runs(spark, sf):
    return RP.recent_runs(D.fx_runs(T(spark, sf, "events")), 20)


@register("results_filtered", f"""WITH {FX_RESULTS_SQL}, {LATEST_SQL}
SELECT table_name, check_type, column_name, status, detail, checked_at,
       CASE status WHEN 'pass' THEN 'pass' WHEN 'warn' THEN 'WARN' WHEN 'fail' THEN 'FAIL' END AS marker
FROM latest WHERE status IN ('warn', 'fail')
  AND table_name IN (SELECT 'tbl_' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def q_results_filtered(spark, sf):
    wanted = T(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.lit("tbl_"), F.col("c_custkey").cast("string")).alias("table_name"))
    return RP.results_filtered(fx_results_df(spark, sf), ["warn", "fail"], wanted)


@register("overview_metrics", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {LATEST_SQL}
SELECT 'tables_tracked' AS metric, count(DISTINCT t) AS value FROM (SELECT source_table AS t FROM g UNION ALL SELECT target_table FROM g)
UNION ALL SELECT 'lineage_edges', count(*) FROM (SELECT DISTINCT source_table, target_table FROM g)
UNION ALL SELECT 'checks_passing', CAST(count_if(status = 'pass') AS BIGINT) FROM latest
UNION ALL SELECT 'checks_failing', CAST(count_if(status = 'fail') AS BIGINT) FROM latest""")
def q_overview_metrics(spark, sf):
    return RP.overview_metrics(graph_edges(spark, sf), fx_results_df(spark, sf))


@register("node_status", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {LATEST_SQL}, {STATUS_SQL}
SELECT n.table_name, coalesce(s.status, 'not checked') AS status
FROM (SELECT DISTINCT t AS table_name FROM (SELECT source_table AS t FROM g UNION ALL SELECT target_table FROM g)) n
LEFT JOIN status_per_table s ON s.table_name = n.table_name""")
def q_node_status(spark, sf):
    return RP.node_status(graph_edges(spark, sf), fx_results_df(spark, sf))


@register("table_drilldown", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {LATEST_SQL}, {STATUS_SQL}, {CLOSURE_SQL},
nodes AS (SELECT DISTINCT t AS table_name FROM (SELECT source_table AS t FROM g UNION ALL SELECT target_table FROM g))
SELECT n.table_name,
       CAST(coalesce((SELECT count(*) FROM closure c WHERE c.node = n.table_name), 0) AS BIGINT) AS n_upstream,
       CAST(coalesce((SELECT count(*) FROM closure c WHERE c.root = n.table_name), 0) AS BIGINT) AS n_downstream,
       coalesce(s.status, 'not checked') AS status, coalesce(s.status = 'fail', false) AS alert
FROM nodes n LEFT JOIN status_per_table s ON s.table_name = n.table_name""")
def q_table_drilldown(spark, sf):
    return RP.table_drilldown(graph_edges(spark, sf), fx_results_df(spark, sf))


@register("failure_digest", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {CLOSURE_SQL},
fails AS (SELECT run_id, table_name, check_type, column_name, detail FROM fx_results WHERE status = 'fail'),
per_table AS (SELECT root AS table_name, count(*) AS n, string_agg(node, ', ' ORDER BY node) AS affected FROM closure GROUP BY root),
blocks AS (SELECT f.*, concat_ws(chr(10), 'Table:      ' || f.table_name, 'Check type: ' || f.check_type,
    CASE WHEN f.column_name IS NOT NULL AND f.column_name <> '' THEN 'Column:     ' || f.column_name END,
    'Detail:     ' || coalesce(f.detail, 'None'),
    CASE WHEN p.n > 0 THEN 'Blast radius: ' || CAST(p.n AS VARCHAR) || ' table(s) potentially affected -- ' || p.affected
         ELSE 'Blast radius: none (failure contained to this table)' END,
    repeat('-', 60)) AS block
  FROM fails f LEFT JOIN per_table p ON p.table_name = f.table_name)
SELECT run_id, count(*) AS failing_count, '[DQ Alert] ' || CAST(count(*) AS VARCHAR) || ' check(s) failing' AS subject,
  concat_ws(chr(10), 'Data Quality Alert -- ' || CAST(count(*) AS VARCHAR) || ' check(s) failing', 'Generated: 2024-01-31T00:00:00',
    repeat('=', 60), '', string_agg(block, chr(10) ORDER BY table_name, check_type, coalesce(column_name, ''), coalesce(detail, ''), block),
    '', 'See the failure drill-down report for full detail.') AS body
FROM blocks GROUP BY run_id""")
def q_failure_digest(spark, sf):
    results = fx_results_df(spark, sf)
    fails = results.where(F.col("status") == "fail").select("table_name").distinct()
    radius = GR.downstream(graph_edges(spark, sf), fails).select(
        F.col("table_name").alias("failing_table"), F.col("downstream_table").alias("affected_table"))
    return failure_digest(results, radius, D.AS_OF)


# =========================================================================================
# Faults, as-of lookups, catalog
# =========================================================================================

@register("fault_drop_column", "SELECT * EXCLUDE (c_mktsegment) FROM customer")
def q_fault_drop_column(spark, sf):
    return drop_column(T(spark, sf, "customer"), "c_mktsegment")


BREAK_FK_SQL = """dedup AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
  l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
  l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) = 1),
sample AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS rn FROM dedup
           ORDER BY l_orderkey, l_linenumber LIMIT 50),
broken AS (SELECT d.* REPLACE (CASE WHEN s.rn IS NULL THEN CAST(d.l_partkey AS VARCHAR) ELSE 'INVALID_' || CAST(s.rn AS VARCHAR) END
           AS l_partkey) FROM dedup d LEFT JOIN sample s ON s.l_orderkey = d.l_orderkey AND s.l_linenumber = d.l_linenumber)"""


def broken_lineitem(spark, sf) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return break_foreign_key(dedupe_latest(T(spark, sf, "lineitem"), keys), keys, "l_partkey", 50, "INVALID_")


@register("fault_break_fk", f"WITH {BREAK_FK_SQL}\nSELECT * FROM broken")
def q_fault_break_fk(spark, sf):
    return broken_lineitem(spark, sf)


@register("fault_break_fk_check", f"WITH {BREAK_FK_SQL}\n" + sql_ri("lineitem", "broken", "l_partkey", "part", "p_partkey", cast_text=True))
def q_fault_break_fk_check(spark, sf):
    b = broken_lineitem(spark, sf)
    return CK.check_referential_integrity(b, "l_partkey", T(spark, sf, "part"), "p_partkey").select(
        F.lit("lineitem").alias("table_name"), "*")


STALE_AS_OF = stale_as_of(datetime.fromisoformat(D.AS_OF), 30).isoformat(sep=" ")


@register("fault_stale", f"WITH {FX_RUNS_SQL}, {FX_JOBS_SQL}, tbls AS (SELECT 'tbl_' || CAST(c_custkey AS VARCHAR) AS table_name FROM customer)\n"
          + sql_freshness("tbls", "fx_jobs", "fx_runs", STALE_AS_OF))
def q_fault_stale(spark, sf):
    customer, events = T(spark, sf, "customer"), T(spark, sf, "events")
    return FR.check_freshness(D.fx_checked_tables(customer), D.fx_job_edges(customer), D.fx_runs(events), STALE_H, STALE_AS_OF)


@register("asof_last_write", f"""WITH {FX_RUNS_SQL}
SELECT e.event_id, 'job_' || CAST(e.user_id AS VARCHAR) AS job_name, e.ts,
       (SELECT max(r.finished_at) FROM fx_runs r WHERE r.job_name = 'job_' || CAST(e.user_id AS VARCHAR)
          AND r.status = 'success' AND r.finished_at <= e.ts) AS last_written_at
FROM events e""")
def q_asof_last_write(spark, sf):
    """Every event's latest successful write of its job at or before the event (inclusive)."""
    events = T(spark, sf, "events")
    left = events.select("event_id", F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("job_name"), "ts")
    runs = D.fx_runs(events).where(F.col("status") == "success").select("job_name", "finished_at")
    return asof_backward(left, runs, ["job_name"], "ts", "finished_at", out="last_written_at")




@register("table_inventory", "\nUNION ALL ".join(
    f"SELECT {_q(t)} AS table_name, true AS table_exists, count(*) AS row_count FROM {t}" for t in D.TABLES)
    + "\nUNION ALL SELECT 'no_such_table', false, CAST(NULL AS BIGINT)")
def q_table_inventory(spark, sf):
    tables: dict[str, DataFrame | None] = {t: T(spark, sf, t) for t in D.TABLES}
    tables["no_such_table"] = None
    return table_inventory(spark, tables)


@register("table_swap", "SELECT * EXCLUDE (c_mktsegment) FROM customer")
def q_table_swap(spark, sf):
    """Self-overwrite of a catalog table: the new contents are derived from the table itself."""
    name = f"tw_customer_{uuid.uuid4().hex[:10]}"
    write_table(T(spark, sf, "customer"), name, path=scratch_path(spark, name))
    replace_table(spark, drop_column(spark.read.table(name), "c_mktsegment"), name, path=scratch_path(spark, name))
    return spark.read.table(name)


@register("csv_roundtrip", "SELECT * FROM lineitem")
def q_csv_roundtrip(spark, sf):
    """Typed CSV source: the table written as headered CSV, read back with an explicit schema."""
    li = T(spark, sf, "lineitem")
    path = scratch_path(spark, "lineitem_csv")
    li.write.option("header", "true").csv(path)
    return read_csv(spark, path, li.schema)


@register("suite_report_lines", _suite_sql() + """SELECT run_id, table_name, check_type, column_name, status,
  rpad(CASE status WHEN 'pass' THEN 'pass' WHEN 'warn' THEN 'WARN' WHEN 'fail' THEN 'FAIL' END, 4, ' ') || ' '
  || rpad(check_type, 22, ' ') || ' ' || CASE WHEN column_name IS NOT NULL AND column_name <> '' THEN '[' || column_name || '] ' ELSE '' END
  || left(coalesce(detail, ''), 80) AS line FROM res""")
def q_suite_report_lines(spark, sf):
    return RP.report_lines(q_dq_suite(spark, sf))


@register("result_tables", f"WITH {FX_RESULTS_SQL}, {LATEST_SQL}\nSELECT DISTINCT table_name FROM latest ORDER BY table_name")
def q_result_tables(spark, sf):
    return RP.distinct_values(RP.latest_results(fx_results_df(spark, sf)), "table_name")


@register("results_history_pruned", f"WITH {FX_RESULTS_SQL}, {HISTORY_SQL}\nSELECT * FROM history")
def q_results_history_pruned(spark, sf):
    """Check history brought into a day-partitioned results table, then the 7-day trend read
    back from it: the day filter prunes partitions at the scan."""
    path = scratch_path(spark, "dq_check_results")
    append_results(fx_results_df(spark, sf), path, unit="day")
    return RP.dq_history(read_results(spark, path), 7, D.AS_OF)


# =========================================================================================
# The default configuration over the staged tables and the star schema (41 checks)
# =========================================================================================


WH_JOBS = {"stg_customers": "job_1", "stg_orders": "job_2", "stg_order_items": "job_3", "stg_products": "job_4",
           "stg_sellers": "job_5", "Fact_Order_Items": "job_6"}
# Column names and types of the staged tables and the fact.
WH_SCHEMAS = {
    "stg_customers": [("customer_id", "bigint"), ("customer_unique_id", "string"), ("customer_zip_code_prefix", "string"),
                      ("customer_city", "string"), ("customer_state", "string")],
    "stg_orders": [("order_id", "bigint"), ("customer_id", "bigint"), ("order_status", "string"),
                   ("order_purchase_timestamp", "timestamp_ntz"), ("order_approved_at", "timestamp_ntz"),
                   ("order_delivered_customer_date", "timestamp_ntz"), ("order_estimated_delivery_date", "timestamp_ntz")],
    "stg_order_items": [("order_id", "bigint"), ("order_item_id", "int"), ("product_id", "bigint"), ("seller_id", "bigint"),
                        ("shipping_limit_date", "timestamp_ntz"), ("price", "decimal(10,2)"), ("freight_value", "decimal(10,2)")],
    "stg_products": [("product_id", "bigint"), ("product_category_name", "string"), ("product_weight_g", "int"),
                     ("product_length_cm", "int"), ("product_height_cm", "int"), ("product_width_cm", "int")],
    "stg_sellers": [("seller_id", "bigint"), ("seller_zip_code_prefix", "string"), ("seller_city", "string"),
                    ("seller_state", "string")],
    "Fact_Order_Items": [("order_id", "bigint"), ("order_item_id", "int"), ("product_id", "bigint"), ("seller_id", "bigint"),
                         ("customer_id", "bigint"), ("date_key", "int"), ("price", "decimal(10,2)"),
                         ("freight_value", "decimal(10,2)"), ("order_status", "string")],
}
WH_REL = {"stg_customers": "stg_customers", "stg_orders": "stg_orders", "stg_order_items": "stg_order_items",
          "stg_products": "stg_products", "stg_sellers": "stg_sellers", "Fact_Order_Items": "fact_order_items",
          "Dim_Customer": "dim_customer", "Dim_Product": "dim_product", "Dim_Seller": "dim_seller", "Dim_Date": "dim_date"}


def _warehouse_suite_sql() -> str:
    parts = []
    for r in DEFAULT_RULES.tables:
        cols = [c for c, _ in WH_SCHEMAS[r.name]]
        parts.append(sql_table_checks(r.name, WH_REL[r.name], cols, list(r.null_check_columns), list(r.key_columns)))
        for fk in r.referential_integrity:
            parts.append(sql_ri(r.name, WH_REL[r.name], fk.column, WH_REL[fk.parent_table], fk.parent_column))
    for r in DEFAULT_RULES.tables:
        js = json.dumps(dict(WH_SCHEMAS[r.name]), sort_keys=True)
        parts.append(f"SELECT {_q(r.name)}, 'schema_drift', CAST(NULL AS VARCHAR), 'pass', CAST(0.0 AS DOUBLE), "
                     f"CAST(NULL AS DOUBLE), {_q('no prior snapshot -- recording baseline: ' + js)}")
    fresh_tables = " UNION ALL ".join(f"SELECT {_q(r.name)} AS table_name" for r in DEFAULT_RULES.tables if r.freshness_check)
    jobs = " UNION ALL ".join(f"SELECT {_q(j)} AS job_name, {_q(t)} AS target_table, TIMESTAMP '{D.JOBS_AT}' AS detected_at"
                              for t, j in WH_JOBS.items())
    fresh = sql_freshness("wh_fresh", "wh_jobs", "fx_runs", D.AS_OF)
    parts.append(f"SELECT table_name, check_type, column_name, status, measured, threshold, detail FROM ({fresh})")
    union = "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    return (f"WITH {WH_SQL}, {FX_RUNS_SQL}, wh_fresh AS ({fresh_tables}), wh_jobs AS ({jobs})\n"
            f"SELECT CAST(7 AS BIGINT) AS run_id, u.*, TIMESTAMP '{D.AS_OF}' AS checked_at FROM (\n{union}) "
            f"AS u(table_name, check_type, column_name, status, measured, threshold, detail)")


@register("warehouse_suite", _warehouse_suite_sql())
def q_warehouse_suite(spark, sf):
    """The default 41-check configuration on a first run (no earlier snapshots): 6 table
    aggregates, a foreign-key branch for each child table, drift and freshness, one result frame."""
    stg = staged(spark, sf)
    tables = {**stg, **WH.warehouse_tables(stg)}
    tables["Fact_Order_Items"] = cut_lineage(tables["Fact_Order_Items"])  # joined once, then checked as a stored table
    edges = spark.createDataFrame([(j, t) for t, j in WH_JOBS.items()], "job_name string, target_table string").withColumn(
        "detected_at", F.lit(D.JOBS_AT).cast("timestamp_ntz"))
    return SU.run_suite(spark, tables, DEFAULT_RULES, 7, D.AS_OF, None, edges, D.fx_runs(T(spark, sf, "events")))


@register("table_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 3")
def q_table_preview(spark, sf):
    """First rows of a table in key order (the limit is the feature: a preview)."""
    return preview(T(spark, sf, "orders").orderBy("o_orderkey"), 3)


# =========================================================================================
# After a run: failures with radius and latency, the digest as lines, logged jobs, script files
# =========================================================================================

# Which suite tables feed which, next to the derived lineage graph.
SUITE_SOURCES = {"lineitem": ("orders", "part", "supplier"), "orders": ("customer",), "tbl_1": ("lineitem",), "tbl_2": ("orders",)}
SUITE_EDGES_SQL = " UNION ALL ".join(
    f"SELECT {_q(SUITE_JOBS.get(t, 'job_0'))} AS job_name, {_q(s)} AS source_table, {_q(t)} AS target_table, TIMESTAMP '{D.JOBS_AT}' AS detected_at"
    for t, sources in SUITE_SOURCES.items() for s in sources)


def suite_edges(spark, sf) -> DataFrame:
    rows = [(SUITE_JOBS.get(t, "job_0"), s, t) for t, sources in SUITE_SOURCES.items() for s in sources]
    own = spark.createDataFrame(rows, "job_name string, source_table string, target_table string").withColumn(
        "detected_at", F.lit(D.JOBS_AT).cast("timestamp_ntz"))
    return own.unionByName(graph_edges(spark, sf).select(*own.columns))


@register("suite_failures", _suite_sql().replace("WITH ", "WITH RECURSIVE ", 1) + f""", {GRAPH_SQL},
sg AS ({SUITE_EDGES_SQL} UNION ALL SELECT job_name, source_table, target_table, detected_at FROM g),
f AS (SELECT * FROM res WHERE status = 'fail'),
reach(root, node) AS (SELECT DISTINCT f.table_name, sg.target_table FROM f JOIN sg ON sg.source_table = f.table_name
  UNION SELECT r.root, sg.target_table FROM reach r JOIN sg ON sg.source_table = r.node),
n AS (SELECT root, count(*) AS affected_count FROM reach WHERE root <> node GROUP BY root),
j AS (SELECT f.*, coalesce(n.affected_count, 0) AS affected_count, pj.job_name FROM f LEFT JOIN n ON n.root = f.table_name
      LEFT JOIN {sql_producing_job('sg')} pj ON pj.table_name = f.table_name),
a AS (SELECT j.*, (SELECT max(r.finished_at) FROM fx_runs r WHERE r.job_name = j.job_name AND r.status = 'success'
                   AND r.finished_at <= j.checked_at) AS last_written_at FROM j),
s AS (SELECT a.*, CAST(date_diff('microsecond', last_written_at, checked_at) AS DOUBLE) / CAST(1000000.0 AS DOUBLE) AS latency_seconds FROM a)
SELECT *, CASE WHEN latency_seconds IS NULL THEN 'unknown -- no prior successful write found for this table'
  WHEN latency_seconds < 60 THEN printf('%.0f', latency_seconds) || ' seconds'
  WHEN latency_seconds < 3600 THEN printf('%.1f', latency_seconds / 60) || ' minutes'
  ELSE printf('%.2f', latency_seconds / 3600) || ' hours' END AS latency_human FROM s""")
def q_suite_failures(spark, sf):
    """The failing rows of the suite run with their blast radius and detection latency, in one plan."""
    return SU.suite_failures(cut_lineage(q_dq_suite(spark, sf)), suite_edges(spark, sf), D.fx_runs(T(spark, sf, "events")))


@register("failure_digest_lines", f"""WITH RECURSIVE {FX_RESULTS_SQL}, {GRAPH_SQL}, {CLOSURE_SQL},
f AS (SELECT run_id, table_name, check_type, coalesce(column_name, '') AS c, coalesce(detail, 'None') AS d,
        row_number() OVER (PARTITION BY run_id ORDER BY table_name, check_type, coalesce(column_name, ''), coalesce(detail, '')) AS b
      FROM fx_results WHERE status = 'fail'),
nm AS (SELECT root, node, row_number() OVER (PARTITION BY root ORDER BY node) AS i FROM closure),
b AS (SELECT f.*, coalesce(k.n, 0) AS n, CASE WHEN c <> '' THEN 5 ELSE 4 END AS t
      FROM f LEFT JOIN (SELECT root, count(*) AS n FROM nm GROUP BY root) k ON k.root = f.table_name),
r AS (SELECT run_id, count(*) AS n FROM f GROUP BY run_id),
lines(run_id, block_no, line_no, line) AS (
  SELECT run_id, 0, 1, 'Data Quality Alert -- ' || CAST(n AS VARCHAR) || ' check(s) failing' FROM r
  UNION ALL SELECT run_id, 0, 2, 'Generated: 2024-01-31T00:00:00' FROM r
  UNION ALL SELECT run_id, 0, 3, repeat('=', 60) FROM r
  UNION ALL SELECT run_id, 0, 4, '' FROM r
  UNION ALL SELECT run_id, b, 1, 'Table:      ' || table_name FROM b
  UNION ALL SELECT run_id, b, 2, 'Check type: ' || check_type FROM b
  UNION ALL SELECT run_id, b, 3, 'Column:     ' || c FROM b WHERE c <> ''
  UNION ALL SELECT run_id, b, t - 1, 'Detail:     ' || d FROM b
  UNION ALL SELECT run_id, b, t, CASE WHEN n > 0 THEN 'Blast radius: ' || CAST(n AS VARCHAR) || ' table(s) potentially affected --'
                                      ELSE 'Blast radius: none (failure contained to this table)' END FROM b
  UNION ALL SELECT run_id, b, t + i, '  ' || node FROM b JOIN nm ON nm.root = b.table_name
  UNION ALL SELECT run_id, b, t + n + 1, repeat('-', 60) FROM b
  UNION ALL SELECT run_id, n + 1, 1, '' FROM r
  UNION ALL SELECT run_id, n + 1, 2, 'See the failure drill-down report for full detail.' FROM r)
SELECT run_id, CAST(block_no AS BIGINT) AS block_no, CAST(line_no AS BIGINT) AS line_no, line FROM lines""")
def q_failure_digest_lines(spark, sf):
    """The alert of every run as numbered lines: no group per run, affected tables as rows."""
    results = fx_results_df(spark, sf)
    fails = results.where(F.col("status") == "fail").select("table_name").distinct()
    radius = GR.downstream(graph_edges(spark, sf), fails).select(
        F.col("table_name").alias("failing_table"), F.col("downstream_table").alias("affected_table"))
    return digest_lines(results, radius, D.AS_OF)


@register("observed_load", _with(WH_SQL, """
SELECT CAST(1 AS BIGINT) AS run_id, 'load_order_items' AS job_name, 'success' AS status, (SELECT count(*) FROM raw_order_items) AS rows_read,
       (SELECT count(*) FROM stg_order_items) AS rows_written, CAST(NULL AS VARCHAR) AS error_message
UNION ALL SELECT 2, 'build_warehouse', 'success',
  (SELECT count(*) FROM stg_customers) + (SELECT count(*) FROM stg_orders) + (SELECT count(*) FROM stg_order_items)
    + (SELECT count(*) FROM stg_products) + (SELECT count(*) FROM stg_sellers),
  (SELECT count(*) FROM dim_customer) + (SELECT count(*) FROM dim_product) + (SELECT count(*) FROM dim_seller)
    + (SELECT count(*) FROM dim_date) + (SELECT count(*) FROM fact_order_items), NULL"""))
def q_observed_load(spark, sf):
    """A load and the warehouse build, logged: rows are counted while they are written, not by further passes."""
    at = scratch_path(spark, "observed_load")
    with RunLog(spark, f"{at}/runs", "load_order_items").run(1) as run:
        staged_items = S.stage_order_items(run.observe_read(raw_order_items(T(spark, sf, "lineitem"))))
        run.observe_write(staged_items).write.parquet(f"{at}/stg_order_items")
    with RunLog(spark, f"{at}/runs", "build_warehouse").run(2) as run:
        stg = staged(spark, sf) | {"stg_order_items": spark.read.parquet(f"{at}/stg_order_items")}
        WH.build_warehouse(stg, lambda name, df: df.write.parquet(f"{at}/{name}"), run)
    return current_runs(read_events(spark, f"{at}/runs")).select("run_id", "job_name", "status", "rows_read", "rows_written", "error_message")


@register("script_corpus", """SELECT CASE WHEN k = 'old' THEN 'archive of ' ELSE '' END || 'team ' || CAST(s_nationkey AS VARCHAR) || '/all loads' AS job_name,
  'raw_' || CAST(s_suppkey AS VARCHAR) AS source_table, k || '_' || CAST(s_suppkey AS VARCHAR) AS target_table
FROM supplier, (VALUES ('stg'), ('old')) v(k)""")
def q_script_corpus(spark, sf):
    """Lineage of scripts in files: written a folder each, listed and read by Spark, parsed, traced."""
    at = scratch_path(spark, "scripts")
    files = D.fx_script_files(T(spark, sf, "supplier"))
    files.repartition("folder").write.partitionBy("folder", "job").text(at)
    corpus = read_scripts(spark, at, pattern="part-*", named_by="folder")
    return extract_lineage(corpus).where("resolved").select("job_name", "source_table", "target_table")


@register("results_stored_once", _suite_sql() + "SELECT * FROM res")
def q_results_stored_once(spark, sf):
    """A suite run written, written again as a retry does, and read back."""
    path = scratch_path(spark, "dq_check_results")
    results = cut_lineage(q_dq_suite(spark, sf))
    for _ in range(2):
        append_results(results, path)
    return read_results(spark, path).select(*results.columns)
