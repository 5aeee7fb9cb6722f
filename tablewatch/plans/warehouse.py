"""Star schema: three projected dimensions, a day-grained date dimension, the item fact.

``build_warehouse`` writes all five tables and reports rows read/written through
``DataFrame.observe`` on the written plans: the counts are taken while the writes run,
without the separate count passes (and recomputation) a count-before/count-after job needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the star schema.
DIM_CUSTOMER_COLUMNS = ("customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix")
DIM_PRODUCT_COLUMNS = ("product_id", "product_category_name", "product_weight_g", "product_length_cm",
                       "product_height_cm", "product_width_cm")
DIM_SELLER_COLUMNS = ("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix")
FACT_COLUMNS = ("order_id", "order_item_id", "product_id", "seller_id", "customer_id", "date_key", "price",
                "freight_value", "order_status")


def date_key(ts) -> F.Column:
    """``yyyyMMdd`` integer key of the day of a timestamp."""
    return F.date_format(F.to_date(ts), "yyyyMMdd").cast("int")


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(*DIM_CUSTOMER_COLUMNS)


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(*DIM_PRODUCT_COLUMNS)


def dim_seller(stg_sellers: DataFrame) -> DataFrame:
    return stg_sellers.select(*DIM_SELLER_COLUMNS)


def dim_date(stg_orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Distinct non-NULL purchase days with key and parts (an order with no purchase time
    has a NULL date key and no date row)."""
    d = stg_orders.select(F.to_date(F.col(ts)).alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
    return d.select(
        "full_date",
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"),
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
    )


def fact_order_items(stg_order_items: DataFrame, stg_orders: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    """Inner join on ``order_id``: items whose order is missing are dropped."""
    orders = stg_orders.select("order_id", "customer_id", "order_status", date_key(F.col(ts)).alias("date_key"))
    return stg_order_items.join(orders, "order_id", "inner").select(*FACT_COLUMNS)


def warehouse_tables(stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "Dim_Customer": dim_customer(stg["stg_customers"]),
        "Dim_Product": dim_product(stg["stg_products"]),
        "Dim_Seller": dim_seller(stg["stg_sellers"]),
        "Dim_Date": dim_date(stg["stg_orders"]),
        "Fact_Order_Items": fact_order_items(stg["stg_order_items"], stg["stg_orders"]),
    }


def run_metrics(inputs: dict[str, DataFrame], outputs: dict[str, DataFrame]) -> DataFrame:
    """``(direction, table_name, row_count)`` for every input and output plus the two totals,
    as one union of partial-aggregated count branches (a single job)."""
    parts = []
    for direction, tables in (("read", inputs), ("written", outputs)):
        for name, df in tables.items():
            parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(direction).alias("direction"), F.lit(name).alias("table_name"), "row_count"))
    per_table = parts[0]
    for p in parts[1:]:
        per_table = per_table.unionByName(p)
    totals = per_table.groupBy("direction").agg(F.sum("row_count").alias("row_count")).select(
        "direction", F.lit("*").alias("table_name"), F.col("row_count").cast("long").alias("row_count"))
    return per_table.unionByName(totals)


def build_warehouse(stg: dict[str, DataFrame], write, run_log=None) -> dict[str, DataFrame]:
    """Write the five warehouse tables with ``write(name, df)``; when ``run_log``
    (``operators.runlog.RunLog``) is given the inputs and outputs are counted by
    observation during the writes (rows read = rows of the five staged inputs)."""
    if run_log is not None:
        stg = {name: run_log.observe_read(df) for name, df in stg.items()}
    tables = warehouse_tables(stg)
    for name, df in tables.items():
        out = run_log.observe_write(df) if run_log is not None else df
        write(name, out)
    return tables
