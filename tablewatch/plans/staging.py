"""Staging transforms (raw source -> cleaned ``stg_*`` table).

Parsing is tolerant, as a CSV loader must be: an unparsable timestamp or amount becomes
NULL instead of failing the job (``try_cast``). Timestamps are parsed to
``timestamp_ntz`` so the result does not depend on the session time zone. Every dedupe
keeps a deterministic survivor (``dedupe_latest``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.operators.latest import dedupe_latest

ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


#: A time of day followed by an offset, Z, or a zone name.
ZONED = r"[0-9]{1,2}:[0-9]{2}[0-9:.]*\s*([+-][0-9]{1,2}(:?[0-9]{2})?|Z|[A-Za-z]+(/[A-Za-z_]+)*([+-][0-9:]+)?)\s*$"


def clean_text(df: DataFrame, lower_trim: Sequence[str] = (), trim: Sequence[str] = ()) -> DataFrame:
    m = {c: F.trim(F.lower(F.col(c))) for c in lower_trim}
    m.update({c: F.trim(F.col(c)) for c in trim})
    return df.withColumns(m) if m else df


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text without a zone is taken as it stands; text with an offset or zone is converted to UTC."""
    return df.withColumns({c: _utc_timestamp(F.col(c).cast("string")) for c in columns}) if columns else df


def _utc_timestamp(text):
    moved = F.convert_timezone(F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(text.rlike(ZONED), moved).otherwise(text.try_cast("timestamp_ntz"))


def cast_decimals(df: DataFrame, columns: Sequence[str], precision: int = 10, scale: int = 2) -> DataFrame:
    t = f"decimal({precision},{scale})"
    return df.withColumns({c: F.col(c).try_cast(t) for c in columns}) if columns else df


def stage_customers(raw: DataFrame, key: str = "customer_id", city: str = "customer_city",
                    state: str = "customer_state") -> DataFrame:
    return dedupe_latest(clean_text(raw, lower_trim=[city], trim=[state]), [key])


def stage_orders(raw: DataFrame, key: str = "order_id", timestamps: Sequence[str] = ORDER_TIMESTAMPS) -> DataFrame:
    return dedupe_latest(parse_timestamps(raw, timestamps), [key])


def stage_order_items(raw: DataFrame, timestamps: Sequence[str] = ("shipping_limit_date",),
                      amounts: Sequence[str] = ("price", "freight_value")) -> DataFrame:
    """No dedupe: an order may list the same item number more than once in the source."""
    return cast_decimals(parse_timestamps(raw, timestamps), amounts)


def stage_products(raw: DataFrame, key: str = "product_id") -> DataFrame:
    """Dedupe only; NULL categories and measures are kept as delivered."""
    return dedupe_latest(raw, [key])


def stage_sellers(raw: DataFrame, key: str = "seller_id", city: str = "seller_city",
                  state: str = "seller_state") -> DataFrame:
    return dedupe_latest(clean_text(raw, lower_trim=[city], trim=[state]), [key])


# Raw source layouts: every field as delivered (text unless the file's own type is fixed),
# parsed by the staging step, so a malformed value becomes NULL instead of failing the read.
RAW_SCHEMAS = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                 "customer_city string, customer_state string",
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
              "order_approved_at string, order_delivered_customer_date string, order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
                   "shipping_limit_date string, price string, freight_value string",
    "products": "product_id string, product_category_name string, product_weight_g int, product_length_cm int, "
                "product_height_cm int, product_width_cm int",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
}
STAGERS = {
    "customers": stage_customers,
    "orders": stage_orders,
    "order_items": stage_order_items,
    "products": stage_products,
    "sellers": stage_sellers,
}
