"""Default check rules for the staged e-commerce tables and the star schema."""

from tablewatch.sources.rules import rules_from_dict

# Thresholds and per-table checks of the documented default configuration.
DEFAULT_CONFIG = {
    "data_quality": {
        "null_checks": {"max_null_rate_pct": 1.0},
        "duplicate_checks": {"max_duplicate_rate_pct": 0.5},
        "referential_integrity": {"fail_on_any_orphan": True},
        "freshness_checks": {"max_staleness_hours": 24},
        "schema_drift": {"fail_on_column_removed": True, "fail_on_type_changed": True, "warn_on_column_added": True},
        "tables": [
            {"name": "stg_customers", "key_columns": ["customer_id"],
             "null_check_columns": ["customer_id", "customer_city", "customer_state"], "freshness_check": True},
            {"name": "stg_orders", "key_columns": ["order_id"],
             "null_check_columns": ["order_id", "customer_id", "order_status"], "freshness_check": True},
            {"name": "stg_order_items", "key_columns": ["order_id", "order_item_id"],
             "null_check_columns": ["order_id", "product_id", "seller_id", "price"], "freshness_check": True},
            {"name": "stg_products", "key_columns": ["product_id"],
             "null_check_columns": ["product_id", "product_category_name", "product_weight_g"], "freshness_check": True},
            {"name": "stg_sellers", "key_columns": ["seller_id"],
             "null_check_columns": ["seller_id"], "freshness_check": True},
            {"name": "Fact_Order_Items", "key_columns": ["order_id", "order_item_id"],
             "null_check_columns": ["order_id", "product_id", "seller_id", "customer_id", "date_key"],
             "freshness_check": True,
             "referential_integrity": [
                 {"column": "customer_id", "parent_table": "Dim_Customer", "parent_column": "customer_id"},
                 {"column": "product_id", "parent_table": "Dim_Product", "parent_column": "product_id"},
                 {"column": "seller_id", "parent_table": "Dim_Seller", "parent_column": "seller_id"},
                 {"column": "date_key", "parent_table": "Dim_Date", "parent_column": "date_key"},
             ]},
        ],
    }
}

DEFAULT_RULES = rules_from_dict(DEFAULT_CONFIG)
