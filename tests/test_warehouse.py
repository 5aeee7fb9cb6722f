import tempfile

from pyspark.sql import functions as F

from tablewatch.operators.runlog import RunLog, current_runs, read_events
from tablewatch.plans import staging as S
from tablewatch.plans.warehouse import build_warehouse, run_metrics, warehouse_tables
from tablewatch.sources.catalog import table_inventory, write_table
from tablewatch.sources.files import read_csv

CUSTOMERS = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n" \
            "c1,u1,01234,  Sao Paulo ,SP \nc1,u1,01234,sao paulo,SP\nc2,u2,20000,RIO,RJ\n"
ORDERS = "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at," \
         "order_delivered_customer_date,order_estimated_delivery_date\n" \
         "o1,c1,delivered,2024-01-05 10:00:00,,,2024-01-10 00:00:00\n" \
         "o2,c2,shipped,,,,\no3,c2,created,not a time,,,\n"
ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n" \
        "o1,1,p1,s1,2024-01-06 00:00:00,10.50,1.00\no1,2,p2,s1,2024-01-06 00:00:00,abc,2.00\n" \
        "o2,1,p1,s2,2024-01-07 00:00:00,5.00,1.00\nmissing,1,p1,s1,2024-01-07 00:00:00,1.00,1.00\n"
PRODUCTS = "product_id,product_category_name,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n" \
           "p1,toys,100,1,2,3\np2,,200,4,5,6\np1,toys,100,1,2,3\n"
SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01000, Campinas ,SP\ns2,02000,curitiba, PR\n"

SCHEMAS = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
                 "customer_state string",
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
              "order_approved_at string, order_delivered_customer_date string, order_estimated_delivery_date string",
    "items": "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, "
             "price string, freight_value string",
    "products": "product_id string, product_category_name string, product_weight_g int, product_length_cm int, "
                "product_height_cm int, product_width_cm int",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
}


def test_csv_to_star_schema_with_run_log(spark):
    d = tempfile.mkdtemp(prefix="tw-raw-")
    for name, text in (("customers", CUSTOMERS), ("orders", ORDERS), ("items", ITEMS), ("products", PRODUCTS),
                       ("sellers", SELLERS)):
        with open(f"{d}/{name}.csv", "w") as fh:
            fh.write(text)
    raw = {n: read_csv(spark, f"{d}/{n}.csv", SCHEMAS[n]) for n in SCHEMAS}
    stg = {
        "stg_customers": S.stage_customers(raw["customers"]),
        "stg_orders": S.stage_orders(raw["orders"]),
        "stg_order_items": S.stage_order_items(raw["items"]),
        "stg_products": S.stage_products(raw["products"]),
        "stg_sellers": S.stage_sellers(raw["sellers"]),
    }
    c = {r["customer_id"]: r for r in stg["stg_customers"].collect()}
    assert c["c1"]["customer_city"] == "sao paulo" and c["c1"]["customer_zip_code_prefix"] == "01234"
    assert stg["stg_order_items"].where(F.col("price").isNull()).count() == 1
    assert stg["stg_products"].count() == 2
    log = RunLog(spark, tempfile.mkdtemp(prefix="tw-runs-") + "/runs", "build_warehouse")
    with log.run(run_id=1) as run:
        tables = build_warehouse(stg, lambda name, df: write_table(df, name), run_log=run)
    cur = current_runs(read_events(spark, log.path)).first()
    inv = {r["table_name"]: r["row_count"] for r in table_inventory(spark, list(tables)).collect()}
    assert inv == {"Dim_Customer": 2, "Dim_Product": 2, "Dim_Seller": 2, "Dim_Date": 1, "Fact_Order_Items": 3}
    assert cur["status"] == "success" and cur["rows_written"] == sum(inv.values())
    assert cur["rows_read"] == sum(df.count() for df in stg.values())
    fact = {(r["order_id"], r["order_item_id"]): r for r in spark.read.table("Fact_Order_Items").collect()}
    assert fact[("o1", 1)]["date_key"] == 20240105 and fact[("o2", 1)]["date_key"] is None
    m = {(r["direction"], r["table_name"]): r["row_count"] for r in run_metrics(stg, warehouse_tables(stg)).collect()}
    assert m[("written", "*")] == 10 and m[("read", "stg_order_items")] == 4
