"""Column names and types of the raw, Silver and star tables.

Fixed values: the 53 raw header names, the Silver column groups, the raw -> snake
rename map, the star DDL, the delivery-status domain and the KPI targets must equal
the reference's for the same results, so they are stated here as plain text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: raw header, in file order --------------------------------------
RAW_COLUMNS = [
    "Type",
    "Days for shipping (real)",
    "Days for shipment (scheduled)",
    "Benefit per order",
    "Sales per customer",
    "Delivery Status",
    "Late_delivery_risk",
    "Category Id",
    "Category Name",
    "Customer City",
    "Customer Country",
    "Customer Email",
    "Customer Fname",
    "Customer Id",
    "Customer Lname",
    "Customer Password",
    "Customer Segment",
    "Customer State",
    "Customer Street",
    "Customer Zipcode",
    "Department Id",
    "Department Name",
    "Latitude",
    "Longitude",
    "Market",
    "Order City",
    "Order Country",
    "Order Customer Id",
    "order date (DateOrders)",
    "Order Id",
    "Order Item Cardprod Id",
    "Order Item Discount",
    "Order Item Discount Rate",
    "Order Item Id",
    "Order Item Product Price",
    "Order Item Profit Ratio",
    "Order Item Quantity",
    "Sales",
    "Order Item Total",
    "Order Profit Per Order",
    "Order Region",
    "Order State",
    "Order Status",
    "Order Zipcode",
    "Product Card Id",
    "Product Category Id",
    "Product Description",
    "Product Image",
    "Product Name",
    "Product Price",
    "Product Status",
    "shipping date (DateOrders)",
    "Shipping Mode",
]

# Every raw field is read as text; typing happens in Silver with try_cast.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Bronze lineage columns (added at ingest).
LINEAGE_COLUMNS = ["_ingestion_ts", "_source_file", "_row_number", "_row_hash"]
# Of our own: the file split a row was read from, the digest of its content (16 bytes; _row_hash is its first half in hex), and an
# id of the stored row within its ingest.
ROW_COLUMNS = ["_file_block", "_row_digest", "_row_uid"]

# ---- fixed values: Silver column groups --------------------------------------------
# Dropped at Silver: the reference drops password, description, image; we also drop
# the two remaining PII fields (e-mail, street).
SILVER_DROP = ["Customer Password", "Product Description", "Product Image",
               "Customer Email", "Customer Street"]

DATE_COLUMNS = {
    "order date (DateOrders)": "order_date",
    "shipping date (DateOrders)": "ship_date",
}
RAW_DATE_FORMAT = "M/d/yyyy H:mm"

STRING_COLUMNS = [
    "Customer City", "Customer Country", "Customer State",
    "Order City", "Order Country", "Order State", "Order Region",
    "Category Name", "Department Name", "Market",
    "Delivery Status", "Order Status", "Shipping Mode",
    "Customer Segment", "Product Name",
]

ID_COLUMNS = ["Customer Id", "Order Id", "Order Item Id",
              "Product Card Id", "Category Id", "Department Id"]

# How each numeric column is held in Silver.  Money is DECIMAL so that sums are exact
# and independent of the order of addition across partitions; counts of days and
# units are whole numbers; the two ratios stay DOUBLE.
MONEY = T.DecimalType(18, 2)
NUMERIC_TYPES = {
    "Days for shipping (real)": "bigint",
    "Days for shipment (scheduled)": "bigint",
    "Benefit per order": "money",
    "Sales per customer": "money",
    "Order Item Discount": "money",
    "Order Item Discount Rate": "double",
    "Order Item Product Price": "money",
    "Order Item Profit Ratio": "double",
    "Order Item Quantity": "bigint",
    "Sales": "money",
    "Order Item Total": "money",
    "Order Profit Per Order": "money",
    "Product Price": "money",
}
# Other raw text columns that hold numbers.
OTHER_NUMERIC = {
    "Late_delivery_risk": "bigint",
    "Customer Zipcode": "double",
    "Order Zipcode": "double",
    "Latitude": "double",
    "Longitude": "double",
    "Order Customer Id": "bigint",
    "Order Item Cardprod Id": "bigint",
    "Product Category Id": "bigint",
    "Product Status": "bigint",
}

NULL_FILLS = {"Customer Lname": "Unknown", "Customer Zipcode": 0.0, "Order Zipcode": 0.0}

SALES_TRIM_BAND = (0.01, 0.99)

# ---- fixed values: raw -> snake rename map (Gold naming) --------------------------
RENAME_MAP = {
    "Order Item Id": "order_item_id",
    "Order Id": "order_id",
    "Customer Id": "customer_id",
    "Product Card Id": "product_card_id",
    "Category Name": "category_name",
    "Department Name": "department_name",
    "Product Name": "product_name",
    "Product Price": "product_price",
    "Market": "market",
    "Order Region": "order_region",
    "Order Country": "order_country",
    "Order City": "order_city",
    "Order State": "order_state",
    "Delivery Status": "delivery_status",
    "Shipping Mode": "shipping_mode",
    "Customer Segment": "customer_segment",
    "Sales": "sales",
    "Order Profit Per Order": "order_profit_per_order",
    "Benefit per order": "benefit_per_order",
    "Order Item Quantity": "order_item_quantity",
    "Order Item Discount": "order_item_discount",
    "Order Item Product Price": "order_item_product_price",
    "Days for shipping (real)": "days_for_shipping_real",
    "Days for shipment (scheduled)": "days_for_shipment_scheduled",
    "Late_delivery_risk": "late_delivery_risk",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Category Id": "category_id",
    "Department Id": "department_id",
    "Product Status": "product_status",
    "Order Status": "order_status",
    "Type": "type",
    "Customer Fname": "customer_fname",
    "Customer Lname": "customer_lname",
    "Customer City": "customer_city",
    "Customer State": "customer_state",
    "Customer Country": "customer_country",
    "Customer Zipcode": "customer_zipcode",
    "Order Zipcode": "order_zipcode",
    "Order Item Total": "order_item_total",
}

# ---- fixed values: validation domain and KPI targets ------------------------------
VALID_DELIVERY_STATUSES = [
    "Advance shipping",
    "Late delivery",
    "Shipping on time",
    "Shipping canceled",
]

KPI_TARGETS = {
    "late_pct": 30.0,
    "profit_margin": 15.0,
    "avg_order_value": 500.0,
    "repeat_rate": 60.0,
}

# ---- fixed values: star schema DDL types (keys and counts 64 bits wide, so that they hold at any size) ------------------------------------------
STAR_DDL = {
    "dim_customer": [
        ("customer_id", "bigint"), ("customer_fname", "string"), ("customer_lname", "string"),
        ("customer_segment", "string"), ("customer_city", "string"), ("customer_state", "string"),
        ("customer_country", "string"), ("customer_zipcode", "string"),
        ("customer_lifetime_value", "decimal(12,2)"), ("avg_order_value", "decimal(12,2)"),
        ("order_count", "bigint"), ("is_repeat_customer", "boolean"),
    ],
    "dim_product": [
        ("product_card_id", "bigint"), ("product_name", "string"), ("product_price", "decimal(10,2)"),
        ("category_id", "bigint"), ("category_name", "string"), ("department_id", "bigint"),
        ("department_name", "string"), ("product_status", "int"),
    ],
    "dim_date": [
        ("date_id", "bigint"), ("full_date", "date"), ("year", "int"), ("quarter", "int"),
        ("month", "int"), ("month_name", "string"), ("day", "int"), ("day_of_week", "string"),
        ("week_of_year", "int"),
    ],
    "dim_location": [
        ("location_id", "bigint"), ("order_city", "string"), ("order_state", "string"),
        ("order_country", "string"), ("order_region", "string"), ("market", "string"),
        ("latitude", "decimal(10,6)"), ("longitude", "decimal(10,6)"),
    ],
    "dim_shipping": [
        ("shipping_id", "bigint"), ("shipping_mode", "string"), ("delivery_status", "string"),
    ],
    "fact_sales": [
        ("order_item_id", "bigint"), ("order_id", "bigint"), ("customer_id", "bigint"),
        ("product_card_id", "bigint"), ("date_id", "bigint"), ("location_id", "bigint"),
        ("shipping_id", "bigint"), ("order_item_quantity", "bigint"), ("sales", "decimal(12,2)"),
        ("order_item_discount", "decimal(10,2)"), ("order_profit_per_order", "decimal(12,2)"),
        ("benefit_per_order", "decimal(12,2)"), ("order_item_product_price", "decimal(10,2)"),
        ("order_item_total", "decimal(12,2)"), ("delivery_days_actual", "int"),
        ("delivery_delay_days", "int"), ("is_late", "boolean"), ("profit_margin_pct", "decimal(8,2)"),
        ("discount_pct", "decimal(8,2)"), ("revenue_per_item", "decimal(10,2)"),
        ("order_status", "string"), ("type", "string"),
    ],
}
# Dimensions load before the fact (foreign keys point at them).
LOAD_ORDER = ["dim_customer", "dim_product", "dim_date", "dim_location", "dim_shipping", "fact_sales"]

# (fact column, dimension, dimension key) for the five foreign keys.
FOREIGN_KEYS = [
    ("customer_id", "dim_customer", "customer_id"),
    ("product_card_id", "dim_product", "product_card_id"),
    ("date_id", "dim_date", "date_id"),
    ("location_id", "dim_location", "location_id"),
    ("shipping_id", "dim_shipping", "shipping_id"),
]
PRIMARY_KEYS = {
    "dim_customer": "customer_id", "dim_product": "product_card_id", "dim_date": "date_id",
    "dim_location": "location_id", "dim_shipping": "shipping_id", "fact_sales": "order_item_id",
}
