"""DuckDB-dialect SQL that rebuilds the pipeline from the driver tables.

This is the correctness oracle: an independent, set-based restatement of the adapter,
Bronze hash, Silver typing / dedup / cleaning / trim and the feature columns, written
as one CTE chain over the pre-registered views.  Every Spark query is compared to a
SELECT over these CTEs.  Nothing is imported from the code under test: names follow a
rule stated here, types and column groups are listed here.
"""

from __future__ import annotations

import re

# How Silver types the raw columns (all others stay text).
MONEY = ["Benefit per order", "Sales per customer", "Order Item Discount", "Order Item Product Price", "Sales",
         "Order Item Total", "Order Profit Per Order", "Product Price"]
FRACTION = ["Order Item Discount Rate", "Order Item Profit Ratio", "Customer Zipcode", "Order Zipcode", "Latitude", "Longitude"]
KEYS = ["Customer Id", "Order Id", "Order Item Id", "Product Card Id", "Category Id", "Department Id"]
WHOLE = KEYS + ["Days for shipping (real)", "Days for shipment (scheduled)", "Order Item Quantity", "Late_delivery_risk",
                "Order Customer Id", "Order Item Cardprod Id", "Product Category Id", "Product Status"]
# The 13 measures among them, and the text columns brought to title case.
MEASURES = ["Days for shipping (real)", "Days for shipment (scheduled)", "Benefit per order", "Sales per customer",
            "Order Item Discount", "Order Item Discount Rate", "Order Item Product Price", "Order Item Profit Ratio",
            "Order Item Quantity", "Sales", "Order Item Total", "Order Profit Per Order", "Product Price"]
TITLED = ["Customer City", "Customer Country", "Customer State", "Order City", "Order Country", "Order State", "Order Region",
          "Category Name", "Department Name", "Market", "Delivery Status", "Order Status", "Shipping Mode",
          "Customer Segment", "Product Name"]


def snake(header: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", header.lower()).strip("_")


def half_away(num: str, den: str, factor: int = 1, places: int = 2) -> str:
    """num * factor / den in whole numbers: quotient, and one more if the remainder is half the divisor."""
    n = f"(CAST(abs(CAST({num} AS DECIMAL(28,2))) * 100 AS HUGEINT) * {factor * 10 ** places})"
    d = f"CAST(abs(CAST({den} AS DECIMAL(28,2))) * 100 AS HUGEINT)"
    sign = f"(CASE WHEN ({num} < 0) <> ({den} < 0) THEN -1 ELSE 1 END)"
    return (f"(CASE WHEN {den} <> 0 THEN {sign} * CAST({n} // {d} + CASE WHEN 2 * ({n} % {d}) >= {d} THEN 1 ELSE 0 END AS DOUBLE)"
            f" / {10 ** places} END)")


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _hundredths(h: str) -> str:
    a = f"abs({h})"
    return (f"(CASE WHEN {h} < 0 THEN '-' ELSE '' END || CAST(({a} - {a} % 100) // 100 AS VARCHAR)"
            f" || '.' || lpad(CAST({a} % 100 AS VARCHAR), 2, '0'))")


def _money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


RAW_EXPR = {
    "Type": "CASE WHEN l_returnflag = 'A' THEN 'DEBIT' WHEN l_returnflag = 'R' THEN 'CASH' "
            "WHEN l_linestatus = 'O' THEN 'PAYMENT' ELSE 'TRANSFER' END",
    "Days for shipping (real)": "CAST(_real AS VARCHAR)",
    "Days for shipment (scheduled)": "CAST(_sched AS VARCHAR)",
    "Benefit per order": _money("_benefit"),
    "Sales per customer": _money("_total"),
    "Delivery Status": "CASE WHEN _cancel AND l_tax = 0.08 THEN 'shipping canceled ' "
                       "WHEN _cancel THEN 'Shipping canceled' "
                       "WHEN _real - _sched > 0 THEN 'Late delivery' "
                       "WHEN _real - _sched = 0 THEN 'Shipping on time' ELSE 'Advance shipping' END",
    "Late_delivery_risk": "CASE WHEN _real - _sched > 0 THEN '1' ELSE '0' END",
    "Category Id": "split_part(p_brand, '#', 2)",
    "Category Name": "lower(p_brand)",
    "Customer City": "'town-' || CAST(c_custkey % 9 AS VARCHAR) || ' of ' || lower(c_nation)",
    "Customer Country": "c_nation",
    "Customer Email": "'XXXXXXXXX'",
    "Customer Fname": "split_part(c_name, '#', 1)",
    "Customer Id": "CASE WHEN c_acctbal < -900 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END",
    "Customer Lname": "CASE WHEN c_acctbal < 0 THEN NULL ELSE split_part(c_name, '#', 2) END",
    "Customer Password": "'XXXXXXXXX'",
    "Customer Segment": "c_mktsegment",
    "Customer State": "'ST' || CAST(c_nationkey AS VARCHAR)",
    "Customer Street": "CAST(c_custkey AS VARCHAR) || ' main street'",
    "Customer Zipcode": "CASE WHEN c_acctbal > 9000 THEN NULL ELSE CAST(c_custkey % 99999 AS VARCHAR) END",
    "Department Id": "CAST(ascii(p_type) * 100 + length(p_type) AS VARCHAR)",
    "Department Name": "p_type",
    "Latitude": _hundredths("((c_nationkey * 7 - 80) * 100 + (c_custkey % 3) * 7)"),
    "Longitude": _hundredths("((c_nationkey * 13 - 160) * 100 - (c_custkey % 3) * 11)"),
    "Market": "s_region",
    "Order City": "CASE WHEN l_tax = 0.01 THEN _city || chr(9) || ' ' ELSE _city END",
    "Order Country": "s_nation",
    "Order Customer Id": "CAST(o_custkey AS VARCHAR)",
    "order date (DateOrders)": "CASE WHEN l_discount = 0.10 AND l_tax = 0.0 THEN '31/31/2017 25:99' "
                               "ELSE strftime(_ots, '%-m/%-d/%Y %-H:%M') END",
    "Order Id": "CAST(l_orderkey AS VARCHAR)",
    "Order Item Cardprod Id": "CAST(l_partkey AS VARCHAR)",
    "Order Item Discount": _money("_disc"),
    "Order Item Discount Rate": "CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR)",
    "Order Item Id": "CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)",
    "Order Item Product Price": _money("_price"),
    "Order Item Profit Ratio": _hundredths(
        "(CASE WHEN _total = 0 THEN 0 ELSE (CAST(_benefit * 100 AS BIGINT) * 100) // CAST(_total * 100 AS BIGINT) END)"),
    "Order Item Quantity": "CAST(_qty AS VARCHAR)",
    "Sales": _money("_sales"),
    "Order Item Total": _money("_total"),
    "Order Profit Per Order": _money("_benefit"),
    "Order Region": "CASE WHEN s_nationkey % 2 = 0 THEN 'north ' ELSE 'south ' END || lower(s_region)",
    "Order State": "'province ' || CAST(l_suppkey % 3 AS VARCHAR)",
    "Order Status": "CASE WHEN o_orderstatus = 'F' THEN 'COMPLETE' WHEN o_orderstatus = 'O' THEN 'PENDING' "
                    "ELSE 'PROCESSING' END",
    "Order Zipcode": "CAST(NULL AS VARCHAR)",
    "Product Card Id": "CAST(l_partkey AS VARCHAR)",
    "Product Category Id": "split_part(p_brand, '#', 2)",
    "Product Description": "CAST(NULL AS VARCHAR)",
    "Product Image": "'https://images.example/' || CAST(p_partkey AS VARCHAR) || '.jpg'",
    "Product Name": "p_name",
    "Product Price": f"CASE WHEN p_size = 50 THEN '-' || {_money('_price')} ELSE {_money('_price')} END",
    "Product Status": "'0'",
    "shipping date (DateOrders)": "CASE WHEN l_discount = 0.0 AND l_tax = 0.08 THEN 'not recorded' "
                                  "ELSE strftime(_ots + to_days(CAST(_real AS INTEGER)), '%-m/%-d/%Y %-H:%M') END",
    "Shipping Mode": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Same Day' WHEN '2' THEN 'First Class' "
                     "WHEN '3' THEN 'Second Class' ELSE 'Standard Class' END",
}
RAW_COLUMNS = list(RAW_EXPR)


def _title(x: str) -> str:
    return ("array_to_string(list_transform(range(1, length(" + x + ") + 1), lambda i: "
            "CASE WHEN i = 1 OR NOT regexp_matches(substring(" + x + ", i - 1, 1), '\\p{L}') "
            "THEN upper(substring(" + x + ", i, 1)) ELSE lower(substring(" + x + ", i, 1)) END), '')")


def _typed_expr(raw: str) -> str:
    if raw in MONEY:
        return f"TRY_CAST({qi(raw)} AS DECIMAL(18,2))"
    if raw in FRACTION:
        return f"TRY_CAST({qi(raw)} AS DOUBLE)"
    if raw in WHOLE:
        return f"TRY_CAST(TRY_CAST({qi(raw)} AS DOUBLE) AS BIGINT)"
    return qi(raw)


SILVER_DROPPED = {"Customer Password", "Product Description", "Product Image", "Customer Email",
                  "Customer Street", "order date (DateOrders)", "shipping date (DateOrders)"}


def _build_prefix(source: str = "bronze", ingest: str = "1", more: str = "") -> str:
    """The CTE chain; source: what Silver reads, ingest: the number of a row's ingest, more: CTEs before Silver."""
    raw_sel = ",\n    ".join(f"{RAW_EXPR[c]} AS {qi(c)}" for c in RAW_COLUMNS)
    hash_parts = ", ".join(f"coalesce({qi(c)}, 'nan')" for c in RAW_COLUMNS)
    kept = [c for c in RAW_COLUMNS if c not in SILVER_DROPPED]
    typed_sel = ",\n    ".join(f"{_typed_expr(c)} AS {snake(c)}" for c in kept)
    strip_cols = {snake(c) for c in TITLED}
    strip_sel = ", ".join(f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g') AS {s}" for s in sorted(strip_cols))
    title_sel = ", ".join(f"{_title(s)} AS {s}" for s in sorted(strip_cols))
    return f"""
geo AS (
  SELECT n_nationkey AS g_nk, n_name AS g_name, r_name AS g_region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
j0 AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, l_shipdate, o_orderkey, o_custkey, o_orderstatus, o_orderdate,
         o_orderpriority, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, cn.n_name AS c_nation,
         p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, s_suppkey, s_nationkey,
         sg.g_name AS s_nation, sg.g_region AS s_region
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN geo sg ON s_nationkey = sg.g_nk),
j1 AS (
  SELECT *,
    CAST(CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 0 WHEN '2' THEN 1 WHEN '3' THEN 2 ELSE 4 END AS BIGINT) AS _sched,
    CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 7 AS BIGINT) AS _real,
    (o_orderstatus = 'P' AND l_returnflag = 'R') AS _cancel,
    CAST(l_quantity AS BIGINT) AS _qty,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS _sales,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS _disc,
    CAST(p_retailprice AS DECIMAL(12,2)) AS _price,
    o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS _ots,
    lower(s_nation) || ' city-' || CAST(l_suppkey % 10 AS VARCHAR) AS _city
  FROM j0),
j2 AS (SELECT *, CAST(_sales - _disc AS DECIMAL(12,2)) AS _total FROM j1),
j3 AS (
  SELECT *, CAST(_total - _price * CAST(_qty AS DECIMAL(6,0)) * CAST(1.25 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS _benefit
  FROM j2),
raw AS (
  SELECT
    {raw_sel},
    l_partkey * 1000 + l_suppkey % 1000 AS _row_number
  FROM j3),
bronze AS (
  SELECT *, left(_row_digest, 16) AS _row_hash
  FROM (SELECT *, sha256(concat_ws('|', {hash_parts})) AS _row_digest FROM raw)),{more}
typed AS (
  SELECT
    {typed_sel},
    try_strptime("order date (DateOrders)", '%m/%d/%Y %H:%M') AS order_date,
    try_strptime("shipping date (DateOrders)", '%m/%d/%Y %H:%M') AS ship_date,
    _row_number, _row_hash, _row_digest, {ingest} AS _ingest
  FROM {source}),
dedup AS (
  SELECT * FROM typed WHERE order_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY _ingest, _row_number, _row_digest) = 1),
filled AS (
  SELECT * REPLACE (coalesce(customer_lname, 'Unknown') AS customer_lname,
                    coalesce(customer_zipcode, 0.0) AS customer_zipcode,
                    coalesce(order_zipcode, 0.0) AS order_zipcode)
  FROM dedup),
stripped AS (SELECT * REPLACE ({strip_sel}) FROM filled),
titled AS (SELECT * REPLACE ({title_sel}) FROM stripped),
bounds AS (
  SELECT quantile_cont(CAST(sales AS DOUBLE), 0.01) AS _lo, quantile_cont(CAST(sales AS DOUBLE), 0.99) AS _hi
  FROM titled),
silver AS (
  SELECT titled.*, TRUE AS _silver_processed FROM titled, bounds
  WHERE CAST(sales AS DOUBLE) >= _lo AND CAST(sales AS DOUBLE) <= _hi),
prep AS (
  SELECT *,
    CAST(year(order_date) AS INTEGER) AS order_year,
    CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(quarter(order_date) AS INTEGER) AS order_quarter,
    strftime(order_date, '%b') AS order_month_name,
    days_for_shipping_real AS delivery_days_actual,
    days_for_shipping_real - days_for_shipment_scheduled AS delivery_delay_days,
    coalesce(days_for_shipping_real - days_for_shipment_scheduled > 0, FALSE) AS is_late,
    CASE WHEN sales = 0 THEN 0.0
         ELSE {half_away('order_profit_per_order', 'sales', 100)} END
      AS profit_margin_pct,
    CASE WHEN order_item_product_price = 0 THEN 0.0
         ELSE {half_away('order_item_discount', 'order_item_product_price', 100)} END
      AS discount_pct,
    CASE WHEN order_item_quantity = 0 THEN 0.0
         ELSE {half_away('sales', 'order_item_quantity')} END
      AS revenue_per_item
  FROM silver)"""


PREFIX = _build_prefix()
# two ingests: the first without the debit payments, the second of all rows, changed and at earlier places
RERUN_PREFIX = _build_prefix("two", "_n", """
two AS (
  SELECT *, 1 AS _n FROM bronze WHERE "Type" <> 'DEBIT'
  UNION ALL
  SELECT * REPLACE (_row_number - 1000000000000 AS _row_number, "Order Status" || ' again' AS "Order Status"), 2 FROM bronze),""")


def with_prefix(*ctes_and_select: str, prefix: str = PREFIX) -> str:
    """``WITH <pipeline CTEs>, <extra CTEs...> <final SELECT>``."""
    *extra, final = ctes_and_select
    body = prefix
    for e in extra:
        body += ",\n" + e
    final = final.strip()
    if final[:4].upper() == "WITH":  # merge the statement's own CTE list
        return "WITH " + body.strip() + ",\n" + final[4:].strip()
    return "WITH " + body.strip() + "\n" + final
