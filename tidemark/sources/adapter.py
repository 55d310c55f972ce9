"""Driver tables -> raw order items (the 53 text columns of the landing file).

The reference's CSV is not available; the TPC-H-ish tables are.  This adapter derives
one order-item row per lineitem with the same 53 header names, every field as TEXT,
so that the whole pipeline (validation, Bronze, Silver typing and cleaning, Gold)
runs on data that grows with the given tables.  The mappings are PROXIES with no
business meaning: they only give every column a plausible domain and exercise every
code path (duplicates, bad dates, null ids, negative prices, dirty whitespace,
unknown statuses, null names and zipcodes) with conditions on the data itself.

Numbers are written as text from DECIMAL or integer values only, so the text is the
same in Spark and in the SQL oracle.

Scale notes: lineitem, orders, customer, part and supplier all grow with the data and
are joined on their keys (sort-merge or AQE-converted broadcast, decided from real
sizes).  Only nation (25 rows) and region (5 rows) carry an explicit broadcast: their
size is fixed by the TPC-H definition, not by the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import RAW_COLUMNS, RAW_DATE_FORMAT
from tidemark.sources.driver_tables import read_table

MASKED = "XXXXXXXXX"


def _hundredths_text(h: Column) -> Column:
    """Integer hundredths -> '-12.05' style text (same in every engine)."""
    a = F.abs(h.cast("bigint"))
    frac = a % 100
    whole = ((a - frac) / 100).cast("bigint")
    return F.concat(F.when(h < 0, F.lit("-")).otherwise(F.lit("")),
                    whole.cast("string"), F.lit("."), F.lpad(frac.cast("string"), 2, "0"))


def _money_text(d: Column) -> Column:
    return d.cast("decimal(18,2)").cast("string")


# Values of lineitem that matter, as digits of ``_marks``: kind of payment, tax and discount.
DEBIT, CASH, PAYMENT, TRANSFER = range(4)
TAX_0, TAX_1, TAX_8 = 1, 2, 3
DISCOUNT_0, DISCOUNT_10 = 1, 2


def _marks() -> Column:
    flag, tax, discount = F.col("l_returnflag"), F.col("l_tax"), F.col("l_discount")
    kind = F.when(flag == "A", DEBIT).when(flag == "R", CASH).when(F.col("l_linestatus") == "O", PAYMENT).otherwise(TRANSFER)
    taxed = F.when(tax == 0.0, TAX_0).when(tax == 0.01, TAX_1).when(tax == 0.08, TAX_8).otherwise(0)
    cut = F.when(discount == 0.0, DISCOUNT_0).when(discount == 0.10, DISCOUNT_10).otherwise(0)
    return kind + 10 * taxed + 100 * cut


def order_items_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join the driver tables into one typed row per lineitem (before text)."""
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])
    # Shuffled as what is used of them: money as DECIMAL (cents), a day, and one number for the marked values.
    li = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("_qty"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("_sales"), F.col("l_discount").cast("decimal(4,2)").alias("_rate"),
        F.to_date("l_shipdate").alias("_ship_day"), _marks().alias("_marks"))
    o = read_table(spark, sf_dir, "orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", [
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    p = read_table(spark, sf_dir, "part", [
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    p = p.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", F.col("p_retailprice").cast("decimal(12,2)").alias("_price"))
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    # Lineitem meets part first, as narrow as it is read, and orders (which meet their customers before) last: two
    # shuffles of its rows, the second without the columns of orders and customers.  The last one is always a shuffle
    # (``merge``), which deals the rows to tasks also where the other joins are broadcasts.
    bought = (li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")
                .join(p, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey"))
    placed = o.join(c, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    j = bought.join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    # Fixed-size lookups (25 and 5 rows by definition): broadcast, after the shuffles, which move their keys only.
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
           .select(F.col("n_nationkey").alias("s_nk"), F.col("n_name").alias("s_nation"), F.col("r_name").alias("s_region")))
    home = nation.select(F.col("n_nationkey").alias("c_nk"), F.col("n_name").alias("c_nation"))
    return (j.join(F.broadcast(geo), F.col("s_nationkey") == F.col("s_nk")).drop("s_nk")
             .join(F.broadcast(home), F.col("c_nationkey") == F.col("c_nk")).drop("c_nk"))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """53 raw TEXT columns plus ``_row_number`` (the landing file's order)."""
    j = order_items_typed(spark, sf_dir)
    kind, tax, discount = F.col("_marks") % 10, (F.col("_marks") / 10).cast("int") % 10, (F.col("_marks") / 100).cast("int")
    prio = F.substring("o_orderpriority", 1, 1)
    sched = (F.when(prio == "1", 0).when(prio == "2", 1).when(prio == "3", 2).otherwise(4))
    mode = (F.when(prio == "1", "Same Day").when(prio == "2", "First Class")
            .when(prio == "3", "Second Class").otherwise("Standard Class"))
    real = F.abs(F.datediff(F.col("_ship_day"), F.to_date("o_orderdate"))) % 7
    j = j.withColumns({"_sched": sched.cast("bigint"), "_real": real.cast("bigint")})
    delay = F.col("_real") - F.col("_sched")
    cancelled = (F.col("o_orderstatus") == "P") & (kind == CASH)
    status = (F.when(cancelled & (tax == TAX_8), F.lit("shipping canceled "))
              .when(cancelled, F.lit("Shipping canceled"))
              .when(delay > 0, F.lit("Late delivery"))
              .when(delay == 0, F.lit("Shipping on time"))
              .otherwise(F.lit("Advance shipping")))
    order_ts = F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate"))
    ship_ts = F.timestamp_add("DAY", F.col("_real"), order_ts)
    order_text = (F.when((discount == DISCOUNT_10) & (tax == TAX_0), F.lit("31/31/2017 25:99"))
                  .otherwise(F.date_format(order_ts, RAW_DATE_FORMAT)))
    ship_text = (F.when((discount == DISCOUNT_0) & (tax == TAX_8), F.lit("not recorded"))
                 .otherwise(F.date_format(ship_ts, RAW_DATE_FORMAT)))

    qty, sales, rate, price = F.col("_qty"), F.col("_sales"), F.col("_rate"), F.col("_price")
    disc = (sales * rate).cast("decimal(12,2)")
    total = sales - disc
    benefit = (total - price * qty.cast("decimal(6,0)") * F.lit(1.25).cast("decimal(3,2)")).cast("decimal(12,2)")
    j = j.withColumns({"_disc": disc, "_total": total.cast("decimal(12,2)"), "_benefit": benefit})
    # Profit ratio in whole hundredths, integer division (truncates toward zero).
    ratio_h = F.expr("CASE WHEN _total = 0 THEN CAST(0 AS BIGINT) "
                     "ELSE (CAST(_benefit * 100 AS BIGINT) * 100) div CAST(_total * 100 AS BIGINT) END")

    brand_no = F.substring_index("p_brand", "#", -1)
    dept_id = F.ascii("p_type") * 100 + F.length("p_type")
    lat_h = (F.col("c_nationkey") * 7 - 80) * 100 + (F.col("o_custkey") % 3) * 7
    lon_h = (F.col("c_nationkey") * 13 - 160) * 100 - (F.col("o_custkey") % 3) * 11
    city = F.concat(F.lower("s_nation"), F.lit(" city-"), (F.col("l_suppkey") % 10).cast("string"))
    cust_id = F.when(F.col("c_acctbal") < -900, F.lit(None)).otherwise(F.col("o_custkey"))
    txt = lambda c: c.cast("string")

    cols = {
        "Type": F.when(kind == DEBIT, "DEBIT").when(kind == CASH, "CASH").when(kind == PAYMENT, "PAYMENT").otherwise("TRANSFER"),
        "Days for shipping (real)": txt(F.col("_real")),
        "Days for shipment (scheduled)": txt(F.col("_sched")),
        "Benefit per order": _money_text(F.col("_benefit")),
        "Sales per customer": _money_text(F.col("_total")),
        "Delivery Status": status,
        "Late_delivery_risk": F.when(delay > 0, "1").otherwise("0"),
        "Category Id": brand_no,
        "Category Name": F.lower("p_brand"),
        "Customer City": F.concat(F.lit("town-"), txt(F.col("o_custkey") % 9), F.lit(" of "), F.lower("c_nation")),
        "Customer Country": F.col("c_nation"),
        "Customer Email": F.lit(MASKED),
        "Customer Fname": F.substring_index("c_name", "#", 1),
        "Customer Id": txt(cust_id),
        "Customer Lname": F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.substring_index("c_name", "#", -1)),
        "Customer Password": F.lit(MASKED),
        "Customer Segment": F.col("c_mktsegment"),
        "Customer State": F.concat(F.lit("ST"), txt(F.col("c_nationkey"))),
        "Customer Street": F.concat(txt(F.col("o_custkey")), F.lit(" main street")),
        "Customer Zipcode": F.when(F.col("c_acctbal") > 9000, F.lit(None)).otherwise(txt(F.col("o_custkey") % 99999)),
        "Department Id": txt(dept_id),
        "Department Name": F.col("p_type"),
        "Latitude": _hundredths_text(lat_h),
        "Longitude": _hundredths_text(lon_h),
        "Market": F.col("s_region"),
        "Order City": F.when(tax == TAX_1, F.concat(city, F.lit("\t "))).otherwise(city),
        "Order Country": F.col("s_nation"),
        "Order Customer Id": txt(F.col("o_custkey")),
        "order date (DateOrders)": order_text,
        "Order Id": txt(F.col("l_orderkey")),
        "Order Item Cardprod Id": txt(F.col("l_partkey")),
        "Order Item Discount": _money_text(F.col("_disc")),
        "Order Item Discount Rate": txt(rate),
        "Order Item Id": txt(F.col("l_orderkey") * 10 + F.col("l_linenumber")),
        "Order Item Product Price": _money_text(F.col("_price")),
        "Order Item Profit Ratio": _hundredths_text(ratio_h),
        "Order Item Quantity": txt(F.col("_qty")),
        "Sales": _money_text(F.col("_sales")),
        "Order Item Total": _money_text(F.col("_total")),
        "Order Profit Per Order": _money_text(F.col("_benefit")),
        "Order Region": F.concat(F.when(F.col("s_nationkey") % 2 == 0, F.lit("north ")).otherwise(F.lit("south ")),
                                 F.lower("s_region")),
        "Order State": F.concat(F.lit("province "), txt(F.col("l_suppkey") % 3)),
        "Order Status": (F.when(F.col("o_orderstatus") == "F", "COMPLETE")
                         .when(F.col("o_orderstatus") == "O", "PENDING").otherwise("PROCESSING")),
        "Order Zipcode": F.lit(None).cast("string"),
        "Product Card Id": txt(F.col("l_partkey")),
        "Product Category Id": brand_no,
        "Product Description": F.lit(None).cast("string"),
        "Product Image": F.concat(F.lit("https://images.example/"), txt(F.col("l_partkey")), F.lit(".jpg")),
        "Product Name": F.col("p_name"),
        "Product Price": F.when(F.col("p_size") == 50, F.concat(F.lit("-"), _money_text(F.col("_price"))))
                          .otherwise(_money_text(F.col("_price"))),
        "Product Status": F.lit("0"),
        "shipping date (DateOrders)": ship_text,
        "Shipping Mode": mode,
    }
    assert list(cols) == RAW_COLUMNS
    out = [cols[name].cast("string").alias(name) for name in RAW_COLUMNS]
    # Landing order: by part, then supplier, so the copies of an order item lie apart in
    # the file; rows at one place are told apart by their content.
    out.append((F.col("l_partkey") * 1000 + F.col("l_suppkey") % 1000).alias("_row_number"))
    return j.select(*out)
