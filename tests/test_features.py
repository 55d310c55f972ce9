"""Derived columns."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.features import add_features, customer_metrics


def _frame(spark):
    rows = [(3, 4, 100.0, 20.0, 100.0, 5.0, 1, 1, 101, dt.datetime(2018, 1, 31)),
            (5, 4, 200.0, 40.0, 200.0, 10.0, 2, 2, 102, dt.datetime(2018, 1, 13)),
            (None, 4, 0.0, None, 0.0, 1.0, 0, 2, 103, dt.datetime(2018, 2, 1))]
    schema = ("days_for_shipping_real long, days_for_shipment_scheduled long, sales double, "
              "order_profit_per_order double, order_item_product_price double, order_item_discount double, "
              "order_item_quantity long, customer_id long, order_id long, order_date timestamp")
    return spark.createDataFrame(rows, schema).withColumn("sales", F.col("sales").cast("decimal(18,2)"))


def test_is_late_correct_values(spark):
    got = [r["is_late"] for r in add_features(_frame(spark)).orderBy("order_id").collect()]
    assert got == [False, True, False]  # -1 late? no; +1 yes; NULL delay -> not late


def test_time_dimensions(spark):
    r = add_features(_frame(spark)).orderBy("order_id").first()
    assert (r["order_year"], r["order_month"], r["order_quarter"], r["order_month_name"]) == (2018, 1, 1, "Jan")


def test_margin_zero_and_null_rules(spark):
    rows = add_features(_frame(spark)).orderBy("order_id").collect()
    assert rows[0]["profit_margin_pct"] == 20.0
    assert rows[2]["profit_margin_pct"] == 0.0  # sales == 0 -> 0
    assert rows[2]["revenue_per_item"] == 0.0  # quantity == 0 -> 0


def test_clv_positive_and_repeat(spark):
    m = {r["customer_id"]: r for r in customer_metrics(add_features(_frame(spark))).collect()}
    assert float(m[1]["customer_lifetime_value"]) == 100.0
    assert m[2]["order_count"] == 2 and m[2]["is_repeat_customer"] is True
    assert all(float(r["customer_lifetime_value"]) >= 0 for r in m.values())


def test_rows_without_a_customer_form_no_customer(spark):
    df = add_features(_frame(spark)).withColumn("customer_id", F.when(F.col("order_id") != 101, F.col("customer_id")))
    assert [r["customer_id"] for r in customer_metrics(df).collect()] == [2]


def test_rounding_is_half_away_from_zero(spark):
    from tidemark.functions.numeric import mean_exact, pct, round2, round_ratio
    cases = [("-1", "8", -0.13), ("1", "8", 0.13), ("-0.25", "2", -0.13), ("2.01", "2", 1.01), ("-2.01", "2", -1.01), ("1", "3", 0.33),
             ("-2", "3", -0.67), ("0", "5", 0.0), ("5", "0", None), (None, "4", None), ("99999999999999999.99", "1", 99999999999999999.99)]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a string, b string")
    df = df.select(F.col("a").cast("decimal(28,2)").alias("a"), F.col("b").cast("decimal(28,2)").alias("b"))
    assert [r[0] for r in df.select(round_ratio(F.col("a"), F.col("b"))).collect()] == [w for _, _, w in cases]
    one = df.limit(1)
    lit = lambda x: F.lit(x).cast("decimal(18,2)")
    assert one.select(pct(lit("-0.01"), lit("8.00")), pct(lit("1"), lit("-800")), pct(lit("-1"), lit("8"), 1), mean_exact(lit("-0.05"), F.lit(10)),
                      round2(F.lit(-0.125)), round2(F.lit(0.125)), round2(F.lit(None).cast("double"))).first()[:] == (
        -0.13, -0.13, -12.5, -0.01, -0.13, 0.13, None)


def test_negative_ties_in_margins(spark):
    df = _frame(spark).limit(1).withColumns({"sales": F.lit(800).cast("decimal(18,2)"), "order_profit_per_order": F.lit(-1.0)})
    assert add_features(df).first()["profit_margin_pct"] == -0.13
