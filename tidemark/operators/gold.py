"""Gold KPI tables A1-A6 over the featured Silver frame.

Conventions (see README): NULL group keys are dropped (pandas ``groupby``); money
sums are exact DECIMAL sums emitted as DOUBLE; means are exact sum / count rounded
half away from zero to 2 dp; distinct counts are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import as_money, mean_exact, pct, round2


def _keys_not_null(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def _money_sum(c: str, alias: str):
    # pandas: sum over an all-NULL group is 0
    return F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(alias)


def _mean(c: str, alias: str, money: bool = True):
    """Exact mean of a DECIMAL (or whole-number) column, rounded to 2 dp."""
    return mean_exact(F.sum(c), F.count(c)).alias(alias)


def _mean_rounded_pct(c: str, alias: str):
    """Mean of a per-row 2-dp percent: summed as DECIMAL so the sum is exact."""
    return mean_exact(F.sum(as_money(F.col(c))), F.count(c)).alias(alias)


def mom_growth(df: DataFrame, value: str, order: list[str], alias: str) -> DataFrame:
    """Pct change of ``value`` along ``order`` (first row NULL, prev 0 -> NULL).

    The window has no partition key: its input is one row per month, bounded by
    the calendar, not by the data volume.
    """
    now = as_money(F.col(value), 28)
    prev = as_money(F.lag(value).over(Window.orderBy(*order)), 28)
    return df.withColumn(alias, pct(now - prev, prev))


def monthly_revenue(prep: DataFrame) -> DataFrame:
    """A1 gold_monthly_revenue."""
    keys = ["order_year", "order_month", "order_month_name"]
    m = (_keys_not_null(prep, keys).groupBy(*keys)
         .agg(_money_sum("sales", "total_revenue"),
              _money_sum("order_profit_per_order", "total_profit"),
              F.count_distinct("order_id").alias("total_orders"),
              F.count("order_item_id").alias("total_items"),
              _mean("sales", "avg_order_value")))
    return (mom_growth(m, "total_revenue", ["order_year", "order_month"], "mom_revenue_growth_pct")
            .orderBy("order_year", "order_month"))


def market_performance(prep: DataFrame) -> DataFrame:
    """A2 gold_market_performance."""
    keys = ["market", "order_region", "order_country"]
    return (_keys_not_null(prep, keys).groupBy(*keys)
            .agg(_money_sum("sales", "total_revenue"),
                 _money_sum("order_profit_per_order", "total_profit"),
                 F.count_distinct("order_id").alias("total_orders"),
                 _mean_rounded_pct("profit_margin_pct", "avg_margin_pct"),
                 F.sum(F.col("is_late").cast("bigint")).alias("late_shipments"),
                 F.count("order_item_id").alias("total_shipments"))
            .withColumn("late_pct", pct(F.col("late_shipments"), F.col("total_shipments")))
            .orderBy(F.desc("total_revenue"), *keys))


def product_performance(prep: DataFrame) -> DataFrame:
    """A3 gold_product_performance."""
    keys = ["product_card_id", "product_name", "category_name", "department_name"]
    return (_keys_not_null(prep, keys).groupBy(*keys)
            .agg(_money_sum("sales", "total_revenue"),
                 F.coalesce(F.sum("order_item_quantity"), F.lit(0)).cast("bigint").alias("units_sold"),
                 _mean_rounded_pct("profit_margin_pct", "avg_margin_pct"),
                 _mean_rounded_pct("discount_pct", "avg_discount"),
                 F.count_distinct("order_id").alias("order_count"))
            .orderBy(F.desc("total_revenue"), "product_card_id"))


def customer_segments(prep: DataFrame) -> DataFrame:
    """A4 gold_customer_segments: per (customer, segment), then per segment.

    (customer_id, segment) is unique after the first level, so the distinct
    customer count per segment is a plain count.
    """
    keys = ["customer_id", "customer_segment"]
    cust = (_keys_not_null(prep, keys).groupBy(*keys)
            .agg(F.coalesce(F.sum("sales"), F.lit(0)).alias("clv"),
                 F.try_divide(F.sum("sales").cast("double"), F.count("sales").cast("double")).alias("aov"),
                 F.count_distinct("order_id").alias("order_count"))
            .withColumn("is_repeat", F.col("order_count") > 1))
    return (cust.groupBy("customer_segment")
            .agg(F.count("customer_id").alias("total_customers"),
                 mean_exact(F.sum("clv"), F.count("clv")).alias("avg_clv"),
                 round2(F.avg("aov")).alias("avg_aov"),
                 F.sum(F.col("is_repeat").cast("bigint")).alias("repeat_customers"),
                 F.sum("clv").cast("double").alias("total_revenue"))
            .withColumn("repeat_rate_pct", pct(F.col("repeat_customers"), F.col("total_customers")))
            .orderBy("customer_segment"))


def late_delivery_risk(prep: DataFrame) -> DataFrame:
    """A5 gold_late_delivery_risk."""
    keys = ["shipping_mode", "delivery_status"]
    return (_keys_not_null(prep, keys).groupBy(*keys)
            .agg(F.count("order_item_id").alias("total_shipments"),
                 F.sum(F.col("is_late").cast("bigint")).alias("late_shipments"),
                 _mean("delivery_delay_days", "avg_delay_days"),
                 _mean("sales", "avg_revenue"))
            .withColumn("late_pct", pct(F.col("late_shipments"), F.col("total_shipments")))
            .orderBy(F.desc("late_pct"), *keys))


def shipping_efficiency(prep: DataFrame) -> DataFrame:
    """A6 gold_shipping_efficiency."""
    return (_keys_not_null(prep, ["shipping_mode"]).groupBy("shipping_mode")
            .agg(_mean("days_for_shipping_real", "avg_actual_days"),
                 _mean("days_for_shipment_scheduled", "avg_scheduled_days"),
                 _mean("delivery_delay_days", "avg_delay"),
                 pct(F.sum(F.col("is_late").cast("bigint")), F.count("is_late")).alias("late_pct"),
                 F.count("order_item_id").alias("shipment_count"),
                 _mean("sales", "avg_revenue"))
            .orderBy("shipping_mode"))


GOLD_BUILDERS = {
    "gold_monthly_revenue": monthly_revenue,
    "gold_market_performance": market_performance,
    "gold_product_performance": product_performance,
    "gold_customer_segments": customer_segments,
    "gold_late_delivery_risk": late_delivery_risk,
    "gold_shipping_efficiency": shipping_efficiency,
}
