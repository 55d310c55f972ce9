"""Derived columns (F1-F9) on Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import mean_exact, pct_or_zero


def add_features(silver: DataFrame) -> DataFrame:
    """F1-F7, row-local (no shuffle)."""
    delay = F.col("days_for_shipping_real") - F.col("days_for_shipment_scheduled")
    return silver.withColumns({
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
        "order_quarter": F.quarter("order_date"),
        "order_month_name": F.date_format("order_date", "MMM"),
        "delivery_days_actual": F.col("days_for_shipping_real"),
        "delivery_delay_days": delay,
        # a NULL delay counts as not late
        "is_late": F.coalesce(delay > 0, F.lit(False)),
        # 0 when the divisor is 0, NULL stays NULL
        "profit_margin_pct": pct_or_zero(F.col("order_profit_per_order"), F.col("sales")),
        "discount_pct": pct_or_zero(F.col("order_item_discount"), F.col("order_item_product_price")),
        "revenue_per_item": F.when(F.col("order_item_quantity") == 0, F.lit(0.0))
                             .otherwise(mean_exact(F.col("sales"), F.col("order_item_quantity"))),
    })


def customer_metrics(df: DataFrame) -> DataFrame:
    """One row per customer: CLV (sum), AOV (mean), distinct orders, repeat flag.
    Rows without a customer form no customer.

    One ``groupBy`` (partial aggregation, one shuffle on customer_id); Spark has no
    DISTINCT window aggregate, so this is joined back where rows need it (J6).
    """
    return (df.filter(F.col("customer_id").isNotNull()).groupBy("customer_id")
            .agg(F.sum("sales").alias("_clv"), F.count("sales").alias("_n"),
                 F.count_distinct("order_id").alias("order_count"))
            .select("customer_id",
                    F.col("_clv").alias("customer_lifetime_value"),
                    F.try_divide(F.col("_clv").cast("double"), F.col("_n").cast("double")).alias("avg_order_value"),
                    "order_count",
                    (F.col("order_count") > 1).alias("is_repeat_customer")))


def with_customer_metrics(df: DataFrame) -> DataFrame:
    """Attach F8/F9 to every row (left join on customer_id)."""
    return df.join(customer_metrics(df), "customer_id", "left")
