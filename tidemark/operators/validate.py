"""Data-quality report over the raw text rows (V1-V9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import pct
from tidemark.schemas import RAW_COLUMNS, RAW_DATE_FORMAT, VALID_DELIVERY_STATUSES


def q(name: str):
    return F.col(f"`{name}`")


CHECKS = ["missing_values", "duplicates", "negative_price", "negative_sales", "invalid_date",
          "null_customer_id", "unknown_delivery_status"]


def issue_report(raw: DataFrame, checks: list[str] | None = None) -> DataFrame:
    """V1-V8: rows ``(check, column, count, pct)`` of the asked checks (default: all).

    One ``agg`` computes every counter in a single scan and reduces to one row per task;
    the result row is then unpivoted.  The distinct count of the duplicates check is a
    scalar aggregate of its own, over one column.  Null rules kept from the reference: a
    NULL price / sale is not negative; a NULL date is invalid; a NULL delivery status is
    unknown; NULL ids count as one value for duplicates.  Only V1 carries a percentage.
    """
    checks = CHECKS if checks is None else checks
    item = q("Order Item Id")
    bad_date = lambda c: F.try_to_timestamp(q(c), F.lit(RAW_DATE_FORMAT)).isNull()
    unknown = ~F.coalesce(q("Delivery Status").isin(VALID_DELIVERY_STATUSES), F.lit(False))
    counters = [("missing_values", c, F.count_if(q(c).isNull())) for c in RAW_COLUMNS if c in raw.columns]
    counters += [
        ("duplicates", "Order Item Id", F.count(F.lit(1)) - F.max(item.isNull().cast("int"))),
        ("negative_price", "Product Price", F.count_if(q("Product Price").try_cast("double") < 0)),
        ("negative_sales", "Sales", F.count_if(q("Sales").try_cast("double") < 0)),
        ("invalid_date", "order date (DateOrders)", F.count_if(bad_date("order date (DateOrders)"))),
        ("invalid_date", "shipping date (DateOrders)", F.count_if(bad_date("shipping date (DateOrders)"))),
        ("null_customer_id", "Customer Id", F.count_if(q("Customer Id").isNull())),
        ("unknown_delivery_status", "Delivery Status", F.count_if(unknown)),
    ]
    asked = [(check, column, counter, f"c{i}") for i, (check, column, counter) in enumerate(counters) if check in checks]
    one = raw.agg(F.count(F.lit(1)).alias("n"), *[counter.alias(name) for _, _, counter, name in asked])

    def row(check, column, name):
        n = F.col(name).cast("bigint")
        if check == "duplicates":
            n = n - raw.agg(F.count_distinct(item)).scalar()
        return F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), n.alias("count"))

    missing = F.col("check") == "missing_values"
    return (one.select("n", F.inline(F.array(*[row(check, column, name) for check, column, _, name in asked])))
            .filter(~missing | (F.col("count") > 0))
            .select("check", "column", "count", F.when(missing, pct(F.col("count"), F.col("n"))).otherwise(0.0).alias("pct")))


def total_issues(report: DataFrame) -> DataFrame:
    """V9: sum of all counts (a NULL is counted by V1 and again by V5/V6/V7)."""
    return report.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("total_issues"))
