"""Read-side analytics over the Gold tables: KPIs, roll-ups, top-k, anomalies, targets.

All inputs are small Gold aggregates or dimensions.  One-row figures are attached as
scalar subqueries (computed once, inlined as literals), never by a cross join.
Roll-ups of money add the rounded Gold values as DECIMAL, so the sum is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import mean_exact, nan_to_null, pct, round2
from tidemark.schemas import KPI_TARGETS

MONTHLY_TARGET = 1_000_000.0


def _dec(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def top_k(df: DataFrame, k: int, order: list[Column], position: bool = True) -> DataFrame:
    """``ORDER BY .. LIMIT k`` (plans as TakeOrderedAndProject: a per-partition
    top-k, then one merge of at most k rows per partition).  ``order`` must end in a
    unique tie-break.  ``position`` numbers the k rows (window over k rows only)."""
    top = df.orderBy(*order).limit(k)
    if not position:
        return top
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def kpi_summary(monthly: DataFrame, risk: DataFrame, customers: DataFrame) -> DataFrame:
    """One row of 7 KPIs; orders are the SUM of the monthly distinct counts."""
    n_customers = customers.agg(F.count(F.lit(1))).scalar()
    late = risk.agg(F.sum("late_shipments")).scalar()
    ships = risk.agg(F.sum("total_shipments")).scalar()
    m = monthly.agg(F.sum(_dec("total_revenue")).alias("rev"),
                    F.sum("total_orders").cast("bigint").alias("orders"),
                    F.sum(_dec("total_profit")).alias("profit"))
    return m.select(
        F.col("rev").cast("double").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        F.when(F.col("orders") > 0, mean_exact(F.col("rev"), F.col("orders"))).otherwise(0.0).alias("avg_order_value"),
        F.col("profit").cast("double").alias("total_profit"),
        n_customers.alias("total_customers"),
        F.when(ships > 0, pct(late, ships, 1)).otherwise(0.0).alias("late_pct"),
        F.when(F.col("rev") != 0, pct(F.col("profit"), F.col("rev"), 1)).otherwise(0.0)
         .alias("profit_margin"),
    )


def market_rollup(market_perf: DataFrame) -> DataFrame:
    """Per market; orders summed over countries (an order spanning countries
    counts once per country); late % is the UNWEIGHTED mean of the rounded rates."""
    return (market_perf.groupBy("market")
            .agg(F.sum(_dec("total_revenue")).cast("double").alias("total_revenue"),
                 F.sum("total_orders").cast("bigint").alias("total_orders"),
                 mean_exact(F.sum(_dec("late_pct")), F.count("late_pct")).alias("late_pct"))
            .orderBy(F.desc("total_revenue"), "market"))


def category_rollup(product_perf: DataFrame) -> DataFrame:
    """Per category; margin is the unweighted mean of the product margins."""
    return (product_perf.groupBy("category_name")
            .agg(F.sum(_dec("total_revenue")).cast("double").alias("total_revenue"),
                 F.sum("units_sold").cast("bigint").alias("units_sold"),
                 mean_exact(F.sum(_dec("avg_margin_pct")), F.count("avg_margin_pct")).alias("avg_margin_pct"))
            .orderBy(F.desc("total_revenue"), "category_name"))


def mode_risk_rollup(risk: DataFrame) -> DataFrame:
    """A28 (+W6): late rate per shipping mode, weighted by shipments, with its band."""
    out = (risk.groupBy("shipping_mode")
           .agg(F.sum("total_shipments").cast("bigint").alias("total"),
                F.sum("late_shipments").cast("bigint").alias("late")))
    out = out.withColumn("late_pct", pct(F.col("late"), F.col("total")))
    return out.withColumn("risk_band", risk_band(F.col("late_pct")))


def status_share(risk: DataFrame) -> DataFrame:
    """Shipments per delivery status and share of the grand total."""
    grand = risk.agg(F.sum("total_shipments")).scalar()
    return (risk.groupBy("delivery_status")
            .agg(F.sum("total_shipments").cast("bigint").alias("shipments"))
            .withColumn("share_pct", pct(F.col("shipments"), grand))
            .orderBy(F.desc("shipments"), "delivery_status"))


def segment_profile(segments: DataFrame) -> DataFrame:
    """Per segment CLV and AOV rounded to whole units (half up), repeat %."""
    return segments.select(F.col("customer_segment").alias("subject"),
                           F.floor(F.col("avg_clv") + 0.5).cast("bigint").alias("clv"),
                           F.floor(F.col("avg_aov") + 0.5).cast("bigint").alias("aov"),
                           F.col("repeat_rate_pct").alias("repeat"))


def anomalies(monthly: DataFrame, k: float = 1.8) -> DataFrame:
    """Months whose growth is more than k population std-devs from the mean
    (NULL growth excluded)."""
    g = monthly.filter(F.col("mom_revenue_growth_pct").isNotNull())
    mean = g.agg(F.avg("mom_revenue_growth_pct")).scalar()
    std = g.agg(F.stddev_pop("mom_revenue_growth_pct")).scalar()
    return (g.filter(F.abs(F.col("mom_revenue_growth_pct") - mean) > std * k)
            .select(F.concat_ws(" ", "order_month_name", F.col("order_year").cast("string")).alias("period"),
                    "order_year", "order_month", "total_revenue", "mom_revenue_growth_pct")
            .orderBy("order_year", "order_month"))


def risk_band(late_pct: Column) -> Column:
    """> 50 bad, > 30 warn, else ok."""
    return F.when(late_pct > 50, "bad").when(late_pct > 30, "warn").otherwise("ok")


def shipping_risk_bands(efficiency: DataFrame) -> DataFrame:
    """W6 over A6."""
    return efficiency.select("shipping_mode", "late_pct", risk_band(F.col("late_pct")).alias("risk_band"))


def kpi_vs_target(kpis: DataFrame, repeat_rate: Column) -> DataFrame:
    """Four KPIs against their targets.  For late % lower is better."""
    k = kpis.select(F.col("late_pct"), F.col("profit_margin"), F.col("avg_order_value"),
                    repeat_rate.alias("repeat_rate"))
    stacked = k.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("kpi"), F.col(name).cast("double").alias("value"),
                 F.lit(target).alias("target"))
        for name, target in KPI_TARGETS.items()])).alias("r")).select("r.*")
    lower_is_better = F.col("kpi") == "late_pct"
    gap = F.when(lower_is_better, F.col("target") - F.col("value")).otherwise(F.col("value") - F.col("target"))
    status = (F.when(lower_is_better, F.when(F.col("value") > F.col("target"), "danger").otherwise("ok"))
              .otherwise(F.when(F.col("value") >= F.col("target"), "ok").otherwise("below")))
    return stacked.withColumns({"gap": round2(gap), "status": status})


def growth_direction(monthly: DataFrame, target: float = MONTHLY_TARGET) -> DataFrame:
    """Sign of the MoM growth and the gap to the monthly revenue line."""
    g = F.col("mom_revenue_growth_pct")
    return monthly.select(
        "order_year", "order_month", "total_revenue", "mom_revenue_growth_pct",
        F.when(g.isNull(), None).when(g >= 0, "up").otherwise("down").alias("direction"),
        (F.col("total_revenue") >= target).alias("meets_target"),
        round2(F.col("total_revenue") - target).alias("target_gap"))


def year_filter(monthly: DataFrame, year: int | None) -> DataFrame:
    """One year's months (NULL / 0 = all), ordered."""
    out = monthly if not year else monthly.filter(F.col("order_year") == year)
    return out.orderBy("order_year", "order_month")


def years(monthly: DataFrame) -> DataFrame:
    """P16."""
    return monthly.select(F.col("order_year").cast("int").alias("order_year")).distinct().orderBy("order_year")


def json_safe(df: DataFrame) -> DataFrame:
    """NaN / +-Inf -> NULL in every floating column."""
    return df.withColumns({f.name: nan_to_null(F.col(f.name)) for f in df.schema.fields
                           if f.dataType.typeName() in ("double", "float")})


def customer_names(dim_customer: DataFrame) -> DataFrame:
    """First || ' ' || last (NULL-propagating, like SQL ||)."""
    return dim_customer.select("customer_id",
                               F.concat(F.col("customer_fname"), F.lit(" "), F.col("customer_lname"))
                               .alias("customer_name"))
