"""Dashboard aggregations (P13, P14, A18-A27) over the denormalised star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import mean_exact, pct
from tidemark.operators.star import FACT_YEAR

# The columns of each dimension in the denormalised star.
DENORM_DIM_COLUMNS = {
    "dim_date": ["full_date", "year", "quarter", "month", "month_name", "day", "day_of_week", "week_of_year"],
    "dim_customer": ["customer_fname", "customer_lname", "customer_segment", "customer_city",
                     "customer_state", "customer_country", "customer_zipcode",
                     "customer_lifetime_value", "avg_order_value", "order_count", "is_repeat_customer"],
    "dim_product": ["product_name", "product_price", "category_id", "category_name",
                    "department_id", "department_name", "product_status"],
    "dim_location": ["order_city", "order_state", "order_country", "order_region", "market",
                     "latitude", "longitude"],
    "dim_shipping": ["shipping_mode", "delivery_status"],
}
DIM_KEYS = {"dim_date": "date_id", "dim_customer": "customer_id", "dim_product": "product_card_id",
            "dim_location": "location_id", "dim_shipping": "shipping_id"}


# The filter columns and the dimension of each.
FILTER_COLUMNS = {"year": "dim_date", "market": "dim_location", "customer_segment": "dim_customer", "shipping_mode": "dim_shipping"}


def denormalised(tables: dict[str, DataFrame], dims: list[str] | None = None) -> DataFrame:
    """Fact LEFT JOIN each dimension on its key (``dims``: only those).

    AQE broadcasts a dimension that is small in bytes; only the modes x statuses are
    small by definition.  Catalyst cannot drop an unused LEFT join (it does not know the
    dimension key is unique), so a caller that reads no column of a dimension leaves it out.
    """
    df = tables["fact_sales"]
    for dim, key in DIM_KEYS.items():
        if dims is not None and dim not in dims:
            continue
        d = tables[dim].select(key, *DENORM_DIM_COLUMNS[dim])
        if dim == "dim_date" and FACT_YEAR in df.columns:
            # a fact in folders by year: a filter on the date's year is one on the folders, too
            df = df.join(d, (df[key] == d[key]) & (df[FACT_YEAR] == d["year"]), "left").drop(d[key]).drop(FACT_YEAR)
            continue
        df = df.join(F.broadcast(d) if dim == "dim_shipping" else d, key, "left")
    return df


class Slice:
    """The four multi-selects (None = no restriction).  Rows with a NULL in a
    filtered column never match (``isin`` of the listed values)."""

    def __init__(self, years=None, markets=None, segments=None, modes=None):
        self.selected = {"year": years, "market": markets, "customer_segment": segments, "shipping_mode": modes}

    def apply(self, df: DataFrame) -> DataFrame:
        for col, values in self.selected.items():
            if values is not None:
                df = df.filter(F.col(col).isin(list(values)))
        return df


def distinct_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Sorted distinct non-NULL values of the four filter columns that occur with a
    fact, as one frame: each dimension is semi-joined with the fact's keys alone."""
    out = None
    for col, dim in FILTER_COLUMNS.items():
        key = DIM_KEYS[dim]
        used = tables[dim].select(key, col).join(tables["fact_sales"].select(key).distinct(), key, "left_semi")
        v = used.select(F.lit(col).alias("filter"), F.col(col).cast("string").alias("value")).dropna().distinct()
        out = v if out is None else out.unionByName(v)
    return out.orderBy("filter", "value")


def dash_kpis(s: DataFrame) -> DataFrame:
    """Revenue, distinct orders, AOV, profit, late %, distinct customers.

    The two distinct counts are separate scalar aggregates (each scans only its own
    column) instead of one aggregate that would Expand every row per distinct column.
    """
    orders = s.agg(F.count_distinct("order_id")).scalar()
    customers = s.agg(F.count_distinct("customer_id")).scalar()
    a = s.agg(F.sum("sales").alias("rev"), F.sum("order_profit_per_order").alias("profit"),
              F.sum(F.col("is_late").cast("bigint")).alias("late"), F.count(F.lit(1)).alias("n"))
    return a.select(
        F.coalesce(F.col("rev"), F.lit(0)).cast("double").alias("total_revenue"),
        orders.alias("total_orders"),
        F.when(orders > 0, mean_exact(F.col("rev"), orders)).otherwise(0.0).alias("avg_order_value"),
        F.coalesce(F.col("profit"), F.lit(0)).cast("double").alias("total_profit"),
        F.when(F.col("n") > 0, pct(F.col("late"), F.col("n"))).otherwise(0.0).alias("late_pct"),
        customers.alias("total_customers"))


def dash_monthly(s: DataFrame) -> DataFrame:
    """Monthly revenue / profit / distinct orders, period label, unrounded MoM %."""
    from pyspark.sql import Window
    m = (s.groupBy("year", "month", "month_name")
         .agg(F.sum("sales").cast("double").alias("revenue"),
              F.sum("order_profit_per_order").cast("double").alias("profit"),
              F.count_distinct("order_id").alias("orders")))
    prev = F.lag("revenue").over(Window.orderBy("year", "month"))
    return m.select("*", F.concat_ws(" ", "month_name", F.col("year").cast("string")).alias("period"),
                    ((F.col("revenue") / F.nullif(prev, F.lit(0.0)) - 1) * 100).alias("mom_growth"))


def dash_market(s: DataFrame) -> DataFrame:
    """A20."""
    return (s.groupBy("market").agg(F.sum("sales").cast("double").alias("revenue"),
                                    F.count_distinct("order_id").alias("orders"))
            .orderBy(F.desc("revenue"), "market"))


def dash_late_by_mode(s: DataFrame) -> DataFrame:
    """A21."""
    return (s.groupBy("shipping_mode")
            .agg(F.count("order_item_id").alias("total"), F.sum(F.col("is_late").cast("bigint")).alias("late"))
            .withColumn("late_pct", pct(F.col("late"), F.col("total"))))


def dash_category(s: DataFrame, k: int = 15) -> DataFrame:
    """Revenue per (category, department), top k."""
    g = (s.groupBy("category_name", "department_name")
         .agg(F.sum("sales").cast("double").alias("revenue")))
    return g.orderBy(F.desc("revenue"), "category_name", "department_name").limit(k)


def dash_top_products(s: DataFrame, k: int = 10) -> DataFrame:
    """T3 (dashboard form): revenue and units per (product, category), top k."""
    g = (s.groupBy("product_name", "category_name")
         .agg(F.sum("sales").cast("double").alias("revenue"),
              F.sum("order_item_quantity").cast("bigint").alias("units")))
    return g.orderBy(F.desc("revenue"), "product_name", "category_name").limit(k)


def dash_status_counts(s: DataFrame) -> DataFrame:
    """Value counts of delivery status, NULL dropped."""
    return (s.filter(F.col("delivery_status").isNotNull()).groupBy(F.col("delivery_status").alias("status"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "status"))


def dash_segment(s: DataFrame) -> DataFrame:
    """A24."""
    return (s.groupBy("customer_segment").agg(F.sum("sales").cast("double").alias("revenue"),
                                              F.count_distinct("customer_id").alias("customers")))


def dash_geo(s: DataFrame) -> DataFrame:
    """A25."""
    return (s.groupBy("order_country", "latitude", "longitude")
            .agg(F.sum("sales").cast("double").alias("revenue"), F.count_distinct("order_id").alias("orders")))


def margin_histogram(s: DataFrame, lo: float = -200.0, hi: float = 200.0, bins: int = 60) -> DataFrame:
    """Equal-width bins over [lo, hi]; the upper edge falls in the last bin.

    Bin 0 counts what lies below the range and bin ``bins + 1`` what lies above (no start /
    no end), the NULL bin rows without a margin: the counts add up to the rows.
    """
    x, bin_no = F.col("profit_margin_pct"), F.col("bin")
    inside = F.least(F.floor((x - lo) * bins / (hi - lo)).cast("int") + 1, F.lit(bins))
    b = F.when(x < lo, F.lit(0)).when(x > hi, F.lit(bins + 1)).otherwise(inside)
    width = (hi - lo) / bins
    return (s.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .select("bin", F.when(bin_no > 0, F.lit(lo) + (bin_no - 1) * width).alias("bin_start"),
                    F.when(bin_no <= bins, F.when(bin_no == 0, F.lit(lo)).otherwise(F.lit(lo) + bin_no * width)).alias("bin_end"),
                    "count"))


def delay_histogram(s: DataFrame, lo: int = -10, hi: int = 10) -> DataFrame:
    """One bin per whole day of delay in [lo, hi], split by is_late; delays outside count
    under ``position`` below / above, rows without a delay under none."""
    x = F.col("delivery_delay_days")
    position = F.when(x.isNull(), "none").when(x < lo, "below").when(x > hi, "above").otherwise("in range")
    return (s.groupBy(position.alias("position"), F.when(x.between(lo, hi), x).alias("delivery_delay_days"), "is_late")
            .agg(F.count(F.lit(1)).alias("count")))
