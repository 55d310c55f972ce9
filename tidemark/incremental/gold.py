"""Gold from mergeable state (A1-A6): sums and key sets for each group and batch, folded on read.

For every Gold table a batch writes two small deltas: sums and counts for each group, and how many rows each group has of
each order (a key set that can shrink: an order counts while its number is above zero). Rows that leave Silver because the
bounds moved come with the sign -1. Deltas add up in any order and any grouping of batches, so the fold over k
batches is the table that one run over all rows gives.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import as_money, mean_exact, pct, round2
from tidemark.incremental.silver import merged
from tidemark.incremental.tables import Version, VersionedTables, at_once
from tidemark.operators.gold import mom_growth

SUM, COUNT = "decimal(38,2)", "bigint"


def _total(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _share(c: str) -> Column:
    """A percent of 2 dp as an exact number."""
    return F.coalesce(as_money(F.col(c)), F.lit(0))


def _n(c: str) -> Column:
    return F.col(c).isNotNull().cast("bigint")


def _flag(c: str) -> Column:
    return F.coalesce(F.col(c).cast("bigint"), F.lit(0))


@dataclass(frozen=True)
class State:
    """Group keys, what is summed over a group's rows (name: value, type), whether orders are told apart, the final table."""

    keys: list[str]
    sums: dict[str, tuple[Column, str]]
    orders: bool
    finish: Callable[[DataFrame], DataFrame]

    def sum_schema(self, rows: DataFrame) -> str:
        return ", ".join([*_typed(rows, self.keys), *(f"{c} {t}" for c, (_, t) in self.sums.items()), "n_rows bigint"])

    def order_schema(self, rows: DataFrame) -> str:
        return ", ".join([*_typed(rows, [*self.keys, "order_id"]), "n bigint"])

    def sums_of(self, signed: DataFrame) -> DataFrame:
        """The delta of sums: rows with _sign 1 add, rows with _sign -1 take off."""
        sign = lambda x: F.when(F.col("_sign") > 0, x).otherwise(-x)
        return (signed.dropna(subset=self.keys).groupBy(*self.keys)
                .agg(*[F.sum(sign(x.cast("decimal(18,2)") if t == SUM else x)).cast(t).alias(c) for c, (x, t) in self.sums.items()],
                     F.sum(F.col("_sign").cast("bigint")).alias("n_rows")))

    def orders_of(self, signed: DataFrame) -> DataFrame:
        """The delta of key sets."""
        return (signed.dropna(subset=self.keys).filter(F.col("order_id").isNotNull()).groupBy(*self.keys, "order_id")
                .agg(F.sum(F.col("_sign").cast("bigint")).alias("n")))

    def add_sums(self, deltas: DataFrame) -> DataFrame:
        return (deltas.groupBy(*self.keys).agg(*[F.sum(c).cast(t).alias(c) for c, (_, t) in self.sums.items()],
                                               F.sum("n_rows").alias("n_rows")).filter(F.col("n_rows") != 0))

    def add_orders(self, deltas: DataFrame) -> DataFrame:
        return deltas.groupBy(*self.keys, "order_id").agg(F.sum("n").alias("n")).filter(F.col("n") != 0)

    def table(self, sums: DataFrame, orders: DataFrame | None) -> DataFrame:
        """The Gold table from folded state."""
        groups = self.add_sums(sums)
        if orders is not None:
            met = self.add_orders(orders).groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_orders"))
            groups = groups.join(met, self.keys, "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))
        return self.finish(groups)


def _typed(rows: DataFrame, columns: list[str]) -> list[str]:
    kinds = dict(rows.dtypes)
    return [f"{c} {kinds[c]}" for c in columns]


def _double(c: str, alias: str) -> Column:
    return F.col(c).cast("double").alias(alias)


def _monthly(g: DataFrame) -> DataFrame:
    m = g.select("order_year", "order_month", "order_month_name", _double("sales", "total_revenue"), _double("profit", "total_profit"),
                 F.col("n_orders").alias("total_orders"), F.col("items").alias("total_items"),
                 mean_exact(F.col("sales"), F.col("n_sales")).alias("avg_order_value"))
    return mom_growth(m, "total_revenue", ["order_year", "order_month"], "mom_revenue_growth_pct").orderBy("order_year", "order_month")


def _market(g: DataFrame) -> DataFrame:
    keys = ["market", "order_region", "order_country"]
    return g.select(*keys, _double("sales", "total_revenue"), _double("profit", "total_profit"), F.col("n_orders").alias("total_orders"),
                    mean_exact(F.col("margin"), F.col("n_margin")).alias("avg_margin_pct"), F.col("late").alias("late_shipments"),
                    F.col("items").alias("total_shipments"), pct(F.col("late"), F.col("items")).alias("late_pct")).orderBy(
                        F.desc("total_revenue"), *keys)


def _product(g: DataFrame) -> DataFrame:
    return g.select("product_card_id", "product_name", "category_name", "department_name", _double("sales", "total_revenue"),
                    F.col("units").alias("units_sold"), mean_exact(F.col("margin"), F.col("n_margin")).alias("avg_margin_pct"),
                    mean_exact(F.col("discount"), F.col("n_discount")).alias("avg_discount"),
                    F.col("n_orders").alias("order_count")).orderBy(F.desc("total_revenue"), "product_card_id")


def _segments(g: DataFrame) -> DataFrame:
    each = g.select("customer_segment", F.col("sales").alias("clv"),
                    F.try_divide(F.col("sales").cast("double"), F.col("n_sales").cast("double")).alias("aov"),
                    (F.col("n_orders") > 1).cast("bigint").alias("repeat"))
    return (each.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("total_customers"), mean_exact(F.sum("clv"), F.count("clv")).alias("avg_clv"),
                 round2(F.avg("aov")).alias("avg_aov"), F.sum("repeat").alias("repeat_customers"),
                 F.sum("clv").cast("double").alias("total_revenue"))
            .withColumn("repeat_rate_pct", pct(F.col("repeat_customers"), F.col("total_customers"))).orderBy("customer_segment"))


def _late(g: DataFrame) -> DataFrame:
    keys = ["shipping_mode", "delivery_status"]
    return g.select(*keys, F.col("items").alias("total_shipments"), F.col("late").alias("late_shipments"),
                    mean_exact(F.col("delay"), F.col("n_delay")).alias("avg_delay_days"),
                    mean_exact(F.col("sales"), F.col("n_sales")).alias("avg_revenue"),
                    pct(F.col("late"), F.col("items")).alias("late_pct")).orderBy(F.desc("late_pct"), *keys)


def _shipping(g: DataFrame) -> DataFrame:
    return g.select("shipping_mode", mean_exact(F.col("actual"), F.col("n_actual")).alias("avg_actual_days"),
                    mean_exact(F.col("scheduled"), F.col("n_scheduled")).alias("avg_scheduled_days"),
                    mean_exact(F.col("delay"), F.col("n_delay")).alias("avg_delay"), pct(F.col("late"), F.col("n_late")).alias("late_pct"),
                    F.col("items").alias("shipment_count"), mean_exact(F.col("sales"), F.col("n_sales")).alias("avg_revenue")).orderBy(
                        "shipping_mode")


def _states() -> dict[str, State]:
    sales, n_sales = (_total("sales"), SUM), (_n("sales"), COUNT)
    profit, items, late = (_total("order_profit_per_order"), SUM), (_n("order_item_id"), COUNT), (_flag("is_late"), COUNT)
    margin, n_margin = (_share("profit_margin_pct"), SUM), (_n("profit_margin_pct"), COUNT)
    delay, n_delay = (_total("delivery_delay_days"), COUNT), (_n("delivery_delay_days"), COUNT)
    return {
        "gold_monthly_revenue": State(["order_year", "order_month", "order_month_name"], {
            "sales": sales, "n_sales": n_sales, "profit": profit, "items": items}, True, _monthly),
        "gold_market_performance": State(["market", "order_region", "order_country"], {
            "sales": sales, "profit": profit, "margin": margin, "n_margin": n_margin, "late": late, "items": items}, True, _market),
        "gold_product_performance": State(["product_card_id", "product_name", "category_name", "department_name"], {
            "sales": sales, "units": (_total("order_item_quantity"), COUNT), "margin": margin, "n_margin": n_margin,
            "discount": (_share("discount_pct"), SUM), "n_discount": (_n("discount_pct"), COUNT)}, True, _product),
        "gold_customer_segments": State(["customer_id", "customer_segment"], {"sales": sales, "n_sales": n_sales}, True, _segments),
        "gold_late_delivery_risk": State(["shipping_mode", "delivery_status"], {
            "items": items, "late": late, "delay": delay, "n_delay": n_delay, "sales": sales, "n_sales": n_sales}, False, _late),
        "gold_shipping_efficiency": State(["shipping_mode"], {
            "actual": (_total("days_for_shipping_real"), COUNT), "n_actual": (_n("days_for_shipping_real"), COUNT),
            "scheduled": (_total("days_for_shipment_scheduled"), COUNT), "n_scheduled": (_n("days_for_shipment_scheduled"), COUNT),
            "delay": delay, "n_delay": n_delay, "late": late, "n_late": (_n("is_late"), COUNT), "items": items, "sales": sales,
            "n_sales": n_sales}, False, _shipping),
    }


def add_batch(store: VersionedTables, version: Version, signed: DataFrame) -> dict[str, list[str]]:
    """Write the deltas of a batch, from the featured rows that enter or leave Silver; the folders of every state table."""
    tasks = {}
    for name, state in _states().items():
        tasks[f"{name}_sums"] = (state.sums_of(signed), state.sum_schema(signed), state.add_sums)
        if state.orders:
            tasks[f"{name}_orders"] = (state.orders_of(signed), state.order_schema(signed), state.add_orders)

    def write(table, delta, schema, add):
        return merged(store, [*version.of(table), store.write(delta, table)], table, schema, add)

    return at_once({table: partial(write, table, *task) for table, task in tasks.items()})


def gold(store: VersionedTables, name: str, version: Version | None = None) -> DataFrame:
    """A Gold table of a version, folded from its state."""
    version = version or store.current()
    state = _states()[name]
    return state.table(store.read(f"{name}_sums", version), store.read(f"{name}_orders", version) if state.orders else None)


GOLD_TABLES = ["gold_monthly_revenue", "gold_market_performance", "gold_product_performance", "gold_customer_segments",
               "gold_late_delivery_risk", "gold_shipping_efficiency"]
