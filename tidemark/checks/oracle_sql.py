"""Oracle SQL (DuckDB dialect), one statement per registered query."""

from __future__ import annotations

from tidemark.checks.oracle_base import RAW_COLUMNS, RERUN_PREFIX, half_away, qi, with_prefix

ORACLE: dict[str, str] = {}


def r2(x: str) -> str:
    """A DOUBLE to 2 dp, half away from zero."""
    return f"(sign({x}) * floor(abs(CAST({x} AS DOUBLE)) * 100 + 0.5) / 100)"


def pct(n: str, d: str, places: int = 2) -> str:
    return half_away(n, d, 100, places)


def mean(c: str) -> str:
    return half_away(f"sum({c})", f"count({c})")


def mean_pct(c: str) -> str:
    return half_away(f"sum(CAST({c} AS DECIMAL(18,2)))", f"count({c})")


def money_sum(c: str) -> str:
    return f"CAST(coalesce(sum({c}), 0) AS DOUBLE)"


# ---- Gold KPI tables -------------------------------------------------------------
GOLD_CTES = {
    "gold_monthly_revenue": f"""gold_monthly_revenue AS (
  SELECT * EXCLUDE (_prev), {pct('(CAST(total_revenue AS DECIMAL(28,2)) - _prev)', '_prev')} AS mom_revenue_growth_pct
  FROM (SELECT *, CAST(lag(total_revenue) OVER (ORDER BY order_year, order_month) AS DECIMAL(28,2)) AS _prev FROM (
    SELECT order_year, order_month, order_month_name,
           {money_sum('sales')} AS total_revenue,
           {money_sum('order_profit_per_order')} AS total_profit,
           count(DISTINCT order_id) AS total_orders,
           count(order_item_id) AS total_items,
           {mean('sales')} AS avg_order_value
    FROM prep
    WHERE order_year IS NOT NULL AND order_month IS NOT NULL AND order_month_name IS NOT NULL
    GROUP BY order_year, order_month, order_month_name)))""",
    "gold_market_performance": f"""gold_market_performance AS (
  SELECT *, {pct('late_shipments', 'total_shipments')} AS late_pct
  FROM (
    SELECT market, order_region, order_country,
           {money_sum('sales')} AS total_revenue,
           {money_sum('order_profit_per_order')} AS total_profit,
           count(DISTINCT order_id) AS total_orders,
           {mean_pct('profit_margin_pct')} AS avg_margin_pct,
           sum(CAST(is_late AS BIGINT)) AS late_shipments,
           count(order_item_id) AS total_shipments
    FROM prep
    WHERE market IS NOT NULL AND order_region IS NOT NULL AND order_country IS NOT NULL
    GROUP BY market, order_region, order_country))""",
    "gold_product_performance": f"""gold_product_performance AS (
  SELECT product_card_id, product_name, category_name, department_name,
         {money_sum('sales')} AS total_revenue,
         CAST(coalesce(sum(order_item_quantity), 0) AS BIGINT) AS units_sold,
         {mean_pct('profit_margin_pct')} AS avg_margin_pct,
         {mean_pct('discount_pct')} AS avg_discount,
         count(DISTINCT order_id) AS order_count
  FROM prep
  WHERE product_card_id IS NOT NULL AND product_name IS NOT NULL AND category_name IS NOT NULL
    AND department_name IS NOT NULL
  GROUP BY product_card_id, product_name, category_name, department_name)""",
    "gold_customer_segments": f"""seg_cust AS (
  SELECT customer_id, customer_segment,
         coalesce(sum(sales), 0) AS clv,
         CAST(sum(sales) AS DOUBLE) / CAST(count(sales) AS DOUBLE) AS aov,
         count(DISTINCT order_id) AS order_count
  FROM prep WHERE customer_id IS NOT NULL AND customer_segment IS NOT NULL
  GROUP BY customer_id, customer_segment),
gold_customer_segments AS (
  SELECT *, {pct('repeat_customers', 'total_customers')} AS repeat_rate_pct
  FROM (
    SELECT customer_segment,
           count(customer_id) AS total_customers,
           {half_away('sum(clv)', 'count(clv)')} AS avg_clv,
           {r2('avg(aov)')} AS avg_aov,
           sum(CAST(order_count > 1 AS BIGINT)) AS repeat_customers,
           CAST(sum(clv) AS DOUBLE) AS total_revenue
    FROM seg_cust GROUP BY customer_segment))""",
    "gold_late_delivery_risk": f"""gold_late_delivery_risk AS (
  SELECT *, {pct('late_shipments', 'total_shipments')} AS late_pct
  FROM (
    SELECT shipping_mode, delivery_status,
           count(order_item_id) AS total_shipments,
           sum(CAST(is_late AS BIGINT)) AS late_shipments,
           {mean('delivery_delay_days')} AS avg_delay_days,
           {mean('sales')} AS avg_revenue
    FROM prep WHERE shipping_mode IS NOT NULL AND delivery_status IS NOT NULL
    GROUP BY shipping_mode, delivery_status))""",
    "gold_shipping_efficiency": f"""gold_shipping_efficiency AS (
  SELECT shipping_mode,
         {mean('days_for_shipping_real')} AS avg_actual_days,
         {mean('days_for_shipment_scheduled')} AS avg_scheduled_days,
         {mean('delivery_delay_days')} AS avg_delay,
         {pct('sum(CAST(is_late AS BIGINT))', 'count(is_late)')} AS late_pct,
         count(order_item_id) AS shipment_count,
         {mean('sales')} AS avg_revenue
  FROM prep WHERE shipping_mode IS NOT NULL GROUP BY shipping_mode)""",
}

for _key, _table in [("monthly_revenue", "gold_monthly_revenue"),
                     ("market_performance", "gold_market_performance"),
                     ("product_performance", "gold_product_performance"),
                     ("customer_segments", "gold_customer_segments"),
                     ("late_delivery_risk", "gold_late_delivery_risk"),
                     ("shipping_efficiency", "gold_shipping_efficiency")]:
    ORACLE[_key] = with_prefix(GOLD_CTES[_table], f"SELECT * FROM {_table}")

ORACLE["silver"] = with_prefix("SELECT * EXCLUDE (_row_digest, _ingest) FROM silver")
ORACLE["bronze_ingest"] = with_prefix("SELECT * EXCLUDE (_row_digest) FROM bronze")
ORACLE["row_hash"] = with_prefix(
    'SELECT "Order Item Id" AS order_item_id, _row_number, _row_hash FROM bronze')
_null_cells = " + ".join(f"count(*) - count({qi(c)})" for c in RAW_COLUMNS)
ORACLE["bronze_stats"] = with_prefix(f"""
SELECT count(*) AS rows, CAST({len(RAW_COLUMNS) + 4} AS BIGINT) AS columns,
       CAST({_null_cells} AS BIGINT) AS null_cells,
       count(*) - count(DISTINCT _row_digest) AS duplicate_hashes
FROM bronze""")


# ---- Star schema -------------------------------------------------------------------
_LOC7 = ["order_city", "order_state", "order_country", "order_region", "market", "latitude", "longitude"]
_LOC5 = _LOC7[:5]
_CUST_ATTRS = ["customer_fname", "customer_lname", "customer_segment", "customer_city",
               "customer_state", "customer_country", "customer_zipcode"]
_nl = lambda cols: ", ".join(f"{c} ASC NULLS LAST" for c in cols)
_nse = lambda a, b, cols: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)

STAR_CTES = f"""dim_date AS (
  SELECT row_number() OVER (ORDER BY full_date ASC NULLS LAST) AS date_id, full_date,
         CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month, strftime(full_date, '%B') AS month_name,
         CAST(day(full_date) AS INTEGER) AS day, strftime(full_date, '%A') AS day_of_week,
         CAST(weekofyear(full_date) AS INTEGER) AS week_of_year
  FROM (SELECT DISTINCT CAST(order_date AS DATE) AS full_date FROM prep WHERE order_date IS NOT NULL)),
dim_location AS (
  SELECT row_number() OVER (ORDER BY {_nl(_LOC7)}) AS location_id, {", ".join(_LOC7)}
  FROM (SELECT DISTINCT {", ".join(_LOC7)} FROM prep)),
dim_shipping AS (
  SELECT row_number() OVER (ORDER BY shipping_mode ASC NULLS LAST, delivery_status ASC NULLS LAST)
           AS shipping_id, shipping_mode, delivery_status
  FROM (SELECT DISTINCT shipping_mode, delivery_status FROM prep)),
cust_first AS (
  SELECT customer_id, {", ".join(_CUST_ATTRS)} FROM prep WHERE customer_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _row_number, _row_digest) = 1),
cust_metrics AS (
  SELECT customer_id, sum(sales) AS _clv, count(sales) AS _n, count(DISTINCT order_id) AS order_count
  FROM prep WHERE customer_id IS NOT NULL GROUP BY customer_id),
dim_customer AS (
  SELECT f.customer_id, {", ".join("f." + c for c in _CUST_ATTRS)},
         CAST(m._clv AS DOUBLE) AS customer_lifetime_value,
         CAST(m._clv AS DOUBLE) / nullif(CAST(m._n AS DOUBLE), 0.0) AS avg_order_value,
         m.order_count, m.order_count > 1 AS is_repeat_customer
  FROM cust_first f JOIN cust_metrics m ON f.customer_id = m.customer_id),
dim_product AS (
  SELECT product_card_id, product_name, CAST(product_price AS DOUBLE) AS product_price, category_id,
         category_name, department_id, department_name, product_status
  FROM prep WHERE product_card_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY product_card_id ORDER BY _row_number, _row_digest) = 1),
loc_lookup AS (
  SELECT {", ".join(_LOC5)}, max(location_id) AS location_id FROM dim_location GROUP BY {", ".join(_LOC5)}),
fact_sales AS (
  SELECT p.order_item_id, p.order_id, p.customer_id, p.product_card_id, d.date_id, l.location_id, s.shipping_id,
         p.order_item_quantity, p.sales, p.order_item_discount, p.order_profit_per_order, p.benefit_per_order,
         p.order_item_product_price, p.order_item_total, p.days_for_shipping_real, p.delivery_days_actual,
         p.delivery_delay_days, p.is_late, p.profit_margin_pct, p.discount_pct, p.revenue_per_item,
         p.order_status, p.type
  FROM prep p
  LEFT JOIN dim_date d ON CAST(p.order_date AS DATE) = d.full_date
  LEFT JOIN loc_lookup l ON {_nse('p', 'l', _LOC5)}
  LEFT JOIN dim_shipping s ON {_nse('p', 's', ['shipping_mode', 'delivery_status'])})"""


def with_star(final: str, *extra: str) -> str:
    return with_prefix(STAR_CTES, *extra, final)


for _t in ["dim_customer", "dim_product", "dim_date", "dim_location", "dim_shipping", "fact_sales"]:
    ORACLE[_t] = with_star(f"SELECT * FROM {_t}")

ORACLE["legacy_fact_sales"] = with_star("SELECT * EXCLUDE (days_for_shipping_real) FROM fact_sales")

_FKS = [("customer_id", "dim_customer", "customer_id"), ("product_card_id", "dim_product", "product_card_id"),
        ("date_id", "dim_date", "date_id"), ("location_id", "dim_location", "location_id"),
        ("shipping_id", "dim_shipping", "shipping_id")]
_PKS = {"dim_customer": "customer_id", "dim_product": "product_card_id", "dim_date": "date_id",
        "dim_location": "location_id", "dim_shipping": "shipping_id", "fact_sales": "order_item_id"}
_fk_parts = [f"""SELECT 'foreign_key' AS "check", 'fact_sales' AS table_name, '{fk}' AS column_name,
  count(*) AS violations FROM fact_sales f WHERE f.{fk} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})""" for fk, dim, pk in _FKS]
for _t, _pk in _PKS.items():
    _fk_parts.append(f"""SELECT 'primary_key_unique', '{_t}', '{_pk}',
  CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT {_pk}, count(*) AS c FROM {_t} GROUP BY {_pk} HAVING count(*) > 1)""")
    _fk_parts.append(f"""SELECT 'primary_key_not_null', '{_t}', '{_pk}', count(*) FILTER (WHERE {_pk} IS NULL) FROM {_t}""")
ORACLE["fk_check"] = with_star("\nUNION ALL\n".join(_fk_parts))

ORACLE["integrity_anti_join"] = with_star("\nUNION ALL\n".join(
    f"""SELECT '{fk}' AS foreign_key, order_item_id, CAST({fk} AS BIGINT) AS key_value FROM fact_sales f
  WHERE {fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})""" for fk, dim, pk in _FKS))

for _key, _dim, _k, _cols in [("fact_date_join", "dim_date", "date_id", ["full_date", "year", "month"]),
                              ("fact_location_join", "dim_location", "location_id",
                               ["order_city", "order_country", "market"]),
                              ("fact_product_join", "dim_product", "product_card_id",
                               ["product_name", "category_name", "department_name"]),
                              ("fact_shipping_join", "dim_shipping", "shipping_id",
                               ["shipping_mode", "delivery_status"])]:
    ORACLE[_key] = with_star(f"SELECT f.order_item_id, f.{_k}, {', '.join('d.' + c for c in _cols)} "
                             f"FROM fact_sales f JOIN {_dim} d ON f.{_k} = d.{_k}")

DENORM_SELECT = """SELECT f.*,
  dd.full_date, dd.year, dd.quarter, dd.month, dd.month_name, dd.day, dd.day_of_week, dd.week_of_year,
  dc.customer_fname, dc.customer_lname, dc.customer_segment, dc.customer_city, dc.customer_state,
  dc.customer_country, dc.customer_zipcode, dc.customer_lifetime_value, dc.avg_order_value, dc.order_count,
  dc.is_repeat_customer,
  dp.product_name, dp.product_price, dp.category_id, dp.category_name, dp.department_id, dp.department_name,
  dp.product_status,
  dl.order_city, dl.order_state, dl.order_country, dl.order_region, dl.market, dl.latitude, dl.longitude,
  ds.shipping_mode, ds.delivery_status
FROM fact_sales f
LEFT JOIN dim_date dd ON f.date_id = dd.date_id
LEFT JOIN dim_customer dc ON f.customer_id = dc.customer_id
LEFT JOIN dim_product dp ON f.product_card_id = dp.product_card_id
LEFT JOIN dim_location dl ON f.location_id = dl.location_id
LEFT JOIN dim_shipping ds ON f.shipping_id = ds.shipping_id"""
DENORM_CTE = f"denorm AS ({DENORM_SELECT})"
ORACLE["star_denormalise"] = with_star(DENORM_SELECT)

ORACLE["customer_agg_join"] = with_star("""SELECT p.order_item_id, p.customer_id,
  CAST(m._clv AS DOUBLE) AS customer_lifetime_value,
  CAST(m._clv AS DOUBLE) / nullif(CAST(m._n AS DOUBLE), 0.0) AS avg_order_value,
  m.order_count, m.order_count > 1 AS is_repeat_customer
FROM prep p LEFT JOIN (
  SELECT customer_id, sum(sales) AS _clv, count(sales) AS _n, count(DISTINCT order_id) AS order_count
  FROM prep WHERE customer_id IS NOT NULL GROUP BY customer_id) m ON p.customer_id = m.customer_id""")
ORACLE["surrogate_key_lookup"] = with_star("SELECT order_item_id, date_id, location_id, shipping_id FROM fact_sales")
ORACLE["surrogate_keys"] = with_star("""
SELECT 'dim_date' AS dimension, date_id AS id, CAST(full_date AS VARCHAR) AS natural_key FROM dim_date
UNION ALL
SELECT 'dim_location', location_id, concat_ws('|', order_city, order_state, order_country, order_region, market,
  CAST(CAST(latitude AS DECIMAL(10,2)) AS VARCHAR), CAST(CAST(longitude AS DECIMAL(10,2)) AS VARCHAR)) FROM dim_location
UNION ALL
SELECT 'dim_shipping', shipping_id, concat_ws('|', shipping_mode, delivery_status) FROM dim_shipping""")

# ---- Query layer over the star ------------------------------------------------------
def star_rollup(dim: str, key: str, keys: str, measures: str, tail: str = "") -> str:
    return f"SELECT {keys}, {measures} FROM fact_sales INNER JOIN {dim} USING ({key}) GROUP BY ALL {tail}"


_REVENUE, _ORDERS = "CAST(sum(sales) AS DOUBLE)", "count(DISTINCT order_id)"
_LATE = "count(*) FILTER (WHERE is_late)"
for _name, _args in {
    "sql_monthly_trend": ("dim_date", "date_id", "year, month, month_name",
                          f"{_REVENUE} total_revenue, {_ORDERS} total_orders, {mean('sales')} avg_order_value"),
    "sql_market_region": ("dim_location", "location_id", "market, order_region",
                          f"{_REVENUE} revenue, count(*) order_items, {mean_pct('profit_margin_pct')} avg_margin_pct"),
    "sql_top_products": ("dim_product", "product_card_id", "product_name, category_name, department_name",
                         f"{_REVENUE} total_revenue, CAST(sum(order_item_quantity) AS BIGINT) units_sold, "
                         f"{mean_pct('profit_margin_pct')} avg_margin_pct", "ORDER BY total_revenue DESC, ALL LIMIT 10"),
    "sql_late_delivery": ("dim_shipping", "shipping_id", "shipping_mode, delivery_status",
                          f"count(*) total_shipments, {_LATE} late_shipments, {pct(_LATE, 'count(*)')} late_pct, "
                          f"{mean('delivery_delay_days')} avg_delay_days"),
    "sql_shipping_efficiency": ("dim_shipping", "shipping_id", "shipping_mode",
                                f"{mean('delivery_days_actual')} avg_actual_days, {mean('delivery_delay_days')} avg_delay, "
                                f"{mean('sales')} avg_sale_value, count(*) shipment_count"),
    "sql_top_countries": ("dim_location", "location_id", "order_country",
                          f"{_ORDERS} total_orders, {_REVENUE} total_revenue, {mean('sales')} avg_order_value, "
                          f"{mean_pct('profit_margin_pct')} avg_margin_pct", "ORDER BY total_revenue DESC, order_country LIMIT 15"),
    "daily_sales_summary": ("dim_date", "date_id", "full_date, year, month, month_name",
                            f"{_ORDERS} orders, {_REVENUE} revenue, CAST(sum(order_profit_per_order) AS DOUBLE) profit, "
                            f"{_LATE} late_deliveries"),
}.items():
    ORACLE[_name] = with_star(star_rollup(*_args).replace("DESC, ALL LIMIT", "DESC, product_name, category_name, department_name LIMIT"))
_BY_CATEGORY = star_rollup("dim_product", "product_card_id", "category_name, department_name", f"{_REVENUE} revenue")
ORACLE["category_rank"] = with_star(
    f"SELECT *, rank() OVER (PARTITION BY department_name ORDER BY revenue DESC) rank_in_dept FROM ({_BY_CATEGORY})")
_REPEAT = "count(*) FILTER (WHERE is_repeat_customer)"
ORACLE["sql_retention"] = with_star(f"""SELECT customer_segment, count(*) total_customers, {_REPEAT} repeat_customers,
  {pct(_REPEAT, 'count(*)')} repeat_rate_pct FROM dim_customer GROUP BY ALL""")
_MONTHS = star_rollup("dim_date", "date_id", "year, month", "sum(sales) exact")
ORACLE["sql_mom_growth"] = with_star(f"""SELECT year, month, CAST(exact AS DOUBLE) revenue, CAST(prev AS DOUBLE) prev_month_revenue,
  {pct('(exact - prev)', 'prev')} mom_growth_pct FROM (SELECT *, lag(exact) OVER (ORDER BY year, month) prev FROM ({_MONTHS}))""")
ORACLE["sql_top_customers"] = with_star(f"""SELECT customer_id, customer_fname || ' ' || customer_lname customer_name, customer_segment,
  customer_country, customer_lifetime_value clv, order_count, {r2('avg_order_value')} avg_order_value
  FROM dim_customer ORDER BY clv DESC, customer_id LIMIT 10""")


# ---- Metrics over Gold -------------------------------------------------------------
def dec(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,2))"


def with_gold(final: str, tables: list[str], star: bool = False, *extra: str) -> str:
    ctes = [GOLD_CTES[t] for t in tables]
    if star:
        return with_prefix(STAR_CTES, *ctes, *extra, final)
    return with_prefix(*ctes, *extra, final)


KPI_BODY = f"""
SELECT CAST(rev AS DOUBLE) AS total_revenue, orders AS total_orders,
       CASE WHEN orders > 0 THEN {half_away('rev', 'orders')} ELSE 0.0 END AS avg_order_value,
       CAST(profit AS DOUBLE) AS total_profit,
       (SELECT count(*) FROM dim_customer) AS total_customers,
       CASE WHEN ships > 0 THEN {pct('late', 'ships', 1)} ELSE 0.0 END AS late_pct,
       CASE WHEN rev <> 0 THEN {pct('profit', 'rev', 1)} ELSE 0.0 END AS profit_margin
FROM (SELECT sum({dec('total_revenue')}) AS rev, CAST(sum(total_orders) AS BIGINT) AS orders,
             sum({dec('total_profit')}) AS profit FROM gold_monthly_revenue) m,
     (SELECT sum(late_shipments) AS late, sum(total_shipments) AS ships FROM gold_late_delivery_risk) r"""
ORACLE["kpi_summary"] = with_gold(KPI_BODY, ["gold_monthly_revenue", "gold_late_delivery_risk"], True)

ORACLE["market_rollup"] = with_gold(f"""
SELECT market, CAST(sum({dec('total_revenue')}) AS DOUBLE) AS total_revenue,
       CAST(sum(total_orders) AS BIGINT) AS total_orders,
       {half_away('sum(' + dec('late_pct') + ')', 'count(late_pct)')} AS late_pct
FROM gold_market_performance GROUP BY market""", ["gold_market_performance"])
ORACLE["category_rollup"] = with_gold(f"""
SELECT category_name, CAST(sum({dec('total_revenue')}) AS DOUBLE) AS total_revenue,
       CAST(sum(units_sold) AS BIGINT) AS units_sold,
       {half_away('sum(' + dec('avg_margin_pct') + ')', 'count(avg_margin_pct)')} AS avg_margin_pct
FROM gold_product_performance GROUP BY category_name""", ["gold_product_performance"])


def band(x: str) -> str:
    return f"CASE WHEN {x} > 50 THEN 'bad' WHEN {x} > 30 THEN 'warn' ELSE 'ok' END"


ORACLE["mode_risk_rollup"] = with_gold(f"""
SELECT *, {band('late_pct')} AS risk_band FROM (
  SELECT shipping_mode, total, late, {pct('late', 'total')} AS late_pct FROM (
    SELECT shipping_mode, CAST(sum(total_shipments) AS BIGINT) AS total, CAST(sum(late_shipments) AS BIGINT) AS late
    FROM gold_late_delivery_risk GROUP BY shipping_mode))""", ["gold_late_delivery_risk"])
ORACLE["status_share"] = with_gold(f"""
SELECT delivery_status, shipments,
       {pct('shipments', '(SELECT sum(total_shipments) FROM gold_late_delivery_risk)')} AS share_pct
FROM (SELECT delivery_status, CAST(sum(total_shipments) AS BIGINT) AS shipments
      FROM gold_late_delivery_risk GROUP BY delivery_status)""", ["gold_late_delivery_risk"])
ORACLE["segment_profile"] = with_gold("""
SELECT customer_segment AS subject, CAST(floor(avg_clv + 0.5) AS BIGINT) AS clv,
       CAST(floor(avg_aov + 0.5) AS BIGINT) AS aov, repeat_rate_pct AS repeat
FROM gold_customer_segments""", ["gold_customer_segments"])
ORACLE["mom_growth"] = with_gold(
    "SELECT order_year, order_month, total_revenue, mom_revenue_growth_pct FROM gold_monthly_revenue",
    ["gold_monthly_revenue"])
ORACLE["anomalies"] = with_gold("""
SELECT concat_ws(' ', order_month_name, CAST(order_year AS VARCHAR)) AS period, order_year, order_month,
       total_revenue, mom_revenue_growth_pct
FROM gold_monthly_revenue
WHERE mom_revenue_growth_pct IS NOT NULL
  AND abs(mom_revenue_growth_pct - (SELECT avg(mom_revenue_growth_pct) FROM gold_monthly_revenue))
      > (SELECT stddev_pop(mom_revenue_growth_pct) FROM gold_monthly_revenue) * 1.8""", ["gold_monthly_revenue"])

ORACLE["kpi_vs_target"] = with_gold(f"""
SELECT kpi, value, target, {r2("CASE WHEN kpi = 'late_pct' THEN target - value ELSE value - target END")} AS gap,
       CASE WHEN kpi = 'late_pct' THEN (CASE WHEN value > target THEN 'danger' ELSE 'ok' END)
            ELSE (CASE WHEN value >= target THEN 'ok' ELSE 'below' END) END AS status
FROM (
  SELECT 'late_pct' AS kpi, CAST(late_pct AS DOUBLE) AS value, 30.0::DOUBLE AS target FROM kpis
  UNION ALL SELECT 'profit_margin', CAST(profit_margin AS DOUBLE), 15.0::DOUBLE FROM kpis
  UNION ALL SELECT 'avg_order_value', CAST(avg_order_value AS DOUBLE), 500.0::DOUBLE FROM kpis
  UNION ALL SELECT 'repeat_rate', CAST((SELECT {pct('sum(CAST(is_repeat_customer AS BIGINT))', 'count(*)')}
                                       FROM dim_customer) AS DOUBLE), 60.0::DOUBLE FROM kpis)""",
    ["gold_monthly_revenue", "gold_late_delivery_risk"], True, f"kpis AS ({KPI_BODY})")
ORACLE["risk_banding"] = with_gold(f"SELECT shipping_mode, late_pct, {band('late_pct')} AS risk_band "
                                   "FROM gold_shipping_efficiency", ["gold_shipping_efficiency"])
ORACLE["growth_direction"] = with_gold(f"""
SELECT order_year, order_month, total_revenue, mom_revenue_growth_pct,
       CASE WHEN mom_revenue_growth_pct IS NULL THEN NULL WHEN mom_revenue_growth_pct >= 0 THEN 'up' ELSE 'down' END
         AS direction,
       total_revenue >= 1000000.0 AS meets_target,
       {r2('total_revenue - 1000000.0')} AS target_gap
FROM gold_monthly_revenue""", ["gold_monthly_revenue"])


def topk(select_from: str, order: str, k: int) -> str:
    return (f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({select_from}) "
            f"ORDER BY {order} LIMIT {k}")


ORACLE["top_k"] = with_star(topk("SELECT order_item_id, order_id, sales FROM fact_sales",
                                 "sales DESC, order_item_id ASC", 10))
ORACLE["top_customers"] = with_star(topk(
    "SELECT customer_id, customer_fname, customer_lname, customer_segment, customer_country, "
    "customer_lifetime_value, avg_order_value, order_count, is_repeat_customer FROM dim_customer",
    "customer_lifetime_value DESC, customer_id ASC", 10))
ORACLE["top_products"] = with_gold(topk("SELECT * FROM gold_product_performance",
                                        "total_revenue DESC, product_card_id ASC", 10),
                                   ["gold_product_performance"])
ORACLE["top_markets"] = with_gold(topk("SELECT * FROM gold_market_performance",
                                       "total_revenue DESC, market ASC, order_region ASC, order_country ASC", 20),
                                  ["gold_market_performance"])
ORACLE["sorted_view"] = with_gold(
    "SELECT *, row_number() OVER (ORDER BY late_pct DESC, shipping_mode, delivery_status) AS position "
    "FROM gold_late_delivery_risk", ["gold_late_delivery_risk"])
ORACLE["year_filter"] = with_gold("SELECT * FROM gold_monthly_revenue WHERE order_year = 1997",
                                  ["gold_monthly_revenue"])
ORACLE["years"] = with_gold("SELECT DISTINCT CAST(order_year AS INTEGER) AS order_year FROM gold_monthly_revenue",
                            ["gold_monthly_revenue"])
ORACLE["nan_to_null"] = with_gold("SELECT * FROM gold_monthly_revenue", ["gold_monthly_revenue"])
ORACLE["name_concat"] = with_star(
    "SELECT customer_id, customer_fname || ' ' || customer_lname AS customer_name FROM dim_customer")
_ALL_TABLES = list(GOLD_CTES) + ["dim_customer", "dim_product", "dim_date", "dim_location", "dim_shipping",
                                 "fact_sales"]
ORACLE["available_tables"] = with_gold(
    "SELECT *, (SELECT strftime(max(l_shipdate), '%Y-%m-%dT%H:%M:%S') FROM lineitem) AS refreshed_at FROM ("
    + "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL_TABLES) + ")",
    list(GOLD_CTES), True)

# ---- Dashboard -----------------------------------------------------------------------
SLICE_CTE = """slice AS (
  SELECT * FROM denorm
  WHERE year IN (1996, 1997, 1998) AND market IN ('Asia', 'Europe', 'America')
    AND customer_segment IN ('Automobile', 'Building', 'Machinery')
    AND shipping_mode IN ('Standard Class', 'Second Class', 'First Class'))"""


def with_slice(final: str) -> str:
    return with_prefix(STAR_CTES, DENORM_CTE, SLICE_CTE, final)


ORACLE["dashboard_slice"] = with_slice(
    "SELECT order_item_id, year, market, customer_segment, shipping_mode, sales FROM slice")
ORACLE["distinct_values"] = with_prefix(STAR_CTES, DENORM_CTE, """
SELECT DISTINCT 'year' AS filter, CAST(year AS VARCHAR) AS value FROM denorm WHERE year IS NOT NULL
UNION SELECT DISTINCT 'market', market FROM denorm WHERE market IS NOT NULL
UNION SELECT DISTINCT 'customer_segment', customer_segment FROM denorm WHERE customer_segment IS NOT NULL
UNION SELECT DISTINCT 'shipping_mode', shipping_mode FROM denorm WHERE shipping_mode IS NOT NULL""")


def with_denorm(final: str) -> str:
    return with_prefix(STAR_CTES, DENORM_CTE, final)


ORACLE["dash_kpis"] = with_denorm(f"""
SELECT CAST(coalesce(sum(sales), 0) AS DOUBLE) AS total_revenue,
       count(DISTINCT order_id) AS total_orders,
       CASE WHEN count(DISTINCT order_id) > 0 THEN {half_away('sum(sales)', 'count(DISTINCT order_id)')} ELSE 0.0 END
         AS avg_order_value,
       CAST(coalesce(sum(order_profit_per_order), 0) AS DOUBLE) AS total_profit,
       CASE WHEN count(*) > 0 THEN {pct('sum(CAST(is_late AS BIGINT))', 'count(*)')} ELSE 0.0 END AS late_pct,
       count(DISTINCT customer_id) AS total_customers
FROM denorm""")
ORACLE["dash_monthly"] = with_denorm("""
SELECT *, concat_ws(' ', month_name, CAST(year AS VARCHAR)) AS period,
       (revenue / nullif(lag(revenue) OVER (ORDER BY year, month), 0.0) - 1) * 100 AS mom_growth
FROM (SELECT year, month, month_name, CAST(sum(sales) AS DOUBLE) AS revenue,
             CAST(sum(order_profit_per_order) AS DOUBLE) AS profit, count(DISTINCT order_id) AS orders
      FROM denorm GROUP BY year, month, month_name)""")
ORACLE["dash_market"] = with_denorm("""
SELECT market, CAST(sum(sales) AS DOUBLE) AS revenue, count(DISTINCT order_id) AS orders
FROM denorm GROUP BY market""")
ORACLE["dash_late_by_mode"] = with_denorm(f"""
SELECT *, {pct('late', 'total')} AS late_pct FROM (
  SELECT shipping_mode, count(order_item_id) AS total, sum(CAST(is_late AS BIGINT)) AS late
  FROM denorm GROUP BY shipping_mode)""")
ORACLE["dash_category"] = with_denorm("""
SELECT category_name, department_name, CAST(sum(sales) AS DOUBLE) AS revenue FROM denorm
GROUP BY category_name, department_name
ORDER BY revenue DESC, category_name, department_name LIMIT 15""")
ORACLE["dash_top_products"] = with_denorm("""
SELECT product_name, category_name, CAST(sum(sales) AS DOUBLE) AS revenue,
       CAST(sum(order_item_quantity) AS BIGINT) AS units FROM denorm
GROUP BY product_name, category_name
ORDER BY revenue DESC, product_name, category_name LIMIT 10""")
ORACLE["dash_status_counts"] = with_denorm("""
SELECT delivery_status AS status, count(*) AS count FROM denorm WHERE delivery_status IS NOT NULL
GROUP BY delivery_status""")
ORACLE["dash_segment"] = with_denorm("""
SELECT customer_segment, CAST(sum(sales) AS DOUBLE) AS revenue, count(DISTINCT customer_id) AS customers
FROM denorm GROUP BY customer_segment""")
ORACLE["dash_geo"] = with_denorm("""
SELECT order_country, latitude, longitude, CAST(sum(sales) AS DOUBLE) AS revenue,
       count(DISTINCT order_id) AS orders
FROM denorm GROUP BY order_country, latitude, longitude""")
_W = repr(400.0 / 60)
ORACLE["margin_histogram"] = with_star(f"""
SELECT bin, CASE WHEN bin > 0 THEN CAST(-200.0 AS DOUBLE) + (bin - 1) * CAST({_W} AS DOUBLE) END AS bin_start,
       CASE WHEN bin = 0 THEN CAST(-200.0 AS DOUBLE) WHEN bin <= 60 THEN CAST(-200.0 AS DOUBLE) + bin * CAST({_W} AS DOUBLE) END AS bin_end,
       count(*) AS count
FROM (SELECT CASE WHEN m < -200 THEN 0 WHEN m > 200 THEN 61 WHEN m = 200 THEN 60
             ELSE CAST(floor((m + CAST(200.0 AS DOUBLE)) * 60 / CAST(400.0 AS DOUBLE)) AS INTEGER) + 1 END AS bin
      FROM (SELECT profit_margin_pct AS m FROM fact_sales)) GROUP BY bin""")
ORACLE["delay_histogram"] = with_star("""
SELECT CASE WHEN d BETWEEN -10 AND 10 THEN 'in range' WHEN d < -10 THEN 'below' WHEN d > 10 THEN 'above' ELSE 'none' END AS position,
       CASE WHEN d BETWEEN -10 AND 10 THEN d END AS delivery_delay_days, is_late, count(*) AS count
FROM (SELECT delivery_delay_days AS d, is_late FROM fact_sales) GROUP BY ALL""")


# ---- Validation --------------------------------------------------------------------
def _miss_row(c: str) -> str:
    return (f"SELECT 'missing_values' AS \"check\", '{c}' AS \"column\", count(*) - count({qi(c)}) AS count, "
            f"{pct('count(*) - count(' + qi(c) + ')', 'count(*)')} AS pct FROM raw HAVING count(*) - count({qi(c)}) > 0")


_VALID = "('Advance shipping', 'Late delivery', 'Shipping on time', 'Shipping canceled')"
REPORT_BODY = "\nUNION ALL\n".join([_miss_row(c) for c in RAW_COLUMNS] + [
    """SELECT 'duplicates', 'Order Item Id', count(*) - count(DISTINCT "Order Item Id")
       - max(CASE WHEN "Order Item Id" IS NULL THEN 1 ELSE 0 END), 0.0 FROM raw""",
    """SELECT 'negative_price', 'Product Price', count(*) FILTER (WHERE TRY_CAST("Product Price" AS DOUBLE) < 0), 0.0 FROM raw""",
    """SELECT 'negative_sales', 'Sales', count(*) FILTER (WHERE TRY_CAST("Sales" AS DOUBLE) < 0), 0.0 FROM raw""",
    """SELECT 'invalid_date', 'order date (DateOrders)',
       count(*) FILTER (WHERE try_strptime("order date (DateOrders)", '%m/%d/%Y %H:%M') IS NULL), 0.0 FROM raw""",
    """SELECT 'invalid_date', 'shipping date (DateOrders)',
       count(*) FILTER (WHERE try_strptime("shipping date (DateOrders)", '%m/%d/%Y %H:%M') IS NULL), 0.0 FROM raw""",
    """SELECT 'null_customer_id', 'Customer Id', count(*) FILTER (WHERE "Customer Id" IS NULL), 0.0 FROM raw""",
    f"""SELECT 'unknown_delivery_status', 'Delivery Status',
       count(*) FILTER (WHERE NOT coalesce("Delivery Status" IN {_VALID}, FALSE)), 0.0 FROM raw""",
])
REPORT_CTE = f"report AS ({REPORT_BODY})"
ORACLE["issue_report"] = with_prefix(REPORT_CTE, "SELECT * FROM report")
for _c in ["missing_values", "duplicates", "negative_price", "negative_sales", "invalid_date",
           "null_customer_id", "unknown_delivery_status"]:
    ORACLE[_c] = with_prefix(REPORT_CTE, f"SELECT * FROM report WHERE \"check\" = '{_c}'")
ORACLE["total_issues"] = with_prefix(REPORT_CTE,
                                     "SELECT CAST(coalesce(sum(count), 0) AS BIGINT) AS total_issues FROM report")

# ---- Cleaning steps ----------------------------------------------------------------
from tidemark.checks.oracle_base import KEYS, MEASURES, SILVER_DROPPED, TITLED, _title, _typed_expr, snake  # noqa: E402

_DROP = ["Customer Password", "Product Description", "Product Image", "Customer Email", "Customer Street"]
ORACLE["drop_columns"] = with_prefix("SELECT * EXCLUDE (" + ", ".join(qi(c) for c in _DROP) + ") FROM raw")
ORACLE["snake_case_header"] = with_prefix(
    "SELECT " + ", ".join(f"{qi(c)} AS {qi(snake(c))}" for c in RAW_COLUMNS) + ", _row_number FROM raw")
# The raw names that the rename map doesn't list.
_UNMAPPED = ["Customer Email", "Customer Password", "Customer Street", "Order Customer Id", "Order Item Cardprod Id",
             "Order Item Discount Rate", "Order Item Profit Ratio", "Product Category Id", "Product Description", "Product Image",
             "Sales per customer", "order date (DateOrders)", "shipping date (DateOrders)"]
ORACLE["rename_map"] = with_prefix(
    "SELECT " + ", ".join(f"{qi(c)} AS {qi(c if c in _UNMAPPED else snake(c))}" for c in RAW_COLUMNS) + ", _row_number FROM raw")
ORACLE["numeric_coerce"] = with_prefix(
    "SELECT _row_number, " + ", ".join(f"{_typed_expr(c)} AS {snake(c)}" for c in MEASURES) + " FROM raw")
ORACLE["id_coerce"] = with_prefix(
    "SELECT _row_number, " + ", ".join(f"{_typed_expr(c)} AS {snake(c)}" for c in KEYS) + " FROM raw")
ORACLE["date_parse"] = with_prefix("SELECT _row_number, order_date, ship_date FROM typed")
ORACLE["drop_bad_dates"] = with_prefix(
    "SELECT count(*) AS rows_before, count(*) FILTER (WHERE order_date IS NOT NULL) AS rows_after FROM typed")
ORACLE["dedup_keep_first"] = with_prefix("SELECT order_item_id, _row_number, _row_hash FROM dedup")
ORACLE["null_fill"] = with_prefix(
    "SELECT order_item_id, customer_lname, customer_zipcode, order_zipcode FROM filled")
ORACLE["string_normalise"] = with_prefix("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, raw_value, {_title(chr(114) + 'egexp_replace(raw_value, ' + chr(39) + '^' + chr(92) + 's+|' + chr(92) + 's+$' + chr(39) + ', ' + chr(39) + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')} AS normalised "
    f"FROM (SELECT DISTINCT {qi(c)} AS raw_value FROM raw)" for c in TITLED))
ORACLE["percentile_trim"] = with_prefix("""
SELECT floor(_lo * 1e6 + 0.5) / 1e6 AS lo, floor(_hi * 1e6 + 0.5) / 1e6 AS hi, (SELECT count(*) FROM titled) AS rows_in, (SELECT count(*) FROM silver) AS rows_kept
FROM bounds""")
_SILVER_COLS = ([snake(c) for c in RAW_COLUMNS if c not in SILVER_DROPPED]
                + ["order_date", "ship_date", "_row_number", "_row_hash", "_silver_processed"])
ORACLE["audit_flag"] = with_prefix(
    "SELECT count(*) AS rows, CAST(" + " + ".join(f"(count(*) - count({c}))" for c in _SILVER_COLS)
    + " AS BIGINT) AS null_cells, bool_and(_silver_processed) AS all_processed FROM silver")

# ---- Features ------------------------------------------------------------------------
for _key, _cols in {"time_parts": ["order_year", "order_month", "order_quarter", "order_month_name"],
                    "delivery_delay": ["delivery_delay_days"], "is_late": ["is_late"],
                    "profit_margin": ["profit_margin_pct"], "discount_pct": ["discount_pct"],
                    "revenue_per_item": ["revenue_per_item"],
                    "delivery_days_actual": ["delivery_days_actual"]}.items():
    ORACLE[_key] = with_prefix(f"SELECT order_item_id, {', '.join(_cols)} FROM prep")
ORACLE["customer_metrics"] = with_prefix("""
SELECT customer_id, CAST(_clv AS DOUBLE) AS customer_lifetime_value,
       CAST(_clv AS DOUBLE) / nullif(CAST(_n AS DOUBLE), 0.0) AS avg_order_value,
       order_count, order_count > 1 AS is_repeat_customer
FROM (SELECT customer_id, sum(sales) AS _clv, count(sales) AS _n, count(DISTINCT order_id) AS order_count
      FROM prep WHERE customer_id IS NOT NULL GROUP BY customer_id)""")

# ---- Set operations ------------------------------------------------------------------
ORACLE["distinct_rows"] = with_prefix(
    "SELECT DISTINCT order_city, order_state, order_country, order_region, market, latitude, longitude FROM prep")
ORACLE["union_rerun"] = with_prefix("SELECT * EXCLUDE (_row_digest, _ingest) FROM silver", prefix=RERUN_PREFIX)

ORACLE["load_rejects"] = with_star("""
WITH broken AS (SELECT order_item_id AS item, 0 AS copy, customer_id, date_id, shipping_id,
    CASE WHEN order_item_id % 97 = 0 THEN -product_card_id ELSE product_card_id END AS product_card_id,
    CASE WHEN order_item_id % 101 = 0 THEN NULL ELSE location_id END AS location_id FROM fact_sales),
faulty AS (SELECT *, CASE WHEN item % 89 = 0 THEN NULL ELSE item END AS order_item_id FROM (
    SELECT * FROM broken UNION ALL SELECT * REPLACE (1 AS copy, -1 AS customer_id) FROM broken WHERE item % 83 = 0))
SELECT item, copy, order_item_id, product_card_id, customer_id, concat_ws(',',
    CASE WHEN order_item_id IS NOT NULL AND copy = 1 THEN 'duplicate_key' END,
    CASE WHEN order_item_id IS NULL THEN 'null_key' END,
    CASE WHEN customer_id NOT IN (SELECT customer_id FROM dim_customer) THEN 'orphan:customer_id' END,
    CASE WHEN date_id NOT IN (SELECT date_id FROM dim_date) THEN 'orphan:date_id' END,
    CASE WHEN location_id NOT IN (SELECT location_id FROM dim_location) THEN 'orphan:location_id' END,
    CASE WHEN product_card_id NOT IN (SELECT product_card_id FROM dim_product) THEN 'orphan:product_card_id' END,
    CASE WHEN shipping_id NOT IN (SELECT shipping_id FROM dim_shipping) THEN 'orphan:shipping_id' END) AS reasons
FROM faulty""")
ORACLE["mergeable_distinct"] = with_denorm("""
SELECT 'order_id' AS what, year, month, count(DISTINCT order_id) AS n FROM denorm GROUP BY ROLLUP (year, month)
UNION ALL
SELECT 'customer_id', year, month, count(DISTINCT customer_id) FROM denorm GROUP BY ROLLUP (year, month)""")


# ---- The daily job: two landings ------------------------------------------------------
ORACLE["incremental_silver"] = ORACLE["union_rerun"]
ORACLE["incremental_bounds"] = with_prefix(
    """first_bounds AS (
  SELECT quantile_cont(CAST(sales AS DOUBLE), 0.01) AS _lo, quantile_cont(CAST(sales AS DOUBLE), 0.99) AS _hi
  FROM titled WHERE _ingest = 1)""",
    """SELECT 1 AS landing, floor(_lo * 1e6 + 0.5) / 1e6 AS lo, floor(_hi * 1e6 + 0.5) / 1e6 AS hi,
       (SELECT count(*) FROM titled WHERE _ingest = 1 AND CAST(sales AS DOUBLE) BETWEEN _lo AND _hi) AS rows_kept FROM first_bounds
UNION ALL
SELECT 2, floor(_lo * 1e6 + 0.5) / 1e6, floor(_hi * 1e6 + 0.5) / 1e6, (SELECT count(*) FROM silver) FROM bounds""", prefix=RERUN_PREFIX)
for _table, _cte in GOLD_CTES.items():
    ORACLE[_table.replace("gold_", "incremental_")] = with_prefix(_cte, f"SELECT * FROM {_table}", prefix=RERUN_PREFIX)


def _stable(name: str, id_col: str, natural: list[str], table: str = "cleaned") -> str:
    """Natural keys with the landing that brought them; ids go by landing, then by natural key."""
    return (f"{name} AS (SELECT row_number() OVER (ORDER BY _ingest, {_nl(natural)}) AS {id_col}, * FROM ("
            f"SELECT {', '.join(natural)}, min(_ingest) AS _ingest FROM {table} GROUP BY {', '.join(natural)}))")


_STABLE_CTES = ("cleaned AS (SELECT *, CAST(order_date AS DATE) AS full_date FROM titled)",
                _stable("dim_date", "date_id", ["full_date"]), _stable("dim_location", "location_id", _LOC7),
                _stable("dim_shipping", "shipping_id", ["shipping_mode", "delivery_status"]))
ORACLE["stable_keys"] = with_prefix(*_STABLE_CTES, """
SELECT 'dim_date' AS dimension, date_id AS id, CAST(full_date AS VARCHAR) AS natural_key FROM dim_date
UNION ALL
SELECT 'dim_location', location_id, concat_ws('|', order_city, order_state, order_country, order_region, market,
  CAST(CAST(latitude AS DECIMAL(10,2)) AS VARCHAR), CAST(CAST(longitude AS DECIMAL(10,2)) AS VARCHAR)) FROM dim_location
UNION ALL
SELECT 'dim_shipping', shipping_id, concat_ws('|', shipping_mode, delivery_status) FROM dim_shipping""", prefix=RERUN_PREFIX)
# a fact takes the highest id that its five location columns have by its own landing
ORACLE["incremental_fact_keys"] = with_prefix(*_STABLE_CTES, f"""
places AS (SELECT _n, {", ".join(_LOC5)}, max(location_id) AS location_id FROM dim_location, (VALUES (1), (2)) v(_n)
  WHERE _ingest <= _n GROUP BY _n, {", ".join(_LOC5)})""", f"""
SELECT s.order_item_id, d.date_id, l.location_id, m.shipping_id FROM silver s
JOIN dim_date d ON CAST(s.order_date AS DATE) = d.full_date
LEFT JOIN places l ON l._n = s._ingest AND {_nse('s', 'l', _LOC5)}
LEFT JOIN dim_shipping m ON {_nse('s', 'm', ['shipping_mode', 'delivery_status'])}""", prefix=RERUN_PREFIX)


# ---- Sources and sinks ---------------------------------------------------------------
_RAW_SELECT = "SELECT " + ", ".join(qi(c) for c in RAW_COLUMNS) + " FROM raw"
ORACLE["csv_scan"] = with_prefix(_RAW_SELECT)
ORACLE["incremental_bronze"] = with_prefix(_RAW_SELECT)
ORACLE["dense_row_number"] = with_prefix("""
SELECT CAST("Order Item Id" AS BIGINT) AS order_item_id, _row_hash,
       row_number() OVER (ORDER BY CAST("Order Item Id" AS BIGINT), _row_digest) AS _row_number FROM bronze""")
ORACLE["csv_sink"] = with_gold("SELECT * FROM gold_product_performance", ["gold_product_performance"])
ORACLE["gold_export"] = with_gold("SELECT * FROM gold_late_delivery_risk", ["gold_late_delivery_risk"])
_LOAD = ["dim_customer", "dim_product", "dim_date", "dim_location", "dim_shipping", "fact_sales"]
# The DDL of the loaded tables.
_ID, _MONEY = "bigint", "decimal(12,2)"
_DDL = {
    "dim_customer": {"customer_id": _ID, "customer_fname": "string", "customer_lname": "string", "customer_segment": "string",
                     "customer_city": "string", "customer_state": "string", "customer_country": "string",
                     "customer_zipcode": "string", "customer_lifetime_value": _MONEY, "avg_order_value": _MONEY,
                     "order_count": _ID, "is_repeat_customer": "boolean"},
    "dim_product": {"product_card_id": _ID, "product_name": "string", "product_price": "decimal(10,2)", "category_id": _ID,
                    "category_name": "string", "department_id": _ID, "department_name": "string", "product_status": "int"},
    "dim_date": {"date_id": _ID, "full_date": "date", "year": "int", "quarter": "int", "month": "int", "month_name": "string",
                 "day": "int", "day_of_week": "string", "week_of_year": "int"},
    "dim_location": {"location_id": _ID, "order_city": "string", "order_state": "string", "order_country": "string",
                     "order_region": "string", "market": "string", "latitude": "decimal(10,6)", "longitude": "decimal(10,6)"},
    "dim_shipping": {"shipping_id": _ID, "shipping_mode": "string", "delivery_status": "string"},
    "fact_sales": {"order_item_id": _ID, "order_id": _ID, "customer_id": _ID, "product_card_id": _ID, "date_id": _ID,
                   "location_id": _ID, "shipping_id": _ID, "order_item_quantity": _ID, "sales": _MONEY,
                   "order_item_discount": "decimal(10,2)", "order_profit_per_order": _MONEY, "benefit_per_order": _MONEY,
                   "order_item_product_price": "decimal(10,2)", "order_item_total": _MONEY, "delivery_days_actual": "int",
                   "delivery_delay_days": "int", "is_late": "boolean", "profit_margin_pct": "decimal(8,2)",
                   "discount_pct": "decimal(8,2)", "revenue_per_item": "decimal(10,2)", "order_status": "string", "type": "string"},
}


def _loaded(table: str, position: int, column: str, kind: str) -> str:
    value = {"string": f"length(CAST({column} AS VARCHAR))", "date": f"date_diff('day', DATE '1970-01-01', {column})",
             "boolean": f"CAST({column} AS INTEGER)"}.get(
                 kind, f"CAST({r2(column) if kind.endswith(',2)') else column} AS {kind})")
    return (f"SELECT '{table}' AS table_name, {position} AS load_position, '{column}' AS column_name, '{kind}' AS data_type, "
            f"count(*) AS row_count, count({column}) AS non_null, "
            f"CAST(coalesce(sum(CAST({value} AS DECIMAL(28,6))), 0) AS DOUBLE) AS value_sum FROM {table}")


ORACLE["star_load"] = with_star("\nUNION ALL\n".join(
    _loaded(t, i, c, k) for i, t in enumerate(_LOAD, start=1) for c, k in _DDL[t].items()))
ORACLE["run_metrics"] = with_gold("\nUNION ALL\n".join(
    ["SELECT 'extract' AS stage, 'rows' AS metric, count(*) AS value FROM raw",
     "SELECT 'validate', 'total_issues', CAST(coalesce(sum(count), 0) AS BIGINT) FROM report",
     "SELECT 'bronze', 'rows', count(*) FROM bronze",
     "SELECT 'silver', 'rows', count(*) FROM silver"]
    + [f"SELECT 'gold', '{t}', count(*) FROM {t}" for t in list(GOLD_CTES) + _LOAD]),
    list(GOLD_CTES), True, REPORT_CTE)
