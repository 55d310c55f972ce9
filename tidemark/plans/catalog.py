"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator id.

Each reads the driver tables through the medallion layers (written once per session)
and returns a lazy DataFrame.  Keys follow the operator ids' words in SURVEY §2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import layers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# kept in Silver for "first seen", left out of what queries show
ORDER_COLUMNS = ["_ingestion_ts", "_source_file", "_file_block", "_row_digest"]


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: layers.gold(spark, sf_dir, name)


# ---- Gold KPI tables (A1-A6) --------------------------------------------------------
for _key, _table in [("monthly_revenue", "gold_monthly_revenue"),
                     ("market_performance", "gold_market_performance"),
                     ("product_performance", "gold_product_performance"),
                     ("customer_segments", "gold_customer_segments"),
                     ("late_delivery_risk", "gold_late_delivery_risk"),
                     ("shipping_efficiency", "gold_shipping_efficiency")]:
    QUERIES[_key] = _gold(_table)


@register("silver")
def silver(spark, sf_dir):
    """The Silver table as written, without the columns that only order rows."""
    return layers.silver(spark, sf_dir).drop(*ORDER_COLUMNS)


@register("bronze_ingest")
def bronze_ingest(spark, sf_dir):
    """Bronze rows (raw text + row number + hash); run-specific stamps left out."""
    return layers.bronze(spark, sf_dir).drop(*ORDER_COLUMNS, "_row_uid", "_ingest_date")


@register("row_hash")
def row_hash(spark, sf_dir):
    """S3."""
    return layers.bronze(spark, sf_dir).select(F.col("`Order Item Id`").alias("order_item_id"),
                                               "_row_number", "_row_hash")


@register("bronze_stats")
def bronze_stats(spark, sf_dir):
    """S5."""
    from tidemark.operators.bronze import bronze_stats as stats
    return stats(layers.bronze(spark, sf_dir))


# ---- Star schema (D1-D7), integrity (S10, J8), joins (J1-J7), surrogate keys (W8) ---
def _star(name: str) -> Query:
    return lambda spark, sf_dir: layers.star(spark, sf_dir, name)


for _name in layers.STAR_TABLES:
    QUERIES[_name] = _star(_name)

# The legacy fact table's columns.
LEGACY_FACT_COLUMNS = [
    "order_item_id", "order_id", "customer_id", "product_card_id", "date_id", "location_id",
    "shipping_id", "order_item_quantity", "sales", "order_item_discount", "order_profit_per_order",
    "benefit_per_order", "order_item_product_price", "order_item_total", "delivery_days_actual",
    "delivery_delay_days", "is_late", "profit_margin_pct", "discount_pct", "revenue_per_item",
    "order_status", "type",
]


@register("legacy_fact_sales")
def legacy_fact_sales(spark, sf_dir):
    """The legacy 22-column fact is a projection of the one fact table."""
    return layers.star(spark, sf_dir, "fact_sales").select(*LEGACY_FACT_COLUMNS)


@register("fk_check")
def fk_check(spark, sf_dir):
    """Orphans per FK and duplicate / NULL keys per PK (all 0 when healthy)."""
    from tidemark.operators.star import fk_check as check
    return check(layers.star_tables(spark, sf_dir))


@register("integrity_anti_join")
def integrity_anti_join(spark, sf_dir):
    """The orphan fact rows themselves, one ``left_anti`` per FK."""
    from tidemark.schemas import FOREIGN_KEYS
    t = layers.star_tables(spark, sf_dir)
    fact = t["fact_sales"].select("order_item_id", *[fk for fk, _, _ in FOREIGN_KEYS])
    out = None
    for fk, dim, pk in FOREIGN_KEYS:
        o = (fact.filter(F.col(fk).isNotNull())
             .join(t[dim].select(F.col(pk).alias(fk)), fk, "left_anti")
             .select(F.lit(fk).alias("foreign_key"), "order_item_id", F.col(fk).cast("bigint").alias("key_value")))
        out = o if out is None else out.unionByName(o)
    return out


def faulty_fact(fact: DataFrame) -> DataFrame:
    """The fact with broken keys at fixed items: orphans, NULL keys, NULL references and changed copies (``_copy`` 1)."""
    at = lambda n: F.col("order_item_id") % n == 0
    broken = fact.withColumns({
        "_copy": F.lit(0), "product_card_id": F.when(at(97), -F.col("product_card_id")).otherwise(F.col("product_card_id")),
        "location_id": F.when(at(101), F.lit(None)).otherwise(F.col("location_id"))})
    copies = broken.filter(at(83)).withColumns({"_copy": F.lit(1), "customer_id": F.lit(-1).cast("bigint")})
    return (broken.unionByName(copies).withColumn("_item", F.col("order_item_id"))
            .withColumn("order_item_id", F.when(at(89), F.lit(None)).otherwise(F.col("order_item_id"))))


@register("load_rejects")
def load_rejects(spark, sf_dir):
    """S10/J8 enforced: rows of a faulty load that are refused, with the reasons, and those that load (no reason)."""
    from tidemark.operators.constraints import REASONS, split_load
    path = layers.output(spark, sf_dir, "rejects", lambda path: None)
    t = layers.star_tables(spark, sf_dir)
    accepted, rejected = split_load(faulty_fact(t["fact_sales"]), t, ["_copy"], path)
    columns = ["_item", "_copy", "order_item_id", "product_card_id", "customer_id"]
    return accepted.select(*columns, F.lit("").alias("reasons")).unionByName(
        rejected.select(*columns, F.concat_ws(",", REASONS).alias("reasons"))).withColumnsRenamed({"_item": "item", "_copy": "copy"})


def _fact_join(dim: str, key: str, cols: list[str]) -> Query:
    def q(spark, sf_dir):
        f = layers.star(spark, sf_dir, "fact_sales").select("order_item_id", key)
        d = layers.star(spark, sf_dir, dim).select(key, *cols)
        return f.join(F.broadcast(d) if dim == "dim_shipping" else d, key).select("order_item_id", key, *cols)
    return q


QUERIES["fact_date_join"] = _fact_join("dim_date", "date_id", ["full_date", "year", "month"])  # J1
QUERIES["fact_location_join"] = _fact_join("dim_location", "location_id",
                                           ["order_city", "order_country", "market"])  # J2
QUERIES["fact_product_join"] = _fact_join("dim_product", "product_card_id",
                                          ["product_name", "category_name", "department_name"])  # J3
QUERIES["fact_shipping_join"] = _fact_join("dim_shipping", "shipping_id",
                                           ["shipping_mode", "delivery_status"])  # J4


@register("star_denormalise")
def star_denormalise(spark, sf_dir):
    """The fact left-joined to all five dimensions, columns chosen explicitly."""
    from tidemark.operators.dashboard import denormalised
    return denormalised(layers.star_tables(spark, sf_dir))


@register("customer_agg_join")
def customer_agg_join(spark, sf_dir):
    """Every row with its customer's CLV, AOV, order count, repeat flag."""
    from tidemark.operators.features import with_customer_metrics
    return (with_customer_metrics(layers.prep(spark, sf_dir))
            .select("order_item_id", "customer_id",
                    F.col("customer_lifetime_value").cast("double").alias("customer_lifetime_value"),
                    "avg_order_value", "order_count", "is_repeat_customer"))


@register("surrogate_key_lookup")
def surrogate_key_lookup(spark, sf_dir):
    """The three looked-up ids per fact row."""
    return layers.star(spark, sf_dir, "fact_sales").select("order_item_id", "date_id", "location_id", "shipping_id")


@register("surrogate_keys")
def surrogate_keys(spark, sf_dir):
    """Dense ids over the sorted natural keys of the three sequence-keyed dimensions."""
    return _natural_keys(*(layers.star(spark, sf_dir, d) for d in ("dim_date", "dim_location", "dim_shipping")))


def _natural_keys(dates: DataFrame, locations: DataFrame, shipping: DataFrame) -> DataFrame:
    d = dates.select(F.lit("dim_date").alias("dimension"), F.col("date_id").alias("id"),
                     F.col("full_date").cast("string").alias("natural_key"))
    loc = locations.select(
        F.lit("dim_location").alias("dimension"), F.col("location_id").alias("id"),
        F.concat_ws("|", "order_city", "order_state", "order_country", "order_region", "market",
                    F.col("latitude").cast("decimal(10,2)").cast("string"),
                    F.col("longitude").cast("decimal(10,2)").cast("string")).alias("natural_key"))
    s = shipping.select(F.lit("dim_shipping").alias("dimension"), F.col("shipping_id").alias("id"),
                        F.concat_ws("|", "shipping_mode", "delivery_status").alias("natural_key"))
    return d.unionByName(loc).unionByName(s)


# ---- Query layer over the star (A7-A14, W1, W3, T2) ---------------------------------
def _analysis(name: str) -> Query:
    def q(spark, sf_dir):
        from tidemark.plans.sql_analytics import ANALYSES, READS
        return ANALYSES[name](layers.star_tables(spark, sf_dir, READS[name]))
    return q


for _name in ["sql_monthly_trend", "sql_market_region", "sql_top_products", "sql_top_customers",
              "sql_late_delivery", "category_rank", "sql_retention", "sql_mom_growth",
              "sql_shipping_efficiency", "sql_top_countries"]:
    QUERIES[_name] = _analysis(_name)


@register("daily_sales_summary")
def daily_sales_summary(spark, sf_dir):
    """The view, created as a temp view and read back."""
    _analysis("daily_sales_summary")(spark, sf_dir).createOrReplaceTempView("daily_sales_summary")
    return spark.table("daily_sales_summary")


# ---- Metrics over Gold (A15-A17, A28-A30, W2, W4-W7, T1-T5, P15-P18, S12) ----------
from tidemark.operators import metrics as M  # noqa: E402


def _g(spark, sf_dir, name):
    return layers.gold(spark, sf_dir, name)


@register("kpi_summary")
def kpi_summary(spark, sf_dir):
    """A15."""
    return M.kpi_summary(_g(spark, sf_dir, "gold_monthly_revenue"), _g(spark, sf_dir, "gold_late_delivery_risk"),
                         layers.star(spark, sf_dir, "dim_customer"))


@register("market_rollup")
def market_rollup(spark, sf_dir):
    """A16."""
    return M.market_rollup(_g(spark, sf_dir, "gold_market_performance"))


@register("category_rollup")
def category_rollup(spark, sf_dir):
    """A17."""
    return M.category_rollup(_g(spark, sf_dir, "gold_product_performance"))


@register("mode_risk_rollup")
def mode_risk_rollup(spark, sf_dir):
    """A28 (+W6 band)."""
    return M.mode_risk_rollup(_g(spark, sf_dir, "gold_late_delivery_risk"))


@register("status_share")
def status_share(spark, sf_dir):
    """A29."""
    return M.status_share(_g(spark, sf_dir, "gold_late_delivery_risk"))


@register("segment_profile")
def segment_profile(spark, sf_dir):
    """A30."""
    return M.segment_profile(_g(spark, sf_dir, "gold_customer_segments"))


@register("mom_growth")
def mom_growth(spark, sf_dir):
    """The Gold growth column (pct change of the rounded monthly revenue)."""
    return _g(spark, sf_dir, "gold_monthly_revenue").select("order_year", "order_month", "total_revenue",
                                                            "mom_revenue_growth_pct")


@register("anomalies")
def anomalies(spark, sf_dir):
    """W4."""
    return M.anomalies(_g(spark, sf_dir, "gold_monthly_revenue"))


@register("kpi_vs_target")
def kpi_vs_target(spark, sf_dir):
    """Late %, margin, AOV and repeat rate against the four targets."""
    from tidemark.functions.numeric import pct
    dc = layers.star(spark, sf_dir, "dim_customer")
    repeat = dc.agg(pct(F.sum(F.col("is_repeat_customer").cast("bigint")), F.count(F.lit(1)))).scalar()
    return M.kpi_vs_target(kpi_summary(spark, sf_dir), repeat)


@register("risk_banding")
def risk_banding(spark, sf_dir):
    """W6 over A6."""
    return M.shipping_risk_bands(_g(spark, sf_dir, "gold_shipping_efficiency"))


@register("growth_direction")
def growth_direction(spark, sf_dir):
    """W7."""
    return M.growth_direction(_g(spark, sf_dir, "gold_monthly_revenue"))


@register("top_k")
def top_k(spark, sf_dir):
    """T1 over the fact: the 10 largest order items by sales (distributed top-k)."""
    f = layers.star(spark, sf_dir, "fact_sales").select("order_item_id", "order_id", "sales")
    return M.top_k(f, 10, [F.desc("sales"), F.asc("order_item_id")])


@register("top_customers")
def top_customers(spark, sf_dir):
    """T2 (API form): 9 columns of the top 10 customers by CLV."""
    cols = ["customer_id", "customer_fname", "customer_lname", "customer_segment", "customer_country",
            "customer_lifetime_value", "avg_order_value", "order_count", "is_repeat_customer"]
    dc = layers.star(spark, sf_dir, "dim_customer").select(*cols)
    return M.top_k(dc, 10, [F.desc("customer_lifetime_value"), F.asc("customer_id")])


@register("top_products")
def top_products(spark, sf_dir):
    """Top 10 of A3."""
    return M.top_k(_g(spark, sf_dir, "gold_product_performance"), 10,
                   [F.desc("total_revenue"), F.asc("product_card_id")])


@register("top_markets")
def top_markets(spark, sf_dir):
    """T4: top 20 of A2."""
    return M.top_k(_g(spark, sf_dir, "gold_market_performance"), 20,
                   [F.desc("total_revenue"), F.asc("market"), F.asc("order_region"), F.asc("order_country")])


@register("sorted_view")
def sorted_view(spark, sf_dir):
    """T5: A5 by late % descending, numbered."""
    from pyspark.sql import Window
    r = _g(spark, sf_dir, "gold_late_delivery_risk")
    w = Window.orderBy(F.desc("late_pct"), "shipping_mode", "delivery_status")
    return r.withColumn("position", F.row_number().over(w)).orderBy("position")


@register("year_filter")
def year_filter(spark, sf_dir):
    """P15 (year = 1997)."""
    return M.year_filter(_g(spark, sf_dir, "gold_monthly_revenue"), 1997)


@register("years")
def years(spark, sf_dir):
    """P16."""
    return M.years(_g(spark, sf_dir, "gold_monthly_revenue"))


@register("nan_to_null")
def nan_to_null(spark, sf_dir):
    """P17 over the monthly table."""
    return M.json_safe(_g(spark, sf_dir, "gold_monthly_revenue"))


@register("name_concat")
def name_concat(spark, sf_dir):
    """P18."""
    return M.customer_names(layers.star(spark, sf_dir, "dim_customer"))


@register("available_tables")
def available_tables(spark, sf_dir):
    """The Gold and star tables with their row counts and the ingestion time they reflect."""
    refreshed = layers.bronze(spark, sf_dir).agg(F.max("_ingestion_ts")).scalar()
    out = None
    for n in layers.GOLD_TABLES + layers.STAR_TABLES:
        df = layers.gold(spark, sf_dir, n) if n in layers.GOLD_TABLES else layers.star(spark, sf_dir, n)
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out.withColumn("refreshed_at", refreshed)


# ---- Dashboard over the denormalised star (P13, P14, A18-A27, T3 dashboard form) ---
from tidemark.operators import dashboard as D  # noqa: E402

DASH_SLICE = D.Slice(years=[1996, 1997, 1998], markets=["Asia", "Europe", "America"],
                     segments=["Automobile", "Building", "Machinery"],
                     modes=["Standard Class", "Second Class", "First Class"])


@register("dashboard_slice")
def dashboard_slice(spark, sf_dir):
    """The one query that slices; it joins the dimensions of the four filter columns and reads the folders of
    the selected years."""
    dims = ["dim_date", "dim_customer", "dim_location", "dim_shipping"]
    tables = {**layers.star_tables(spark, sf_dir, dims), "fact_sales": layers.fact_by_year(spark, sf_dir)}
    return DASH_SLICE.apply(D.denormalised(tables, dims)).select(
        "order_item_id", "year", "market", "customer_segment", "shipping_mode", "sales")


@register("mergeable_distinct")
def mergeable_distinct(spark, sf_dir):
    """A18-A20, A24 mergeable: distinct orders and customers by month, by year and in all, from one bitmap state by month."""
    from tidemark.functions.distinct import count_bitmaps, id_bitmaps, merge_bitmaps
    t = layers.star_tables(spark, sf_dir, ["fact_sales", "dim_date"])
    rows = D.denormalised({**t, "fact_sales": t["fact_sales"].select("date_id", "order_id", "customer_id")}, ["dim_date"])
    out = None
    for what in ("order_id", "customer_id"):
        state = id_bitmaps(rows, ["year", "month"], what)
        for keys in (["year", "month"], ["year"], []):
            counts = count_bitmaps(state if len(keys) == 2 else merge_bitmaps(state, keys), keys, "n")
            one = counts.select(F.lit(what).alias("what"), *[(F.col(k) if k in keys else F.lit(None)).cast("int").alias(k)
                                                             for k in ("year", "month")], "n")
            out = one if out is None else out.unionByName(one)
    return out


@register("distinct_values")
def distinct_values(spark, sf_dir):
    """P14."""
    return D.distinct_values(layers.star_tables(spark, sf_dir, ["fact_sales", *D.FILTER_COLUMNS.values()]))


# A18-A27 over the full selection, the default of every filter; each joins what it reads.
for _name, _fn, _dims in [("dash_kpis", D.dash_kpis, []), ("dash_monthly", D.dash_monthly, ["dim_date"]),
                          ("dash_market", D.dash_market, ["dim_location"]),
                          ("dash_late_by_mode", D.dash_late_by_mode, ["dim_shipping"]),
                          ("dash_category", D.dash_category, ["dim_product"]),
                          ("dash_top_products", D.dash_top_products, ["dim_product"]),
                          ("dash_status_counts", D.dash_status_counts, ["dim_shipping"]),
                          ("dash_segment", D.dash_segment, ["dim_customer"]),
                          ("dash_geo", D.dash_geo, ["dim_location"]),
                          ("margin_histogram", D.margin_histogram, []), ("delay_histogram", D.delay_histogram, [])]:
    QUERIES[_name] = (lambda fn, dims: (lambda spark, sf_dir: fn(
        D.denormalised(layers.star_tables(spark, sf_dir, ["fact_sales", *dims]), dims))))(_fn, _dims)


# ---- Validation (V1-V9) --------------------------------------------------------------
from tidemark.operators import validate as V  # noqa: E402


@register("issue_report")
def issue_report(spark, sf_dir):
    """V8: the whole report (V1-V7 rows)."""
    return V.issue_report(layers.raw(spark, sf_dir))


for _check in V.CHECKS:   # each builds its own counters only
    QUERIES[_check] = (lambda c: (lambda spark, sf_dir: V.issue_report(layers.raw(spark, sf_dir), [c])))(_check)


@register("total_issues")
def total_issues(spark, sf_dir):
    """V9."""
    return V.total_issues(issue_report(spark, sf_dir))


# ---- Cleaning steps one by one (P1-P12) --------------------------------------------
from tidemark.operators import silver as S  # noqa: E402
from tidemark.schemas import (ID_COLUMNS, NUMERIC_TYPES, RENAME_MAP,  # noqa: E402
                              SILVER_DROP, STRING_COLUMNS)
from tidemark.functions.text import normalise, snake_case_name  # noqa: E402


def _typed(spark, sf_dir):
    """P1 + P4 + P5 + P6 on the Bronze rows (the Silver steps before row removal)."""
    b = layers.bronze(spark, sf_dir)
    return S.parse_dates(S.enforce_types(S.drop_columns(b, SILVER_DROP + S.BRONZE_ONLY)))


@register("drop_columns")
def drop_columns(spark, sf_dir):
    """P1."""
    return S.drop_columns(layers.raw(spark, sf_dir), SILVER_DROP)


@register("snake_case_header")
def snake_case_header(spark, sf_dir):
    """Header rewrite (metadata only)."""
    r = layers.raw(spark, sf_dir)
    return r.toDF(*[snake_case_name(c) if not c.startswith("_") else c for c in r.columns])


@register("rename_map")
def rename_map(spark, sf_dir):
    """The 40-name map; names it does not list are kept."""
    r = layers.raw(spark, sf_dir)
    return r.withColumnsRenamed({k: v for k, v in RENAME_MAP.items() if k in r.columns})


@register("numeric_coerce")
def numeric_coerce(spark, sf_dir):
    """The 13 numeric columns, bad text -> NULL."""
    t = _typed(spark, sf_dir)
    return t.select("_row_number", *[t[f"`{c}`"].alias(RENAME_MAP.get(c, snake_case_name(c)))
                                     for c in NUMERIC_TYPES])


@register("id_coerce")
def id_coerce(spark, sf_dir):
    """P5: the 6 integer ids."""
    t = _typed(spark, sf_dir)
    return t.select("_row_number", *[t[f"`{c}`"].alias(RENAME_MAP[c]) for c in ID_COLUMNS])


@register("date_parse")
def date_parse(spark, sf_dir):
    """P6."""
    return _typed(spark, sf_dir).select("_row_number", "order_date", "ship_date")


@register("drop_bad_dates")
def drop_bad_dates(spark, sf_dir):
    """Rows before and after removing unparseable order dates."""
    t = _typed(spark, sf_dir)
    return t.agg(F.count(F.lit(1)).alias("rows_before"),
                 F.count_if(F.col("order_date").isNotNull()).alias("rows_after"))


def _first(spark, sf_dir, *also):
    return S.first_rows(S.drop_bad_dates(_typed(spark, sf_dir)), "Order Item Id", *also)


@register("dedup_keep_first")
def dedup_keep_first(spark, sf_dir):
    """Which row survives per order item id."""
    rows = S.pick_rows(S.drop_bad_dates(_typed(spark, sf_dir)), _first(spark, sf_dir))
    return rows.select(F.col("`Order Item Id`").alias("order_item_id"), "_row_number", "_row_hash")


@register("null_fill")
def null_fill(spark, sf_dir):
    """P9."""
    d = S.fill_nulls(S.pick_rows(S.drop_bad_dates(_typed(spark, sf_dir)), _first(spark, sf_dir)))
    return d.select(F.col("`Order Item Id`").alias("order_item_id"), F.col("`Customer Lname`").alias("customer_lname"),
                    F.col("`Customer Zipcode`").alias("customer_zipcode"),
                    F.col("`Order Zipcode`").alias("order_zipcode"))


@register("string_normalise")
def string_normalise(spark, sf_dir):
    """P10: every distinct raw value of the 15 string columns and its normal form."""
    r = layers.raw(spark, sf_dir)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), r[f"`{c}`"].alias("raw_value")) for c in STRING_COLUMNS])
    return r.select(F.inline(pairs)).distinct().withColumn("normalised", normalise(F.col("raw_value")))


@register("percentile_trim")
def percentile_trim(spark, sf_dir):
    """The exact 1 % / 99 % bounds of Sales and the rows kept between them."""
    d = _first(spark, sf_dir, "Sales")
    lo, hi = S.percentile_bounds(d, "Sales")
    x = F.col("Sales").cast("double")
    # reported at 6 dp: engines interpolate with different (equally exact) formulas
    r6 = lambda v: F.floor(F.lit(v).cast("double") * 1e6 + 0.5) / 1e6
    return d.agg(r6(lo).alias("lo"), r6(hi).alias("hi"),
                 F.count(F.lit(1)).alias("rows_in"),
                 F.count_if((x >= F.lit(lo)) & (x <= F.lit(hi))).alias("rows_kept"))


@register("audit_flag")
def audit_flag(spark, sf_dir):
    """Silver rows, NULL cells, and whether every row carries the flag."""
    s = silver(spark, sf_dir)
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in s.columns), F.lit(0))
    return s.agg(F.count(F.lit(1)).alias("rows"), nulls.cast("bigint").alias("null_cells"),
                 F.bool_and("_silver_processed").alias("all_processed"))


# ---- Features (F1-F9) ---------------------------------------------------------------
FEATURE_QUERIES = {
    "time_parts": ["order_year", "order_month", "order_quarter", "order_month_name"],  # F1
    "delivery_delay": ["delivery_delay_days"],  # F2
    "is_late": ["is_late"],  # F3
    "profit_margin": ["profit_margin_pct"],  # F4
    "discount_pct": ["discount_pct"],  # F5
    "revenue_per_item": ["revenue_per_item"],  # F6
    "delivery_days_actual": ["delivery_days_actual"],  # F7
}
for _key, _cols in FEATURE_QUERIES.items():
    QUERIES[_key] = (lambda cols: (lambda spark, sf_dir: layers.prep(spark, sf_dir).select("order_item_id", *cols)))(_cols)


@register("customer_metrics")
def customer_metrics(spark, sf_dir):
    """Per customer CLV, AOV, distinct orders and the repeat flag."""
    from tidemark.operators.features import customer_metrics as cm
    return cm(layers.prep(spark, sf_dir)).withColumn(
        "customer_lifetime_value", F.col("customer_lifetime_value").cast("double"))


# ---- Set operations (U1, U2) ---------------------------------------------------------
@register("distinct_rows")
def distinct_rows(spark, sf_dir):
    """``drop_duplicates`` over all listed columns."""
    from tidemark.operators.star import LOCATION_COLS
    return layers.prep(spark, sf_dir).select(*LOCATION_COLS).distinct()


@register("union_rerun")
def union_rerun(spark, sf_dir):
    """Two ingests unioned and refined (``layers.two_landings``).  First seen goes by ingest before place, so the
    second adds the debits and changes nothing else."""
    first, second = layers.two_landings(layers.bronze(spark, sf_dir))
    return S.refine_silver(first.unionByName(second)).drop(*ORDER_COLUMNS)


# ---- The daily job: layers that move on batch by batch (X1, P8, P11, A1-A6, W8, J7) -----
@register("incremental_silver")
def incremental_silver(spark, sf_dir):
    """P8 across batches: Silver after two landings; the second read no wide row of the first."""
    from tidemark.incremental.silver import silver as latest
    return latest(layers.landed_store(spark, sf_dir)).drop(*ORDER_COLUMNS)


@register("incremental_bounds")
def incremental_bounds(spark, sf_dir):
    """P11 across batches: the bounds after each landing and the rows between them."""
    from tidemark.incremental.silver import bounds_of, silver as rows_of
    store = layers.landed_store(spark, sf_dir)
    out = None
    for number in (1, 2):
        version = store.version(number)
        b = bounds_of(store, version)
        one = rows_of(store, version).agg(F.count(F.lit(1)).alias("rows_kept")).select(
            F.lit(number).alias("landing"), F.lit(b.lo).alias("lo"), F.lit(b.hi).alias("hi"), "rows_kept")
        out = one if out is None else out.unionByName(one)
    r6 = lambda c: (F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c)
    return out.select("landing", r6("lo"), r6("hi"), "rows_kept")


def _incremental_gold(name: str) -> Query:
    def q(spark, sf_dir):
        from tidemark.incremental.gold import gold as folded
        return folded(layers.landed_store(spark, sf_dir), name)
    return q


for _name in layers.GOLD_TABLES:   # A1-A6 folded from the state of two landings
    QUERIES[_name.replace("gold_", "incremental_")] = _incremental_gold(_name)


@register("stable_keys")
def stable_keys(spark, sf_dir):
    """W8 across batches: the ids of the first landing stay, the second goes on from them."""
    from tidemark.incremental.keys import dimension
    store = layers.landed_store(spark, sf_dir)
    return _natural_keys(*(dimension(store, d) for d in ("dim_date", "dim_location", "dim_shipping")))


@register("incremental_fact_keys")
def incremental_fact_keys(spark, sf_dir):
    """J7 across batches: the ids that each fact got with its landing."""
    from tidemark.incremental.daily import facts
    return facts(layers.landed_store(spark, sf_dir)).select("order_item_id", "date_id", "location_id", "shipping_id")


# ---- Sources and sinks (S1, S7-S9, S11), streaming ingest (X1) ------------------------
from tidemark.schemas import RAW_COLUMNS as _RAW  # noqa: E402
from tidemark.sources import csv_source as CSV  # noqa: E402


@register("csv_scan")
def csv_scan(spark, sf_dir):
    """The landing CSV read back as 53 text columns (scan-order row numbers left out)."""
    df = CSV.read_raw_csv(spark, layers.landing_csv(spark, sf_dir))
    return df.select(*[df[f"`{c}`"] for c in _RAW])


@register("csv_sink")
def csv_sink(spark, sf_dir):
    """A Gold table written as CSV and read back with its schema."""
    g = layers.gold(spark, sf_dir, "gold_product_performance")
    return CSV.read_csv(spark, layers.output(spark, sf_dir, "csv_sink", lambda path: CSV.write_csv(g, path)), g.schema)


@register("gold_export")
def gold_export(spark, sf_dir):
    """The whitelisted export of ``late_delivery_risk`` read back."""
    g = layers.gold(spark, sf_dir, "gold_late_delivery_risk")
    path = layers.output(spark, sf_dir, "export", lambda path: CSV.export_gold(g, "late_delivery_risk", path))
    return CSV.read_csv(spark, path, g.schema)


@register("star_load")
def star_load(spark, sf_dir):
    """Dimensions then fact, DDL types enforced; what each loaded column holds, read back."""
    from tidemark.sources.loader import load_report, load_star
    path = layers.output(spark, sf_dir, "warehouse",
                         lambda path: load_star(spark, layers.star_tables(spark, sf_dir), path))
    return load_report(spark, path)


@register("run_metrics")
def run_metrics(spark, sf_dir):
    """Per-stage counts of the session's pipeline run, from the written ``pipeline_runs``; each was observed while
    its table was written."""
    from tidemark.plans.pipeline import record_run, stage_counts

    def build(path):
        issues = V.total_issues(issue_report(spark, sf_dir)).first()[0]
        names = layers.GOLD_TABLES + layers.STAR_TABLES
        for n in names:     # the layers, where they are not written yet
            layers.gold(spark, sf_dir, n) if n in layers.GOLD_TABLES else layers.star(spark, sf_dir, n)
        rows = lambda n: layers.rows_written(spark, sf_dir, n)
        counts = stage_counts(spark, layers.rows_extracted(spark, sf_dir), issues, rows("bronze"), rows("silver"), {n: rows(n) for n in names})
        record_run(counts, path, layers.as_of(spark, sf_dir))
    return spark.read.parquet(layers.output(spark, sf_dir, "pipeline_runs", build)).drop("run_id", "finished_at")


@register("dense_row_number")
def dense_row_number(spark, sf_dir):
    """1..n in file order through the CSV path, over files that hold the order items in order."""
    from tidemark.operators.bronze import ingest_bronze
    from tidemark.session import checkpointed
    landed = checkpointed(CSV.read_raw_csv(spark, layers.sorted_landing(spark, sf_dir)))
    rows = ingest_bronze(CSV.dense_row_numbers(landed), "landing", layers.as_of(spark, sf_dir))
    return rows.select(F.col("`Order Item Id`").cast("bigint").alias("order_item_id"), "_row_hash", "_row_number")


@register("incremental_bronze")
def incremental_bronze(spark, sf_dir):
    """Landing files streamed into Bronze (availableNow trigger); a second call finds nothing new."""
    from tidemark.streaming.incremental_bronze import run_incremental_bronze
    out = layers.output(spark, sf_dir, "stream", lambda path: None)
    run_incremental_bronze(spark, layers.landing_csv(spark, sf_dir), f"{out}/bronze", f"{out}/_checkpoint")
    b = spark.read.parquet(f"{out}/bronze")
    return b.select(*[b[f"`{c}`"] for c in _RAW])
