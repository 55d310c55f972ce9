"""Star schema over sf0.001: tables, row counts, keys, integrity."""

from pyspark.sql import functions as F

from tidemark.plans import layers
from tidemark.plans.catalog import QUERIES


def test_all_tables_present(spark, sf_small):
    assert set(layers.star_tables(spark, sf_small)) == {
        "dim_customer", "dim_product", "dim_date", "dim_location", "dim_shipping", "fact_sales"}


def test_fact_sales_row_count(spark, sf_small):
    assert layers.star(spark, sf_small, "fact_sales").count() == layers.silver(spark, sf_small).count()


def test_dim_customer_unique_ids(spark, sf_small):
    d = layers.star(spark, sf_small, "dim_customer")
    assert d.select("customer_id").distinct().count() == d.count()


def test_fact_has_all_keys_and_no_orphans(spark, sf_small):
    f = layers.star(spark, sf_small, "fact_sales")
    for k in ["customer_id", "product_card_id", "date_id", "location_id", "shipping_id"]:
        assert k in f.columns
    assert QUERIES["fk_check"](spark, sf_small).agg(F.sum("violations")).first()[0] == 0


def test_dim_date_is_daily_and_dense(spark, sf_small):
    d = layers.star(spark, sf_small, "dim_date").orderBy("date_id").collect()
    assert [r["date_id"] for r in d] == list(range(1, len(d) + 1))
    assert all(a["full_date"] < b["full_date"] for a, b in zip(d, d[1:]))


def test_checks_find_orphans_duplicates_and_null_keys(spark, sf_small):
    from tidemark.operators.star import fk_check
    t = dict(layers.star_tables(spark, sf_small))
    products = t["dim_product"].orderBy("product_card_id")
    gone = products.first()["product_card_id"]
    orphans = t["fact_sales"].where(F.col("product_card_id") == gone).count()
    null_row = products.limit(1).withColumn("product_card_id", F.lit(None).cast("bigint"))
    t["dim_product"] = products.where(F.col("product_card_id") != gone).unionByName(null_row).unionByName(null_row)
    t["dim_shipping"] = t["dim_shipping"].unionByName(t["dim_shipping"].limit(1))
    found = {(r["check"], r["table_name"], r["column_name"]): r["violations"] for r in fk_check(t).collect() if r["violations"]}
    assert orphans > 0 and found == {
        ("foreign_key", "fact_sales", "product_card_id"): orphans, ("primary_key_unique", "dim_product", "product_card_id"): 1,
        ("primary_key_not_null", "dim_product", "product_card_id"): 2, ("primary_key_unique", "dim_shipping", "shipping_id"): 1}


def test_orphan_rows_are_listed(spark, sf_small, monkeypatch):
    real = layers.star_tables(spark, sf_small)
    gone = real["fact_sales"].agg(F.min("location_id")).first()[0]
    cut = {**real, "dim_location": real["dim_location"].where(F.col("location_id") != gone)}
    monkeypatch.setattr(layers, "star_tables", lambda *_: cut)
    rows = QUERIES["integrity_anti_join"](spark, sf_small).collect()
    assert len(rows) == real["fact_sales"].where(F.col("location_id") == gone).count() > 0
    assert {(r["foreign_key"], r["key_value"]) for r in rows} == {("location_id", gone)}


def test_first_seen_keeps_one_row_per_key_and_task(spark):
    """First in file order per key, equal rows once, NULL keys out; a hot key is reduced before the exchange."""
    from tidemark.operators.star import first_seen
    rows = [(1, "b", None, 2, 7, 10, "late"), (1, "b", None, 1, 7, 10, "first"), (1, "a", 5, 9, 1, 20, "twin"),
            (1, "a", 5, 9, 1, 20, "twin"), (1, "a", 5, 8, 1, None, "no key"), (2, "a", 0, 0, 0, 20, "next day")]
    rows += [(3, "z", i, 0, 0, 10, f"hot {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "_ingestion_ts long, _source_file string, _file_block int, _row_number long, "
                                     "_row_digest long, k long, wide string").repartition(4)
    got = first_seen(df, "k", ["wide"])
    assert sorted((r.k, r.wide) for r in got.collect()) == [(10, "first"), (20, "twin")]
    plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert "partial_min" in plan[plan.index("Exchange hashpartitioning(k"):]


def test_load_keeps_types_and_wide_keys(spark, sf_small, tmp_dir):
    from tidemark.schemas import STAR_DDL
    from tidemark.sources.loader import load_star, loaded
    t = dict(layers.star_tables(spark, sf_small))
    t["fact_sales"] = t["fact_sales"].withColumn("order_item_id", F.col("order_item_id") + 3_000_000_000)
    report = load_star(spark, t, tmp_dir + "/wh").collect()
    assert {(r["table_name"], r["column_name"], r["data_type"]) for r in report} == {
        (name, c, k) for name, cols in STAR_DDL.items() for c, k in cols}
    assert loaded(spark, tmp_dir + "/wh")["fact_sales"].agg(F.min("order_item_id")).first()[0] > 3_000_000_000
