"""Silver steps: drop, types, dates, dedup order, fills, title case, trim."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions.text import normalise, title_case
from tidemark.operators import silver as S
from tidemark.operators.bronze import ingest_bronze


def _silver(df, band=(0.0, 1.0)):
    return S.refine_silver(ingest_bronze(df, "test.csv", "2026-01-01T00:00:00"), band)


def test_removes_password_and_pii(make_raw, raw_rows):
    cols = _silver(make_raw(raw_rows)).columns
    assert "customer_password" not in cols and "customer_email" not in cols and "customer_street" not in cols


def test_parses_dates(make_raw, raw_rows):
    s = _silver(make_raw(raw_rows))
    assert dict(s.dtypes)["order_date"] == "timestamp_ntz"  # wall clock, no zone in the text
    assert s.filter(F.col("order_date").isNull()).count() == 0


def test_bad_order_date_dropped(make_raw, raw_rows):
    raw_rows[0]["order date (DateOrders)"] = "not a date"
    assert _silver(make_raw(raw_rows)).count() == 1


def test_fills_null_lname_and_zip(make_raw, raw_rows):
    rows = _silver(make_raw(raw_rows)).collect()
    assert {r["customer_lname"] for r in rows} == {"Haddad", "Unknown"}
    assert all(r["customer_zipcode"] is not None for r in rows)


def test_no_duplicate_order_items_and_first_wins(make_raw, raw_rows):
    second = dict(raw_rows[0])
    second["Sales"] = "999.99"  # same item id, later in the file
    df = ingest_bronze(make_raw(raw_rows + [second]), "t.csv", "2026-01-01T00:00:00")
    s = S.refine_silver(df, (0.0, 1.0))
    assert s.groupBy("order_item_id").count().filter("count > 1").count() == 0
    kept = s.filter(F.col("order_item_id") == 9001).collect()[0]
    assert float(kept["sales"]) == 63.00


def test_title_case_is_python_like(spark):
    vals = ["men's dri-FIT 3d shoe", "  san juan\t ", "ABC_def", None, ""]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(normalise(F.col("s"))).collect()]
    assert got == [v.strip().title() if v is not None else None for v in vals]
    got2 = df.select(title_case(F.lit("o'neil mcDONALD"))).first()[0]
    assert got2 == "o'neil mcDONALD".title()


def test_percentile_trim_exact_and_inclusive(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.uniform(1, 1000, 500), 2)
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "Sales double")
    lo, hi = np.percentile(vals, [1, 99])  # linear interpolation
    kept = S.percentile_trim(df, "Sales").count()
    assert kept == int(((vals >= lo) & (vals <= hi)).sum())
    b_lo, b_hi = S.percentile_bounds(df, "Sales")
    assert abs(b_lo - lo) < 1e-9 and abs(b_hi - hi) < 1e-9


def test_returns_dataframe_with_audit_flag(make_raw, raw_rows):
    s = _silver(make_raw(raw_rows))
    assert s.agg(F.bool_and("_silver_processed")).first()[0] is True
