"""The daily job: after several landings every layer equals a rebuild from all rows."""
import glob
import os
import re
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.incremental import daily, gold, keys, silver
from tidemark.incremental.tables import VersionedTables
from tidemark.operators import gold as gold_ops
from tidemark.operators.bronze import ingest_bronze
from tidemark.operators.features import add_features
from tidemark.operators.silver import refine_silver
from tidemark.sources.csv_source import write_raw_csv


def item(rows, n, **fields):
    base = rows[n % 2]
    return base | {"Order Item Id": None if n % 41 == 7 else str(9000 + n), "Order Id": str(900 + n // 3),
                   "Customer Id": str(40 + n % 17), "Order Customer Id": str(40 + n % 17), "Sales": f"{20 + n % 97}.{n % 100:02d}",
                   "Order City": f"town {n % 13}", "Shipping Mode": ["First Class", "Same Day"][n % 2],
                   "order date (DateOrders)": f"{1 + n % 12}/{1 + n % 28}/{2018 + n % 2} 9:05", **fields}


def landings(rows):
    """Three days: repeats within and across days, null keys, bad dates, and sales that move both bounds."""
    first = [item(rows, n) for n in range(0, 120)] + [item(rows, n, Sales="1.00") for n in range(0, 120, 9)]
    second = [item(rows, n, **{"Order Status": "again"}) for n in range(60, 200)] + [
        item(rows, 300 + n, Sales=str(1000 + n)) for n in range(30)] + [item(rows, 900, **{"order date (DateOrders)": "never"})]
    third = [item(rows, 400 + n, Sales=f"0.{n:02d}", **{"Order City": f"a new town {n % 3}"}) for n in range(60)] + [
        item(rows, 500 + n, Sales=None if n % 5 else "50.00") for n in range(40)] + [item(rows, n, Sales="9999") for n in range(20)]
    return [first, second, third]


def bronze(make_raw, spark, days):
    return [spark.createDataFrame(ingest_bronze(make_raw(day).coalesce(1), f"day{i}.csv", f"2026-01-0{i + 1}T00:00:00").collect(),
                                  ingest_bronze(make_raw(day), "x", "t").schema) for i, day in enumerate(days)]


@pytest.fixture(scope="module")
def days(spark):
    from tests.conftest import FIXTURE_ROWS
    from tidemark.schemas import RAW_COLUMNS, RAW_SCHEMA
    make = lambda rows: spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)
    return bronze(make, spark, landings(FIXTURE_ROWS))


@pytest.fixture(scope="module")
def store(spark, days, tmp_path_factory):
    store = VersionedTables(spark, str(tmp_path_factory.mktemp("store")))
    for n, day in enumerate(days):
        daily.run_batch(store, day, n, key_parts=4)
    return store


def rows_of(df, drop=()):
    columns = sorted(c for c in df.columns if c not in drop)
    return Counter(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


def union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def test_every_version_equals_a_rebuild(store, days):
    for n in (1, 2, 3):
        full = refine_silver(union(days[:n]))
        version = store.version(n)
        assert version.batch == n - 1
        assert rows_of(silver.silver(store, version)) == rows_of(full) != Counter()
        prep = add_features(full)
        for name in gold.GOLD_TABLES:
            assert rows_of(gold.gold(store, name, version)) == rows_of(gold_ops.GOLD_BUILDERS[name](prep)), name
        assert daily.facts(store, version).count() == full.count()


def test_bounds_are_bit_equal_to_a_full_run(store, days):
    from tidemark.operators.silver import (BRONZE_ONLY, SILVER_DROP, drop_bad_dates, drop_columns, enforce_types, first_rows,
                                           parse_dates, percentile_bounds)
    seen = []
    for n in (1, 2, 3):
        typed = drop_bad_dates(parse_dates(enforce_types(drop_columns(union(days[:n]), SILVER_DROP + BRONZE_ONLY))))
        found = silver.bounds_of(store, store.version(n))
        assert (found.lo, found.hi) == percentile_bounds(first_rows(typed, silver.KEY, "Sales"), "Sales")
        seen.append((found.lo, found.hi))
    assert len({lo for lo, _ in seen}) > 1 and len({hi for _, hi in seen}) > 1      # both bounds did move


def test_keys_stay_and_new_ones_go_on(store):
    for name, (id_col, natural) in keys.KEY_MAPS.items():
        before = {}
        for n in (1, 2, 3):
            found = {tuple(r[c] for c in natural): r[id_col] for r in keys.dimension(store, name, store.version(n)).collect()}
            assert sorted(found.values()) == list(range(1, len(found) + 1))
            assert before.items() <= found.items()
            new = sorted((i, k) for k, i in found.items() if k not in before)
            assert [k for _, k in new] == sorted((k for _, k in new), key=lambda k: tuple((x is None, x) for x in k))
            before = found
    towns = {r["order_city"]: r["location_id"] for r in keys.dimension(store, "dim_location").collect()}
    assert towns["A New Town 0"] > towns["Town 9"]             # sorts first, came last


def test_facts_keep_the_ids_of_their_landing(store):
    ids = lambda n: {(r.order_item_id, r.date_id, r.location_id, r.shipping_id) for r in daily.facts(store, store.version(n)).collect()}
    first, last = ids(1), ids(3)
    items = {x[0] for x in last}
    assert {x for x in first if x[0] in items} <= last
    assert all(None not in x[1:] for x in last)


def test_a_published_batch_is_not_applied_again(store, days):
    assert daily.run_batch(store, days[2], 2).number == 3 == store.current().number


def test_plan_of_a_batch_reads_keys_and_no_old_rows(store, spark, days):
    version = store.version(2)
    typed = days[2].select("`Order Item Id`", F.lit(1).alias("x")).withColumn(silver.KEY, F.col("`Order Item Id`").cast("bigint"))
    new = silver.new_keys(store, version, typed, 4)
    files = new.inputFiles()
    assert files and all("/seen/" in f for f in files if "/store" in f)


def scan_of(df):
    """Which filters reach the files, in the plan's formatted text."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_moved_bounds_read_edge_files_only(store, days):
    rows = store.spark.read.parquet(store.path(store.version(1).of("rows")[0])).drop("_edge")
    core = silver.bounds_of(store, store.version(1))
    was, now = silver.Bounds(21.0, 110.0, 40.0, 100.0), silver.Bounds(20.0, 111.5, 40.0, 100.0)
    assert core.core_lo is not None
    step = silver.Step(rows.limit(0), now, was, {})
    plan = scan_of(silver.changed(store, store.version(1), step))
    assert re.search(r"PartitionFilters: \[[^]]*_edge", plan) and re.search(r"PushedFilters: \[[^]]*sales", plan)
    inner = silver.Step(rows.limit(0), silver.Bounds(60.0, 110.0, 40.0, 100.0), was, {})
    assert not re.search(r"PartitionFilters: \[[^]]*_edge", scan_of(silver.changed(store, store.version(1), inner)))


def test_bounds_in_cents_choose_the_same_rows(spark):
    cents = spark.range(0, 400).select((F.col("id").cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias("sales"))
    for lo, hi in [(1.23, 2.34), (1.2300000000000002, 2.3399999999999994), (1.229, 2.341), (0.1 + 0.2, 3.3000000000000003)]:
        x = F.col("sales").cast("double")
        want = cents.filter((x >= lo) & (x <= hi)).collect()
        assert cents.filter(silver.Bounds(lo, hi).inside(F.col("sales"))).collect() == want


def test_failure_leaves_the_old_version_and_a_replay_mends_it(spark, days, tmp_dir, monkeypatch):
    store = VersionedTables(spark, tmp_dir + "/store")
    assert store.current().number == 0
    daily.run_batch(store, days[0], 0, key_parts=3)
    before = rows_of(silver.silver(store))

    def broken(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(gold, "add_batch", broken)
        with pytest.raises(RuntimeError):
            daily.run_batch(store, days[1], 1, key_parts=3)
    assert store.current().number == 1 and rows_of(silver.silver(store)) == before
    monkeypatch.setattr(silver, "MERGE_AFTER", 1)        # folders of every table are merged at once
    daily.run_batch(store, days[1], 1, key_parts=3)
    full = refine_silver(union(days[:2]))
    assert rows_of(silver.silver(store)) == rows_of(full)
    assert all(len(f) == 1 for f in store.current().folders["seen"].values())
    assert [len(store.current().of(t)) for t in ("counts", "gold_monthly_revenue_sums")] == [1, 1]
    name = "gold_customer_segments"
    assert rows_of(gold.gold(store, name)) == rows_of(gold_ops.GOLD_BUILDERS[name](add_features(full)))
    gone = store.remove_unused(keep=1)
    assert gone and rows_of(silver.silver(store)) == rows_of(full)
    assert not store.remove_unused(keep=1)


def test_untouched_key_partitions_stay(spark, days, tmp_dir):
    store = VersionedTables(spark, tmp_dir + "/store")
    rows = [days[0].filter(F.col("`Order Item Id`") == str(9000 + n)) for n in (1, 2, 1)]
    for n, day in enumerate(rows[:2]):
        step = silver.add_batch(store, store.current(), day, parts=64)
        store.publish(step.folders, n)
    first, second = store.version(1).folders["seen"], store.version(2).folders["seen"]
    assert len(first) == 1 and len(second) == 2 and first.items() <= second.items()
    again = silver.add_batch(store, store.current(), rows[2], parts=64)
    assert again.folders["seen"] == second and again.rows.count() == 0


def test_daily_job_from_landing_files(spark, make_raw, raw_rows, tmp_dir):
    files = [raw_rows[:1] + raw_rows[:1], [raw_rows[0] | {"Sales": "1.00"}, raw_rows[1]]]
    os.makedirs(tmp_dir + "/landing")
    for n, rows in enumerate(files):
        write_raw_csv(make_raw(rows).coalesce(1), f"{tmp_dir}/stage{n}")
        shutil.copy(glob.glob(f"{tmp_dir}/stage{n}/*.csv")[0], f"{tmp_dir}/landing/{'ba'[n]}.csv")
        version = daily.run_daily(spark, tmp_dir + "/landing", tmp_dir + "/run")
        assert version.number == n + 1
    store = VersionedTables(spark, tmp_dir + "/run/layers")
    kept = {r["order_item_id"]: float(r["sales"]) for r in silver.stored_rows(
        store, version, spark.read.parquet(store.path(version.of("rows")[0])).schema).collect()}
    assert kept == {9001: 63.0, 9011: 58.75}           # the first landing of 9001 stays
    assert daily.run_daily(spark, tmp_dir + "/landing", tmp_dir + "/run").number == 2
