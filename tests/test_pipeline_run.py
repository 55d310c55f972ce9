"""One pipeline run from a landing CSV, and dedup under a hot key."""

from pyspark.sql import functions as F

from tidemark.operators.silver import dedup_keep_first
from tidemark.plans import layers
from tidemark.plans.pipeline import run_pipeline


def test_run_pipeline_counts(spark, sf_small, tmp_dir):
    landing = layers.landing_csv(spark, sf_small)
    run = run_pipeline(spark, landing, tmp_dir + "/run").collect()
    m = {(r["stage"], r["metric"]): r["value"] for r in run}
    assert len({(r["run_id"], r["finished_at"]) for r in run}) == 1
    assert spark.read.parquet(tmp_dir + "/run/pipeline_runs").count() == len(run)
    raw_rows = layers.raw(spark, sf_small).count()
    assert m[("extract", "rows")] == raw_rows == m[("bronze", "rows")]
    # one row per distinct order item with a valid date, inside the trim band
    items = layers.raw(spark, sf_small).select("`Order Item Id`").distinct().count()
    assert 0.95 * items <= m[("silver", "rows")] <= items
    assert m[("gold", "fact_sales")] == m[("silver", "rows")]
    assert m[("validate", "total_issues")] > 0


def test_dedup_with_one_hot_key(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),  # a third share key -1
        F.col("id").alias("_row_number"), F.lit("h").alias("_row_hash"), (F.col("id") * 2).alias("v"))
    out = dedup_keep_first(df, "k", ["_row_number", "_row_hash"])
    assert out.count() == n - n // 3 + 1
    hot = out.filter("k = -1").first()
    assert hot["_row_number"] == 0 and hot["v"] == 0


def test_first_seen_goes_by_ingest_then_file_split_and_position(spark, make_raw, raw_rows):
    from tidemark.operators import silver as S
    from tidemark.operators.bronze import ingest_bronze

    def ingest(ts, source, block, number, sales):
        raw = make_raw([raw_rows[0] | {"Sales": sales}]).withColumns(
            {"_source_file": F.lit(source), "_file_block": F.lit(block), "_row_number": F.lit(number)})
        return ingest_bronze(raw, "x", ts)

    copies = [ingest("2026-01-02T00:00:00", "a.csv", 0, 5, "9.00"), ingest("2026-01-01T00:00:00", "b.csv", 0, 10, "2.00"),
              ingest("2026-01-01T00:00:00", "a.csv", 64, 1, "3.00"), ingest("2026-01-01T00:00:00", "a.csv", 0, 70, "1.00"),
              ingest("2026-01-01T00:00:00", "a.csv", 0, 71, "4.00")]
    while copies:
        df = copies[0]
        for c in copies[1:]:
            df = df.unionByName(c)
        rows = S.refine_silver(df.withColumn("_row_uid", F.monotonically_increasing_id()), (0.0, 1.0)).collect()
        left = [float(c.first()["Sales"]) for c in copies]
        order = [1.0, 4.0, 3.0, 2.0, 9.0]
        assert [float(r["sales"]) for r in rows] == [next(x for x in order if x in left)]
        copies = [c for c, x in zip(copies, left) if x != next(y for y in order if y in left)]


def test_files_of_any_size_keep_their_order(spark, make_raw, raw_rows, tmp_dir):
    """The copy in the first file wins, although Spark reads the larger second file first."""
    import os
    from tidemark.operators.bronze import ingest_bronze
    from tidemark.operators.silver import refine_silver
    from tidemark.sources.csv_source import read_raw_csv, write_raw_csv
    import glob
    import shutil
    os.makedirs(tmp_dir + "/landing")
    more = [raw_rows[1] | {"Order Item Id": str(20_000 + i)} for i in range(300)]
    for name, rows in (("a.csv", [raw_rows[0]]), ("b.csv", more + [raw_rows[0] | {"Sales": "77.00"}])):
        write_raw_csv(make_raw(rows).coalesce(1), f"{tmp_dir}/{name}.d")
        shutil.copy(glob.glob(f"{tmp_dir}/{name}.d/*.csv")[0], f"{tmp_dir}/landing/{name}")
    bronze = ingest_bronze(read_raw_csv(spark, tmp_dir + "/landing"), "x", "t")
    kept = refine_silver(bronze, (0.0, 1.0)).where("order_item_id = 9001").collect()
    assert [float(r["sales"]) for r in kept] == [63.0]


def test_dedup_plan_sorts_no_wide_rows(spark, sf_small):
    """AQE makes a hash join of the semi-join once it has measured the narrow side; no hint forces it."""
    from tidemark.operators import silver as S
    b = layers.bronze(spark, sf_small)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = S.pick_rows(b, S.first_rows(b, "Order Item Id"))
        assert "hint" not in wide._jdf.queryExecution().logical().toString().lower()
        wide.collect()
        plan = wide._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    final = plan[:plan.index("Initial Plan")]
    assert "ShuffledHashJoin" in final and "Sort " not in final and "SortAggregate" not in final
