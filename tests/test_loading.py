"""Row numbers, counts, loads and constraints: what a run writes and what its readers see."""
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.functions.distinct import count_bitmaps, id_bitmaps, merge_bitmaps
from tidemark.operators.constraints import judged, split_load
from tidemark.plans import layers
from tidemark.schemas import FOREIGN_KEYS, LOAD_ORDER
from tidemark.session import checkpointed
from tidemark.sources import csv_source, loader


def test_row_numbers_are_dense_over_files_and_splits(spark, make_raw, raw_rows, tmp_dir):
    """Files of the same name in two folders, read in splits of a few rows and larger files first."""
    items = []
    for folder, name, n in (("b", "x.csv", 5), ("a", "x.csv", 70), ("a", "y.csv", 1), ("a", "z.csv", 0)):
        rows = [raw_rows[1] | {"Order Item Id": f"{folder}{name}{i}"} for i in range(n)]
        items.append((folder, name, [r["Order Item Id"] for r in rows]))
        csv_source.write_raw_csv(make_raw(rows).coalesce(1), f"{tmp_dir}/stage-{folder}-{name}")
        os.makedirs(f"{tmp_dir}/landing/{folder}", exist_ok=True)
        for part in glob.glob(f"{tmp_dir}/stage-{folder}-{name}/*.csv"):
            shutil.copy(part, f"{tmp_dir}/landing/{folder}/{name}")
    want = [i for _, _, ids in sorted(items) for i in ids]
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        landed = checkpointed(csv_source.read_raw_csv(spark, f"{tmp_dir}/landing/*"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert landed.select("_source_file", "_file_block").distinct().count() > 5
    for limit in (csv_source.SPLITS_BROADCAST, 0):
        numbered = csv_source.dense_row_numbers(landed)
        assert numbered.columns == landed.columns
        found = sorted((r["_row_number"], r["Order Item Id"]) for r in numbered.collect())
        assert found == list(enumerate(want, start=1))
        csv_source.SPLITS_BROADCAST, was = limit, csv_source.SPLITS_BROADCAST
    csv_source.SPLITS_BROADCAST = was


def test_pipeline_reads_the_landing_files_once(spark, sf_small, tmp_dir, monkeypatch):
    from tidemark.plans import pipeline
    landing, folder = layers.landing_csv(spark, sf_small), tmp_dir + "/moved"
    read = pipeline.read_raw_csv
    calls = []

    def only_once(spark, path, encoding):
        calls.append(path)
        shutil.copytree(path, folder)
        return read(spark, folder, encoding)

    put = pipeline.write_observed

    def write(df, path, *mode):
        n = put(df, path, *mode)
        if path.endswith("/extract"):
            shutil.rmtree(folder)          # whoever reads the files again fails
        return n
    monkeypatch.setattr(pipeline, "read_raw_csv", only_once)
    monkeypatch.setattr(pipeline, "write_observed", write)
    run = {(r["stage"], r["metric"]): r["value"] for r in pipeline.run_pipeline(spark, landing, tmp_dir + "/run", load_target=tmp_dir + "/wh").collect()}
    assert calls == [landing]
    for name in LOAD_ORDER:     # observed counts are those of the tables
        assert run["gold", name] == spark.read.parquet(f"{tmp_dir}/run/gold/{name}").count()
    numbers = spark.read.parquet(tmp_dir + "/run/bronze").agg(F.min("_row_number"), F.max("_row_number"), F.count_distinct("_row_number")).first()
    assert tuple(numbers) == (1, run["bronze", "rows"], run["bronze", "rows"])
    assert loader.loaded(spark, tmp_dir + "/wh")["fact_sales"].count() == run["gold", "fact_sales"]


@pytest.mark.parametrize("after", [0, 3, 5])
def test_a_load_that_fails_leaves_the_version_before(spark, sf_small, tmp_dir, monkeypatch, after):
    tables = {n: df.limit(20) for n, df in layers.star_tables(spark, sf_small).items()}
    loader.load_star(spark, tables, tmp_dir + "/wh")
    before = {n: sorted(map(str, df.collect())) for n, df in loader.loaded(spark, tmp_dir + "/wh").items()}
    real = loader.conform
    with monkeypatch.context() as m:
        def broken(df, name):
            if name == LOAD_ORDER[after]:
                raise RuntimeError("lost")
            return real(df.limit(3), name)
        m.setattr(loader, "conform", broken)
        with pytest.raises(RuntimeError):
            loader.load_star(spark, tables, tmp_dir + "/wh")
    now = loader.loaded(spark, tmp_dir + "/wh")
    assert {n: sorted(map(str, df.collect())) for n, df in now.items()} == before
    if after == 5:
        loader.load_star(spark, {n: df.limit(2) for n, df in tables.items()}, tmp_dir + "/wh")
        assert [df.count() for df in loader.loaded(spark, tmp_dir + "/wh").values()] == [2] * 6
        assert [df.count() for df in now.values()] == [len(x) for x in before.values()]     # a reader that had begun


def test_rejects_have_every_reason(spark, tmp_dir):
    dims = {dim: spark.createDataFrame([(1,), (2,), (None,)], f"{key} long") for _, dim, key in FOREIGN_KEYS}
    columns = ["order_item_id", *[fk for fk, _, _ in FOREIGN_KEYS], "seq"]
    rows = [(10, 1, 1, 1, 1, 1, 0), (11, 2, None, 1, 2, 1, 0), (12, 9, 1, 1, 9, 1, 0), (None, 1, 1, 1, 1, 1, 0), (None, 1, 9, 1, 1, 1, 0),
            (13, 1, 1, 1, 1, 1, 5), (13, 1, 1, 1, 1, 1, 4), (13, 9, 1, 1, 1, 1, 6), (14, 1, 1, 1, 1, 1, 0), (14, 1, 1, 1, 1, 1, 0), (14, 1, 1, 1, 1, 1, 0)]
    fact = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in columns))
    accepted, rejected = split_load(fact, dims, ["seq"], tmp_dir + "/load")
    assert sorted((r.order_item_id, r.seq) for r in accepted.collect()) == [(10, 0), (11, 0), (13, 4), (14, 0)]
    assert accepted.columns == columns
    found = sorted((r.order_item_id or 0, r.seq, ",".join(r.reject_reasons)) for r in rejected.collect())
    assert found == [(0, 0, "null_key"), (0, 0, "null_key,orphan:product_card_id"), (12, 0, "orphan:customer_id,orphan:location_id"),
                     (13, 5, "duplicate_key"), (13, 6, "duplicate_key,orphan:customer_id"), (14, 0, "duplicate_key"), (14, 0, "duplicate_key")]
    assert judged(fact.limit(0), dims, ["seq"]).count() == 0


def test_slice_reads_the_folders_of_its_years(spark, sf_small):
    from tidemark.plans.catalog import QUERIES
    df = QUERIES["dashboard_slice"](spark, sf_small)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "order_year" in plan and any("PartitionFilters" in x and "order_year" in x and "1996" in x for x in plan.splitlines())


def test_bitmaps_merge_to_distinct_counts(spark):
    rows = spark.range(200_000).select((F.col("id") % 7).alias("g"), (F.col("id") % 3).alias("batch"),
                                       F.when(F.col("id") % 11 > 0, F.col("id") * 13 % 90_001).alias("k"))
    want = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("k").alias("n")).collect()}
    state = None
    for b in range(3):      # a state for each batch, united later
        one = id_bitmaps(rows.filter(F.col("batch") == b), ["g"], "k")
        state = one if state is None else state.unionByName(one)
    found = {r.g: r.n for r in count_bitmaps(merge_bitmaps(state, ["g"]), ["g"], "n").collect()}
    assert found == want
    assert count_bitmaps(merge_bitmaps(state, []), [], "n").first().n == rows.agg(F.count_distinct("k")).first()[0]
