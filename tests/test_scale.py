"""What the layers move and write: wide rows stay where they are, tables are written small."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from tidemark.plans import layers


def test_bronze_rows_are_shuffled_by_joins_only(spark, sf_small):
    """No shuffle of its own for balance, and the last join deals the rows, also where the others are broadcasts."""
    from tidemark.sources.adapter import order_items_typed, raw_order_items
    optimized = raw_order_items(spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" not in optimized and "strategy=merge" in optimized
    items = order_items_typed(spark, sf_small)
    assert items.count() == spark.read.parquet(f"{sf_small}/lineitem.parquet").count()


def test_written_layers_are_zstd(spark, sf_small):
    import pyarrow.parquet as pq
    layers.bronze(spark, sf_small)
    files = glob.glob(f'{layers._layer_path(spark, sf_small, "bronze", None)}/**/*.parquet', recursive=True)
    assert files
    for f in files:
        assert pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD"


def _stored(spark, n):
    """Rows of two ingests in three partitions each, with ids as Bronze gives them and a wide text."""
    one = spark.range(0, n, numPartitions=3).select(F.monotonically_increasing_id().alias("_row_uid"), F.col("id").alias("k"))
    return one.select("*", F.lit("2026-01-01").alias("_ingestion_ts"), F.repeat(F.lit("x"), 50).alias("wide")).unionByName(
        one.select("*", F.lit("2026-01-02").alias("_ingestion_ts"), F.repeat(F.lit("y"), 50).alias("wide")))


def test_picked_rows_are_those_of_the_ids(spark):
    """Ids at the ends of bytes, bitmaps and partitions, and of one ingest only; a repeated id counts once."""
    from tidemark.operators.silver import ROW_ID, pick_rows
    df = _stored(spark, 210_000)
    at = F.col("_row_uid") % 32_768
    ids = df.filter(((F.col("k") % 7 == 0) & (F.col("_ingestion_ts") == "2026-01-01")) | at.isin(0, 1, 7, 8, 9, 32_767)).select(*ROW_ID)
    ids = ids.unionByName(ids.limit(50))
    want = df.join(ids, ROW_ID, "left_semi").select(*df.columns)
    got = pick_rows(df, ids)
    assert got.columns == df.columns
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_wide_rows_are_not_shuffled_when_picked(spark):
    """Also where the narrow side is beyond Spark's own broadcast limit."""
    from tidemark.operators.silver import ROW_ID, pick_rows
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = _stored(spark, 3000)
        picked = pick_rows(df, df.filter("k % 2 = 0").select(*ROW_ID))
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert picked.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_landing_files_are_compressed_and_grow_in_number(spark, sf_small, monkeypatch):
    from tidemark.sources.csv_source import read_raw_csv
    n = layers.bronze(spark, sf_small).count()
    monkeypatch.setattr(layers, "LANDING_FILE_ROWS", n // 9)
    real = layers._layer_path
    monkeypatch.setattr(layers, "_layer_path", lambda s, d, name, build: real(s, d, name + "_test" if "landing" in name else name, build))
    for folder, files in ((layers.landing_csv(spark, sf_small), 1), (layers.sorted_landing(spark, sf_small), 9)):
        names = glob.glob(folder + "/part-*")
        assert len(names) >= files and all(f.endswith(".csv.gz") for f in names)
        assert read_raw_csv(spark, folder).count() == n


def test_digests_are_short_and_hashes_are_not_stored(spark, sf_small):
    """A digest is 16 bytes in each layer; the hash that queries show is its first half, made when a layer is read."""
    import hashlib
    from tidemark.schemas import RAW_COLUMNS
    for name, layer in (("bronze", layers.bronze), ("silver", layers.silver)):
        rows = layer(spark, sf_small)
        stored = spark.read.parquet(layers._layer_path(spark, sf_small, name, None))
        assert "_row_hash" in rows.columns and "_row_hash" not in stored.columns
        assert rows.columns.index("_row_hash") == rows.columns.index("_row_number") + 1
        assert stored.filter(F.octet_length("_row_digest") != 16).isEmpty() and not stored.isEmpty()
    for r in layers.bronze(spark, sf_small).limit(20).collect():
        text = "|".join("nan" if r[c] is None else r[c] for c in RAW_COLUMNS)
        digest = hashlib.sha256(text.encode()).hexdigest()
        assert (bytes(r["_row_digest"]).hex(), r["_row_hash"]) == (digest[:32], digest[:16])


def test_lineitem_is_shuffled_as_what_is_used_of_it(spark, sf_small):
    """No text and no timestamp of lineitem goes through the joins: kind of payment, tax and discount are one number."""
    from tidemark.sources.adapter import order_items_typed
    types = dict(order_items_typed(spark, sf_small).dtypes)
    assert not {"l_returnflag", "l_linestatus", "l_tax", "l_discount", "l_shipdate", "l_extendedprice", "p_retailprice"} & set(types)
    assert types["_marks"] == "int" and types["_ship_day"] == "date" and types["_sales"] == "decimal(12,2)"


def test_fact_rows_are_not_shuffled_to_their_years(spark, sf_small, monkeypatch):
    """Each task writes its rows into the folders of the years; the folders hold every row under its year."""
    layers.star_tables(spark, sf_small)
    plans, real_path, real_write = [], layers._layer_path, layers._write
    monkeypatch.setattr(layers, "_layer_path", lambda s, d, name, build: real_path(s, d, name + "_test" if name == "fact_sales" else name, build))
    monkeypatch.setattr(layers, "_write", lambda df, path, *by: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()),
                                                                 real_write(df, path, *by)))
    fact = layers.fact_by_year(spark, sf_small)
    assert len(plans) == 1 and "Repartition" not in plans[0]
    assert fact.count() == layers.silver(spark, sf_small).count()
    dates = layers.star(spark, sf_small, "dim_date").select("date_id", "year")
    assert fact.join(dates, "date_id").filter("order_year <> year").isEmpty()
    assert {r[0] for r in fact.select("order_year").distinct().collect()} == {
        int(f.split("=")[1]) for f in glob.glob(layers._layer_path(spark, sf_small, "fact_sales", None) + "/order_year=*")}


def test_dashboard_queries_build_the_star_tables_they_read(spark, sf_small, monkeypatch):
    """No dimension is made for a query that reads neither it nor a fact that looks ids up in it."""
    from tidemark.plans.catalog import QUERIES
    asked, real = set(), layers.star
    monkeypatch.setattr(layers, "star", lambda s, d, name: (asked.add(name), real(s, d, name))[1])
    looked_up = {"fact_sales", "dim_date", "dim_location", "dim_shipping"}
    for query, more in (("dash_late_by_mode", set()), ("dash_kpis", set()), ("dash_category", {"dim_product"}),
                        ("mergeable_distinct", set()), ("dashboard_slice", {"dim_customer"}), ("distinct_values", {"dim_customer"})):
        asked.clear()
        assert QUERIES[query](spark, sf_small).count() > 0
        assert "fact_sales" in asked and more <= asked <= looked_up | more, query
    assert set(layers.star_tables(spark, sf_small)) == set(layers.STAR_TABLES)


def test_plain_text_is_title_cased_without_cutting_it(spark):
    """Words that start after a space take ``initcap``; only other text is cut at its words, and both give Python's result."""
    from tidemark.functions.text import normalise, title_case
    values = ["", " ", "south\t ", "\t north", "two  words", "MIDDLE EAST", "town-3 of france", "st12", "3d", "men's", "a_b", "_x", "dri-fit 3D",
              "x\ty", "m\u00e1laga", "SAO PAULO\u00e9", "9 quai 7", "end\n", "\x0b\x0cmid dle\r", "#tag", "a.b c", "o'neil mcDONALD", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select("s", normalise(F.col("s")).alias("n"), title_case(F.col("s")).alias("t")).collect()
    assert [(r["n"], r["t"]) for r in rows] == [(v, v) if v is None else (v.strip().title(), v.title()) for v in values]
    for made in (normalise, title_case):
        plan = df.select(made(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()
        assert "initcap" in plan and "CASE WHEN" in plan


def test_analyses_build_the_star_tables_they_read(spark, sf_small, monkeypatch):
    """Those over customers make no fact; the others make the fact, what it looks ids up in, and their own dimension."""
    from tidemark.plans.catalog import QUERIES
    from tidemark.plans.sql_analytics import ANALYSES, READS
    asked, real = set(), layers.star
    monkeypatch.setattr(layers, "star", lambda s, d, name: (asked.add(name), real(s, d, name))[1])
    looked_up = {"fact_sales", "dim_date", "dim_location", "dim_shipping"}
    assert set(READS) == set(ANALYSES)
    for query in ANALYSES:
        asked.clear()
        assert QUERIES[query](spark, sf_small).count() > 0
        assert set(READS[query]) <= asked
        if query in ("sql_top_customers", "sql_retention"):
            assert asked == {"dim_customer"}, query
        else:
            assert asked <= looked_up | set(READS[query]) and "dim_customer" not in asked, query


def test_shuffle_files_go_when_a_layer_is_written(spark, sf_small):
    import time
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (f.rsplit("/", 1)[-1] for f in files.mkString("\n").split("\n")) if n.startswith("shuffle_")}

    def build(path):
        assert spark.conf.get(name) == "true"
        before, deadline = shuffles(), time.time() + 20
        spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(path)
        while shuffles() - before and time.time() < deadline:
            time.sleep(0.2)
        left.update(shuffles() - before)

    left = set()
    assert spark.read.parquet(layers._layer_path(spark, sf_small, "shuffled_test", build)).count() == 7
    assert spark.conf.get(name) == was and not left
