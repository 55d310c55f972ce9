"""Medallion layers as written tables, built once per session and data folder.

Bronze, Silver and every Gold / star table are written as Parquet under the shared
folder named by ``spark.checkpoint.dir``; later steps read the written table back.
That cuts lineage (a lost executor recomputes from the last written layer, not from
the raw scan) and lets every registered query start from the layer it needs.
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bronze as bronze_ops
from tidemark.operators import gold as gold_ops
from tidemark.operators import star as star_ops
from tidemark.operators.features import add_features
from tidemark.operators.silver import refine_silver
from tidemark.session import WRITTEN, apply_base_conf, checkpoint_root, compiled_methods, shuffles_removed
from tidemark.sources.adapter import raw_order_items
from tidemark.sources.driver_tables import read_table, table_path

_LOCK = threading.RLock()
_BUILT: dict[tuple, str] = {}
_ROWS: dict[str, int] = {}      # rows of each written layer, observed by its write

LANDING_FILES = 5               # of the sorted landing, at least
LANDING_FILE_ROWS = 250_000     # rows of one of them, about: a task sorts them in memory
LANDING_FILES_NAMED = 99_999    # names of more files would not sort as their numbers do
SOURCE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
GOLD_TABLES = list(gold_ops.GOLD_BUILDERS)
STAR_TABLES = ["dim_customer", "dim_product", "dim_date", "dim_location", "dim_shipping", "fact_sales"]


def _version(spark: SparkSession, sf_dir: str) -> str:
    """Changes when a source file is added, replaced or rewritten: layers of other files are not reused."""
    paths = [table_path(sf_dir, t) for t in SOURCE_TABLES]
    if all(os.path.exists(p) for p in paths):
        files = [e for p in paths for e in (os.scandir(p) if os.path.isdir(p) else [p])]
        seen = sorted((os.fspath(f), os.stat(f).st_mtime_ns, os.stat(f).st_size) for f in files)
    else:   # a store that only Spark reads
        seen = spark.read.format("binaryFile").load(paths).agg(
            F.count("*"), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((sf_dir.rstrip("/"), tuple(seen))).encode()).hexdigest()[:16]


def _layer_path(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """The folder of a layer, built by ``build(path)`` once per session and version of the sources."""
    version = _version(spark, sf_dir)
    key = (spark.sparkContext.applicationId, version, name)
    with _LOCK:
        path = _BUILT.get(key)
        if path is None:
            path = f"{checkpoint_root(spark)}/tidemark/{spark.sparkContext.applicationId}/{version}/{name}"
            with compiled_methods(spark), shuffles_removed(spark):
                build(path)
            _BUILT[key] = path
    return path


def _materialise(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    return spark.read.parquet(_layer_path(spark, sf_dir, name, build))


def reset() -> None:
    with _LOCK:
        _BUILT.clear()


def as_of(spark: SparkSession, sf_dir: str) -> str:
    """Ingestion time of the driver tables: their latest shipping date, so that a run can be repeated."""
    return read_table(spark, sf_dir, "lineitem", ["l_shipdate"]).agg(
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0] or "1970-01-01T00:00:00"


def _write(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write a layer and keep its number of rows, counted by the write itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.options(**WRITTEN).mode("overwrite")\
        .partitionBy(*partition_by).parquet(path)
    _ROWS[path] = seen.get["rows"]


def rows_written(spark: SparkSession, sf_dir: str, name: str) -> int:
    """The rows of a layer that has been built, without reading it."""
    return _ROWS[_layer_path(spark, sf_dir, name, None)]


def rows_extracted(spark: SparkSession, sf_dir: str) -> int:
    return _ROWS[_layer_path(spark, sf_dir, "bronze", None) + "/extract"]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_base_conf(spark)

    def build(path):
        extracted, seen = Observation(), Observation()
        raw = raw_order_items(spark, sf_dir).observe(extracted, F.count(F.lit(1)).alias("rows"))
        ts = as_of(spark, sf_dir)
        rows = bronze_ops.ingest_bronze(raw, f"driver-tables:{sf_dir}", ts).observe(seen, F.count(F.lit(1)).alias("rows"))
        bronze_ops.write_bronze(rows.drop("_row_hash"), path, ts[:10])
        _ROWS[path], _ROWS[path + "/extract"] = seen.get["rows"], extracted.get["rows"]
    return bronze_ops.with_row_hash(_materialise(spark, sf_dir, "bronze", build))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(path):
        _write(refine_silver(bronze(spark, sf_dir)).drop("_row_hash"), path)
    return bronze_ops.with_row_hash(_materialise(spark, sf_dir, "silver", build))


def prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver + F1-F7 (row-local, lazily re-derived on read)."""
    return add_features(silver(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    builder = gold_ops.GOLD_BUILDERS[name]

    def build(path):
        _write(builder(prep(spark, sf_dir)), path)
    return _materialise(spark, sf_dir, name, build)


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Dimensions first, then the fact (which looks up the written dimensions)."""
    p = lambda: prep(spark, sf_dir)
    if name == "dim_customer":
        return _materialise(spark, sf_dir, name, lambda path: _write(star_ops.dim_customer(p()), path))
    if name == "dim_product":
        return _materialise(spark, sf_dir, name, lambda path: _write(star_ops.dim_product(p()), path))
    if name == "dim_date":
        return _materialise(spark, sf_dir, name, lambda path: _write(star_ops.dim_date(p()), path))
    if name == "dim_location":
        return _materialise(spark, sf_dir, name, lambda path: _write(star_ops.dim_location(p()), path))
    if name == "dim_shipping":
        return _materialise(spark, sf_dir, name, lambda path: _write(star_ops.dim_shipping(p()), path))
    if name == "fact_sales":
        def build(path):
            f = star_ops.fact_sales(p(), star(spark, sf_dir, "dim_date"), star(spark, sf_dir, "dim_location"),
                                    star(spark, sf_dir, "dim_shipping"), [star_ops.FACT_YEAR])
            _write(f, path, star_ops.FACT_YEAR)     # a file for each year of a task's rows, which are not shuffled for it
        return _materialise(spark, sf_dir, name, build).drop(star_ops.FACT_YEAR)
    raise KeyError(name)


def fact_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with the year that its folders are named by."""
    star(spark, sf_dir, "fact_sales")
    return spark.read.parquet(_layer_path(spark, sf_dir, "fact_sales", None))


def star_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The tables of the star, or those that a query reads (a fact brings the dimensions that it looks its ids up in)."""
    return {n: star(spark, sf_dir, n) for n in STAR_TABLES if names is None or n in names}


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw text rows as landed (Bronze minus its run-specific lineage columns)."""
    from tidemark.schemas import RAW_COLUMNS
    b = bronze(spark, sf_dir)
    return b.select(*[b[f"`{c}`"] for c in RAW_COLUMNS], "_row_number")


def landing_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw rows written once as a latin1 landing CSV folder (input of S1 / X1), a gzip file for each split of Bronze."""
    from tidemark.sources.csv_source import write_raw_csv
    return _layer_path(spark, sf_dir, "landing", lambda path: write_raw_csv(raw(spark, sf_dir), path, compression="gzip"))


def sorted_landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing CSV files whose rows go by order item and digest, through all files in the order of their paths."""
    def build(path):
        from tidemark.sources.csv_source import write_raw_csv
        item = F.col("`Order Item Id`").cast("bigint")
        rows = bronze(spark, sf_dir)
        files = min(max(LANDING_FILES, rows_written(spark, sf_dir, "bronze") // LANDING_FILE_ROWS), LANDING_FILES_NAMED)
        write_raw_csv(rows.repartitionByRange(files, item, F.col("_row_digest")).sortWithinPartitions(item, "_row_digest"), path,
                      compression="gzip")
    return _layer_path(spark, sf_dir, "sorted_landing", build)


def output(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The folder of a sink's output, written once like a layer (no copy per call)."""
    return _layer_path(spark, sf_dir, f"out/{name}", write)


def two_landings(bronze_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two batches of Bronze: the first misses the debit payments; the second, a later ingest, has every row with another
    status and at earlier places, so it brings new order items and repeats the known ones."""
    first = bronze_rows.drop("_ingest_date")
    second = first.withColumns({
        "_ingestion_ts": F.lit("9999-12-31T00:00:00"), "_row_number": F.col("_row_number") - 1_000_000_000_000,
        "Order Status": F.concat(F.col("Order Status"), F.lit(" again"))})
    return first.filter(F.col("Type") != "DEBIT"), second


def landed_store(spark: SparkSession, sf_dir: str):
    """The incremental layers after two landings, one published version for each."""
    from tidemark.incremental.daily import run_batch
    from tidemark.incremental.tables import VersionedTables

    def build(path):
        for n, batch in enumerate(two_landings(bronze(spark, sf_dir))):
            run_batch(VersionedTables(spark, path), batch, n)
    return VersionedTables(spark, output(spark, sf_dir, "landings", build))
