"""One pipeline run — extract, validate, Bronze, Silver, Gold + star, load — with
per-stage counts (S11) written to a ``pipeline_runs`` table.

Every stage boundary is a written table, read back by the next stage; the landing files are read once.
Counts are observed while the tables are written (``Observation``): no table is scanned again for them.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import gold as gold_ops
from tidemark.operators import star as star_ops
from tidemark.operators.bronze import ingest_bronze
from tidemark.operators.features import add_features
from tidemark.operators.silver import refine_silver
from tidemark.operators.validate import issue_report
from tidemark.schemas import LOAD_ORDER
from tidemark.sources.csv_source import dense_row_numbers, read_raw_csv, write_csv
from tidemark.sources.loader import load_star


COUNTS = "stage string, metric string, value bigint"


def write_observed(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write a table; its number of rows, counted by the write itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return seen.get["rows"]


def stage_counts(spark: SparkSession, extracted: int, issues: int, bronze: int, silver: int, tables: dict[str, int]) -> DataFrame:
    """One row per (stage, metric)."""
    rows = [("extract", "rows", extracted), ("validate", "total_issues", issues), ("bronze", "rows", bronze), ("silver", "rows", silver)]
    return spark.createDataFrame(rows + [("gold", name, n) for name, n in tables.items()], COUNTS)


def record_run(counts: DataFrame, path: str, finished_at: str) -> DataFrame:
    """Append the counts of one run, with its id and time, to the ``pipeline_runs`` table; returns the run's rows."""
    run_id = uuid.uuid4().hex
    (counts.withColumns({"run_id": F.lit(run_id), "finished_at": F.lit(finished_at)})
     .write.mode("append").parquet(path))
    return counts.sparkSession.read.parquet(path).where(F.col("run_id") == run_id)


def run_pipeline(spark: SparkSession, landing_csv: str, out_root: str, encoding: str = "ISO-8859-1",
                 load_target: str | None = None) -> DataFrame:
    """Run every stage over a landing CSV folder; returns the run's rows of ``pipeline_runs``."""
    root = out_root.rstrip("/")
    ts = datetime.now(timezone.utc).isoformat()
    counts = {"extract": write_observed(read_raw_csv(spark, landing_csv, encoding), f"{root}/extract")}
    raw = dense_row_numbers(spark.read.parquet(f"{root}/extract"))
    found = Observation()
    write_csv(issue_report(raw).observe(found, F.sum("count").alias("issues")), f"{root}/validation_report")
    counts["bronze"] = write_observed(ingest_bronze(raw, landing_csv, ts), f"{root}/bronze/_ingest_date={ts[:10]}", "append")
    counts["silver"] = write_observed(refine_silver(spark.read.parquet(f"{root}/bronze")), f"{root}/silver")
    prep = add_features(spark.read.parquet(f"{root}/silver"))
    written, tables = {}, {}

    def put(name: str, df: DataFrame) -> None:
        written[name] = write_observed(df, f"{root}/gold/{name}")
        tables[name] = spark.read.parquet(f"{root}/gold/{name}")

    for name, build in gold_ops.GOLD_BUILDERS.items():
        put(name, build(prep))
    for name in ["dim_customer", "dim_product", "dim_date", "dim_location", "dim_shipping"]:
        put(name, getattr(star_ops, name)(prep))
    put("fact_sales", star_ops.fact_sales(prep, tables["dim_date"], tables["dim_location"], tables["dim_shipping"]))
    if load_target:
        load_star(spark, {name: tables[name] for name in LOAD_ORDER}, load_target)
    return record_run(stage_counts(spark, counts["extract"], found.get["issues"] or 0, counts["bronze"], counts["silver"], written),
                      f"{root}/pipeline_runs", ts)
