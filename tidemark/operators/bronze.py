"""Bronze: raw rows + lineage columns, appended."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_digest, row_hash
from tidemark.schemas import LINEAGE_COLUMNS, RAW_COLUMNS, ROW_COLUMNS
from tidemark.session import WRITTEN


def stamp_row_number(raw: DataFrame) -> DataFrame:
    """Position of a row inside the file split it was read from, where the rows have no number yet.

    ``monotonically_increasing_id`` grows along a task's rows, and a split is read by one
    task, so within (``_source_file``, ``_file_block``) it is the order of the file.  Across splits it
    means nothing: Spark packs splits by size.  ``csv_source.dense_row_numbers`` makes 1..n of it (S4).
    """
    if "_row_number" in raw.columns:
        return raw
    return raw.withColumn("_row_number", F.monotonically_increasing_id())


def ingest_bronze(raw: DataFrame, source_file: str, ingestion_ts: str | None = None) -> DataFrame:
    """S2 + S3: add ``_ingestion_ts``, ``_source_file``, ``_row_number``, ``_row_hash`` and, of our
    own, ``_file_block``, ``_row_digest`` and ``_row_uid`` (see ``schemas.ROW_COLUMNS``)."""
    ts = ingestion_ts or datetime.now(timezone.utc).isoformat()
    data_cols = [c for c in raw.columns if c not in LINEAGE_COLUMNS + ROW_COLUMNS]
    hashed = [c for c in RAW_COLUMNS if c in data_cols] or data_cols
    # a per-row source (e.g. the landing file name) wins over the constant
    source = F.col("_source_file") if "_source_file" in raw.columns else F.lit(source_file)
    block = F.col("_file_block") if "_file_block" in raw.columns else F.lit(0)
    df = stamp_row_number(raw).withColumn("_row_digest", row_digest(hashed))
    return df.select(
        *[F.col(f"`{c}`") for c in data_cols],
        F.lit(ts).alias("_ingestion_ts"),
        source.alias("_source_file"),
        F.col("_row_number").cast("bigint").alias("_row_number"),
        row_hash(F.col("_row_digest")).alias("_row_hash"),
        block.cast("bigint").alias("_file_block"),
        "_row_digest",
        F.monotonically_increasing_id().alias("_row_uid"),
    )


def with_row_hash(stored: DataFrame) -> DataFrame:
    """Rows stored without ``_row_hash``, with it in its place: it is the first half of the digest, so a layer that keeps the
    digest need not hold it twice."""
    at = stored.columns.index("_row_number") + 1
    cols = [F.col(f"`{c}`") for c in stored.columns]
    return stored.select(*cols[:at], row_hash(F.col("_row_digest")).alias("_row_hash"), *cols[at:])


def write_bronze(bronze: DataFrame, path: str, ingest_date: str | None = None) -> None:
    """Append-only: every run adds its files under ``_ingest_date=<date>``; nothing is
    overwritten.  One run has one ingestion timestamp, so with ``ingest_date`` given
    the run writes straight into that partition folder (same layout as
    ``partitionBy``, without sorting every row by a constant partition value)."""
    if ingest_date:
        bronze.write.options(**WRITTEN).mode("append").parquet(f"{path.rstrip('/')}/_ingest_date={ingest_date}")
        return
    (bronze.withColumn("_ingest_date", F.to_date(F.substring("_ingestion_ts", 1, 10)))
     .write.options(**WRITTEN).mode("append").partitionBy("_ingest_date").parquet(path))


def bronze_stats(bronze: DataFrame) -> DataFrame:
    """Rows, columns, null cells and duplicate rows (by the digest).

    The distinct count is an aggregate of its own over one column; next to it the other
    counters would all be shuffled by the digest.
    """
    cols = [c for c in bronze.columns if c not in ["_ingest_date", *ROW_COLUMNS]]
    null_cells = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in cols), F.lit(0))
    distinct = bronze.agg(F.count_distinct("_row_digest")).scalar()
    return bronze.agg(F.count(F.lit(1)).alias("rows"), null_cells.cast("bigint").alias("null_cells")).select(
        "rows", F.lit(len(cols)).cast("bigint").alias("columns"), "null_cells",
        (F.col("rows") - distinct).alias("duplicate_hashes"))
