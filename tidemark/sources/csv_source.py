"""CSV source and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import RAW_COLUMNS, RAW_SCHEMA
from tidemark.session import checkpointed

# The text tokens pandas' CSV reader turns into NULL by default.
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# The Gold tables the export accepts.
EXPORTABLE = ["monthly_revenue", "market_performance", "product_performance",
              "customer_segments", "late_delivery_risk", "shipping_efficiency"]

SPLITS_BROADCAST = 500_000   # splits whose offsets are sent to every task; beyond, rows are joined with them

#: RFC 4180: quotes inside a field are doubled; white space is data.
CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def with_nulls(df: DataFrame, null_tokens: list[str] | None = PANDAS_NULL_TOKENS) -> DataFrame:
    """The null rule of the landing files, for batch and stream alike: a field that is one of the
    tokens (an empty field among them, quoted or not) is NULL."""
    if not null_tokens:
        return df
    return df.withColumns({c: F.when(F.col(f"`{c}`").isin(null_tokens), F.lit(None)).otherwise(F.col(f"`{c}`"))
                           for c in RAW_COLUMNS})


def with_file_order(df: DataFrame) -> DataFrame:
    """``_source_file``, ``_file_block`` and ``_row_number`` of rows read from files: the file's path, the first byte of the
    split, and a number that grows by one from row to row of a split (one task reads it from end to end)."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                     F.col("_metadata.file_block_start").alias("_file_block"),
                     F.monotonically_increasing_id().alias("_row_number"))


def read_raw_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1",
                 null_tokens: list[str] | None = PANDAS_NULL_TOKENS, multi_line: bool = False) -> DataFrame:
    """The landing CSV as 53 TEXT columns + the place of each row in its file.

    Explicit schema (no inference pass); latin1 decodes every byte, so there is no
    retry path.  ``multi_line`` allows line breaks inside quoted fields, at the price of
    one task per file.  A missing path raises ``AnalysisException`` [PATH_NOT_FOUND].
    """
    df = spark.read.schema(RAW_SCHEMA).options(encoding=encoding, multiLine=multi_line, **CSV_OPTIONS).csv(path)
    return with_nulls(with_file_order(df), null_tokens)


def _split_shifts(rows: DataFrame, place: list[str]) -> DataFrame:
    """For each split (written): how far ``_row_number`` is from 1..n over all rows, and the split's number of rows."""
    splits = checkpointed(rows.groupBy(*place).agg(F.min("_row_number").alias("_first"), F.count(F.lit(1)).alias("_n")))
    before = Window.orderBy("_source_file", "_file_block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(*place, "_first", "_n", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))


def _shifted(rows: DataFrame, shifts: DataFrame, place: list[str], columns: list[str]) -> DataFrame:
    return (rows.join(shifts.drop("_first", "_n"), place).withColumn("_row_number", F.col("_row_number") + F.col("_shift"))
            .select(*[F.col(f"`{c}`") for c in columns]))


def dense_row_numbers(landed: DataFrame) -> DataFrame:
    """``_row_number`` as 1..n over all rows, in the order of file path, split and position.

    ``landed`` is a written table of rows with ``with_file_order``, so that their places are fixed.  One narrow pass
    gives each split its first place and its number of rows; a running sum over splits gives each its offset.
    Only that table (one row for 128 MB of input, say) is ordered as a whole; no row is sorted or shuffled.
    """
    place = ["_source_file", "_file_block"]
    shifts = _split_shifts(landed, place)
    if shifts.count() <= SPLITS_BROADCAST:
        shifts = F.broadcast(shifts)
    return _shifted(landed, shifts, place, landed.columns)


def dense_scan_numbers(scan: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """S4 on files that are scanned twice in place of being written in between, and what number each split begins with;
    None where the splits are too many to be sent to every task.

    Numbers of the second scan are those of the first where both deal the same splits to the same tasks; ``numbered_so`` tells.
    """
    place = ["_task", "_source_file", "_file_block"]
    rows = scan.withColumn("_task", F.spark_partition_id())
    shifts = _split_shifts(rows, place)
    if shifts.count() > SPLITS_BROADCAST:
        return None
    starts = shifts.select(*place[1:], (F.col("_first") + F.col("_shift")).alias("_start"), "_n")
    return _shifted(rows, F.broadcast(shifts), place, scan.columns), starts


def numbered_so(written: DataFrame, starts: DataFrame) -> bool:
    """Whether each split's rows are all there and begin with its number: one narrow pass over what was written."""
    found = written.groupBy("_source_file", "_file_block").agg(F.min("_row_number").alias("_start"), F.count(F.lit(1)).alias("_n"))
    return found.join(starts, starts.columns).count() == starts.count()


def write_raw_csv(raw: DataFrame, path: str, encoding: str = "ISO-8859-1", compression: str = "none") -> None:
    """Landing-file writer (the reverse of S1), whitespace kept as is.  A file of ``gzip`` is read by one task: write as
    many as there shall be tasks."""
    (raw.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])
     .write.mode("overwrite").options(encoding=encoding, compression=compression, **CSV_OPTIONS).csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    """Header + RFC-4180 quoting (a comma inside a value stays in its field)."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def export_gold(df: DataFrame, table: str, path: str) -> str:
    """Export one of the six Gold tables as CSV; other names are refused."""
    if table not in EXPORTABLE:
        raise ValueError(f"Unknown table: {table!r} (allowed: {', '.join(EXPORTABLE)})")
    write_csv(df, path)
    return path
