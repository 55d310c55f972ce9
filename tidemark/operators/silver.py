"""Silver: typed, deduplicated, cleaned order items (P1-P12, P3 rename)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.quantiles import exact_quantiles
from tidemark.functions.text import normalise, snake_case_name
from tidemark.schemas import (DATE_COLUMNS, ID_COLUMNS, MONEY, NULL_FILLS, NUMERIC_TYPES,
                              OTHER_NUMERIC, RAW_DATE_FORMAT, RENAME_MAP, SALES_TRIM_BAND,
                              SILVER_DROP, STRING_COLUMNS)
from tidemark.session import checkpointed

BRONZE_ONLY = ["_ingest_date"]
# First seen: the earliest ingest, then file, split and position; equal positions by content.
FILE_ORDER = ["_ingestion_ts", "_source_file", "_file_block", "_row_number", "_row_digest"]
ROW_ID = ["_ingestion_ts", "_row_uid"]
MARKS_BROADCAST = 16_384   # bitmaps of 4 kB sent to every task (64 MB, for about 500 million rows); beyond, rows are joined with them


def q(name: str):
    return F.col(f"`{name}`")


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop listed columns; absent names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def coerce_numeric(c, kind: str):
    """Bad text -> NULL (``try_cast``; plain cast raises under ANSI)."""
    if kind == "money":
        return c.try_cast(MONEY)
    if kind == "double":
        return c.try_cast("double")
    # whole numbers: through DOUBLE so that "7.0" parses
    return c.try_cast("double").try_cast("bigint")


def enforce_types(df: DataFrame) -> DataFrame:
    kinds = dict(NUMERIC_TYPES)
    kinds.update(OTHER_NUMERIC)
    kinds.update({c: "bigint" for c in ID_COLUMNS})
    return df.withColumns({c: coerce_numeric(q(c), k) for c, k in kinds.items() if c in df.columns})


def parse_dates(df: DataFrame) -> DataFrame:
    """P6: 'M/d/yyyy H:mm' text -> wall-clock TIMESTAMP_NTZ (the text carries no
    zone); unparseable -> NULL."""
    out = df.withColumns({new: F.try_to_timestamp(q(raw), F.lit(RAW_DATE_FORMAT)).cast("timestamp_ntz")
                          for raw, new in DATE_COLUMNS.items() if raw in df.columns})
    return out.drop(*[raw for raw in DATE_COLUMNS if raw in df.columns])


def typed(df: DataFrame) -> DataFrame:
    """P4-P6, row-local."""
    return parse_dates(enforce_types(df))


def drop_bad_dates(df: DataFrame, col: str = "order_date") -> DataFrame:
    """P7."""
    return df.filter(F.col(col).isNotNull())


def dedup_keep_first(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """One row per ``key``, the first by ``order_cols``; NULL keys form one group (as
    pandas ``duplicated`` does).

    ``row_number = 1`` plans a group limit on the map side, so a key holding a third of all
    rows sends one row per map task.  Rows are sorted by the key: give this few columns
    (``first_rows`` does, for wide rows).
    """
    w = Window.partitionBy(q(key)).orderBy(*[q(c) for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_rows(df: DataFrame, key: str, *also: str) -> DataFrame:
    """The first row of each key in file order, as (key, row id, ``also``): a narrow table, written once
    (checkpoint), for picking the wide rows and for the bounds.  The digest, which decides between equal positions,
    is not written."""
    cols = list(dict.fromkeys([key, *ROW_ID, *also]))
    narrow = df.select(*[q(c) for c in dict.fromkeys([*cols, *FILE_ORDER])])
    return checkpointed(dedup_keep_first(narrow, key, [*FILE_ORDER, "_row_uid"]).select(*[q(c) for c in cols]))


def row_marks(rows: DataFrame) -> DataFrame:
    """The row ids of ``rows`` as bitmaps: a bit for each stored row, 32,768 of them in a row of 4 kB (written).
    Ids move to their bitmap's task, so that no task builds bitmaps that others would have to add to."""
    bucket = F.bitmap_bucket_number("_row_uid").alias("_bucket")
    ids = rows.select("_ingestion_ts", bucket, F.bitmap_bit_position("_row_uid").alias("_bit"))
    return checkpointed(ids.repartition("_ingestion_ts", "_bucket").groupBy("_ingestion_ts", "_bucket")
                        .agg(F.bitmap_construct_agg("_bit").alias("_bits")))


def pick_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ids are in ``rows``, without moving ``df``, which is wide.

    Every row looks itself up in the bitmaps of ``row_marks``.  Up to MARKS_BROADCAST of them go to every task, in a
    session that allows broadcasts at all; beyond, rows are joined with them as AQE plans it (it can spill, and is a
    hash join where AQE measures the marks, or each of their partitions, to be small: see ``session.BASE_CONF``).
    """
    spark, marks = df.sparkSession, row_marks(rows)
    if not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-") and marks.count() <= MARKS_BROADCAST:
        marks = F.broadcast(marks)
    found = df.withColumn("_bucket", F.bitmap_bucket_number("_row_uid")).join(marks, ["_ingestion_ts", "_bucket"])
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_row_uid) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    bit = F.getbit(byte, (F.bitmap_bit_position("_row_uid") % 8).cast("int"))
    return found.filter(bit == 1).select(*[q(c) for c in df.columns])


def fill_nulls(df: DataFrame, fills: dict | None = None) -> DataFrame:
    """P9."""
    fills = {k: v for k, v in (fills or NULL_FILLS).items() if k in df.columns}
    return df.fillna(fills)


def normalise_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P10: strip + Python-style title case; NULL stays NULL (no 'Nan' text)."""
    return df.withColumns({c: normalise(q(c)) for c in (cols or STRING_COLUMNS) if c in df.columns})


def percentile_bounds(df: DataFrame, col: str, band=SALES_TRIM_BAND) -> tuple[float | None, float | None]:
    """Exact linear-interpolation percentiles (lo, hi) of ``col``, computed distributed
    (see ``functions.quantiles``); only the two numbers come back to the driver."""
    lo, hi = exact_quantiles(df, q(col), list(band))
    return lo, hi


def percentile_trim(df: DataFrame, col: str = "Sales", band=SALES_TRIM_BAND) -> DataFrame:
    """Keep lo <= x <= hi (inclusive); NULL x is dropped.

    The bounds are two numbers from a distributed exact selection; the frame is filtered
    with them as literals (no join, no repeated subquery).
    """
    lo, hi = percentile_bounds(df, col, band)
    x = q(col).cast("double")
    if lo is None:  # no non-NULL value: every row fails the comparison, as in pandas
        return df.filter(F.lit(False))
    return df.filter((x >= F.lit(lo)) & (x <= F.lit(hi)))


def rename_to_snake(df: DataFrame) -> DataFrame:
    """P3 rename map, then the P2 header rule for names the map does not list."""
    mapping = {c: RENAME_MAP.get(c, snake_case_name(c)) for c in df.columns
               if not c.startswith("_")}
    return df.withColumnsRenamed(mapping)


def refine_silver(bronze: DataFrame, band=SALES_TRIM_BAND) -> DataFrame:
    """Bronze -> Silver, in the reference's order of steps.

    One narrow pass picks the surviving row of each order item; the trim bounds come from
    the same table.  The columns of FILE_ORDER are kept: they define "first seen" for the
    customer and product dimensions.
    """
    rows = drop_columns(bronze, SILVER_DROP + BRONZE_ONLY)
    first = first_rows(drop_bad_dates(typed(rows)), "Order Item Id", "Sales")
    df = normalise_strings(fill_nulls(typed(pick_rows(rows, percentile_trim(first, "Sales", band)))))
    return rename_to_snake(df.drop("_row_uid").withColumn("_silver_processed", F.lit(True)))
