"""Exact linear-interpolation quantiles, computed distributed.

Same definition as Spark's ``percentile`` (and SQL ``quantile_cont``): for n values,
position = p * (n - 1); the result interpolates between the values at ranks
floor(position) and ceil(position).  ``percentile`` merges every distinct value
into ONE final task; here no task holds more than a range of the distinct values:

1. count rows per distinct value (partial aggregation absorbs hot values);
2. range-partition the distinct values and checkpoint them with their partition id;
3. one total per partition (as many rows as partitions) gives each partition's
   starting rank;
4. a running count inside each partition locates the (at most 2 per quantile) values
   whose rank range covers the needed ranks; only those rows reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed


RANGE_ROWS = 1_000_000  # rows of one range, about


def range_count(rows: int) -> int:
    """How many ranges so many rows are dealt to: it follows the data, not a setting."""
    return max(1, -(-rows // RANGE_ROWS))


def value_counts(df: DataFrame, value: Column) -> DataFrame:
    """v and c: how often each non-NULL value occurs. Counts of several tables add up."""
    return (df.select(value.cast("double").alias("v")).filter(F.col("v").isNotNull())
            .groupBy("v").agg(F.count(F.lit(1)).alias("c")))


def exact_quantiles(df: DataFrame, value: Column, probs: list[float]) -> list[float | None]:
    return quantiles_of_counts(checkpointed(value_counts(df, value)), probs)


def quantiles_of_counts(counts: DataFrame, probs: list[float]) -> list[float | None]:
    """Steps 2 to 4 on a written table of distinct values v and their counts c."""
    spark = counts.sparkSession
    ranged = checkpointed(counts.repartitionByRange(range_count(counts.count()), "v")
                          .select("v", "c", F.spark_partition_id().alias("_pid")))
    totals = sorted((r["_pid"], r["t"]) for r in ranged.groupBy("_pid").agg(F.sum("c").alias("t")).collect())
    n = sum(t for _, t in totals)
    if n == 0:
        return [None for _ in probs]
    offsets, acc = [], 0
    for pid, t in totals:
        offsets.append((pid, acc))
        acc += t
    positions = [p * (n - 1) for p in probs]
    ranks = sorted({int(math.floor(x)) for x in positions} | {int(math.ceil(x)) for x in positions})

    off = spark.createDataFrame(offsets, "_pid int, _off long")  # one row per partition
    upto = Window.partitionBy("_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (ranged.join(F.broadcast(off), "_pid")
              .withColumn("_end", F.col("_off") + F.sum("c").over(upto))  # exclusive
              .withColumn("_start", F.col("_end") - F.col("c")))
    cover = None
    for r in ranks:
        cond = (F.col("_start") <= r) & (F.lit(r) < F.col("_end"))
        cover = cond if cover is None else cover | cond
    hits = [(row["_start"], row["_end"], row["v"]) for row in ranked.filter(cover).select("_start", "_end", "v").collect()]

    def value_at(rank: int) -> float:
        for start, end, v in hits:
            if start <= rank < end:
                return v
        raise AssertionError(f"rank {rank} not covered")

    out = []
    for pos in positions:
        lower, higher = int(math.floor(pos)), int(math.ceil(pos))
        lo_v = value_at(lower)
        if higher == lower:
            out.append(lo_v)
            continue
        hi_v = value_at(higher)
        out.append(lo_v if hi_v == lo_v else (higher - pos) * lo_v + (pos - lower) * hi_v)
    return out
