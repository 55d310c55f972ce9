"""Exact distinct counts that can be merged: bitmaps over whole-number ids.

``count_distinct`` over months cannot be added up, since a customer buys in several.  A bitmap of the ids met can: the state
of a group is one bitmap for each block of 32,768 ids (4 KB), built and joined by built-in aggregates, and the union
over months, batches or groups is the bitwise OR.  This pays where ids are dense (surrogate keys, order numbers that count
up): a block of which one id is used costs as much as a full one.  Ids must not be negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "id_block", "id_bits"


def id_bitmaps(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """State: keys, id_block, id_bits. NULL ids count as none."""
    one = df.filter(F.col(id_col).isNotNull())
    return (one.groupBy(*keys, F.bitmap_bucket_number(id_col).alias(BLOCK))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias(BITS)))


def merge_bitmaps(state: DataFrame, keys: list[str]) -> DataFrame:
    """The state over coarser keys, or of several states united."""
    return state.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_bitmaps(state: DataFrame, keys: list[str], alias: str) -> DataFrame:
    """Distinct ids for each group of a merged state."""
    return state.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(alias))
