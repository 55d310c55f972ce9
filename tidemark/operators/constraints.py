"""Constraint enforcement on load (S10, J8): rows that break a key go to a reject table with the reasons, the rest loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import FOREIGN_KEYS, PRIMARY_KEYS
from tidemark.session import checkpointed

REASONS = "reject_reasons"


def judged(fact: DataFrame, dims: dict[str, DataFrame], order: list[str], pk: str = PRIMARY_KEYS["fact_sales"]) -> DataFrame:
    """The fact with ``reject_reasons``, sorted: ``null_key``, ``duplicate_key``, and ``orphan:<column>`` for each foreign key
    without its row in the dimension; empty for rows that may load.

    Of rows with one primary key, that which comes first by ``order`` loads (rows that are equal in it are told apart by
    their content, equal rows by a number that they get when they are written); a NULL foreign key is no orphan (as in
    SQL ``REFERENCES``).  The winner of each key comes from an aggregate over narrow columns, which combines on the map side,
    so a hot key does not pile up.  Dimension keys are joined as they are: AQE broadcasts those that are small and
    splits a hot foreign key.
    """
    columns = fact.columns
    content = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    rank = F.struct(*[F.col(f"`{c}`") for c in order], content.alias("_content"), F.col("_row"))
    numbered = checkpointed(fact.withColumn("_row", F.monotonically_increasing_id())).withColumn("_rank", rank)
    # NULL keys are rejected as such and take no part in the joins
    first = (numbered.filter(F.col(pk).isNotNull()).groupBy(F.col(pk).alias("_pk"))
             .agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1))
    out = numbered.join(first, numbered[pk] == first["_pk"], "left")
    reasons = [F.when(F.col(pk).isNull(), F.lit("null_key")),
               F.when(F.col("_pk").isNotNull() & (F.col("_rank") != F.col("_first")), F.lit("duplicate_key"))]
    for fk, dim, key in FOREIGN_KEYS:
        have = dims[dim].select(F.col(key).alias(f"_has_{fk}")).filter(F.col(key).isNotNull()).distinct()
        out = out.join(have, out[fk] == have[f"_has_{fk}"], "left")
        reasons.append(F.when(F.col(fk).isNotNull() & F.col(f"_has_{fk}").isNull(), F.lit(f"orphan:{fk}")))
    return out.select(*[F.col(f"`{c}`") for c in columns], F.array_sort(F.filter(F.array(*reasons), lambda r: r.isNotNull())).alias(REASONS))


def split_load(fact: DataFrame, dims: dict[str, DataFrame], order: list[str], path: str) -> tuple[DataFrame, DataFrame]:
    """Write the judged fact in one pass, accepted and rejected rows in folders of their own; both, read back."""
    rows = judged(fact, dims, order).withColumn("_rejected", F.size(REASONS) > 0)
    rows.write.mode("overwrite").partitionBy("_rejected").parquet(path)
    back = fact.sparkSession.read.schema(rows.schema).parquet(path)
    return (back.filter(~F.col("_rejected")).drop("_rejected", REASONS), back.filter(F.col("_rejected")).drop("_rejected"))
