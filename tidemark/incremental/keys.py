"""Surrogate keys that stay (W8, J7, D3-D5): a persistent map from natural keys to ids.

Known natural keys keep their id. Those that a batch brings are found by an anti-join, numbered in the order of their
natural key, and go on from the highest id. Nothing that has been written is renumbered, so facts of earlier batches stay
right; the first batch gives the same ids as a run from scratch.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.incremental.silver import merged
from tidemark.incremental.tables import Version, VersionedTables, at_once
from tidemark.operators.star import LOCATION_COLS, LOCATION_KEY, SHIPPING_COLS, _surrogate

# dimension: (id column, natural key)
KEY_MAPS = {"dim_date": ("date_id", ["full_date"]), "dim_location": ("location_id", LOCATION_COLS),
            "dim_shipping": ("shipping_id", SHIPPING_COLS)}


def null_safe(left: DataFrame, right: DataFrame, columns: list[str], prefix: str = ""):
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[prefix + c])
    return cond


def assign(store: VersionedTables, version: Version, name: str, rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """The key map of a dimension after the rows of a batch, and its folders."""
    id_col, natural = KEY_MAPS[name]
    table = f"keys_{name}"
    known = store.read(table, version)
    new = rows.select(*natural).filter(F.col("full_date").isNotNull() if name == "dim_date" else F.lit(True)).distinct()
    first = 0
    if known is not None:
        first = known.agg(F.max(id_col)).first()[0] or 0
        new = new.join(known, null_safe(new, known, natural), "left_anti")
    numbered = _surrogate(new, id_col, natural).withColumn(id_col, F.col(id_col) + F.lit(first))
    folder = store.write(numbered, table)
    folders = merged(store, [*version.of(table), folder], table, numbered.schema, lambda df: df)
    return store.read_folders(folders, numbered.schema), folders


def natural_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("full_date", F.to_date("order_date"))


def add_batch(store: VersionedTables, version: Version, rows: DataFrame) -> tuple[dict[str, DataFrame], dict[str, list[str]]]:
    """Key maps after the batch's first rows (trimmed or not: a key once given is never taken back)."""
    rows = natural_keys(rows)
    found = at_once({name: partial(assign, store, version, name, rows) for name in KEY_MAPS})
    return {name: found[name][0] for name in KEY_MAPS}, {f"keys_{name}": found[name][1] for name in KEY_MAPS}


def with_ids(rows: DataFrame, maps: dict[str, DataFrame]) -> DataFrame:
    """J7 on the maps: rows with date_id, location_id (the highest of equal five-column keys) and shipping_id."""
    dates, shipping = maps["dim_date"], maps["dim_shipping"]
    places = maps["dim_location"].groupBy(*LOCATION_KEY).agg(F.max("location_id").alias("location_id"))
    out = natural_keys(rows)
    for lookup, columns, id_col in ((dates, ["full_date"], "date_id"), (places, LOCATION_KEY, "location_id"),
                                    (shipping, SHIPPING_COLS, "shipping_id")):
        side = lookup.select(id_col, *[F.col(c).alias("_k_" + c) for c in columns])
        out = out.join(side, null_safe(out, side, columns, "_k_"), "left").drop(*["_k_" + c for c in columns])
    return out.drop("full_date")


def dimension(store: VersionedTables, name: str, version: Version | None = None) -> DataFrame:
    """Id and natural key of every key given so far."""
    return store.read(f"keys_{name}", version or store.current())
