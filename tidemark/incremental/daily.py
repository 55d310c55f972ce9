"""One day's batch through every layer, published as one version (the reference's daily job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.incremental import gold, keys, silver
from tidemark.incremental.tables import Version, VersionedTables, at_once
from tidemark.operators.features import add_features
from tidemark.operators.star import FACT_COLUMNS
from tidemark.session import checkpointed
from tidemark.streaming.incremental_bronze import ingest_batch, run_landing


def run_batch(store: VersionedTables, bronze: DataFrame, batch: int, key_parts: int = silver.KEY_PARTS) -> Version:
    """Take a batch of Bronze through Silver, Gold state, key maps and facts; readers see all of it or nothing.

    Batches have growing numbers; one that has been published is not applied again, so a replay changes nothing.
    """
    version = store.current()
    if version.batch is not None and batch <= version.batch:
        return version
    step = silver.add_batch(store, version, bronze, parts=key_parts)
    maps, key_folders = keys.add_batch(store, version, step.rows)
    facts = keys.with_ids(add_features(step.rows), maps).select(*FACT_COLUMNS)
    signed = add_features(silver.changed(store, version, step)).select(*GOLD_COLUMNS)
    done = at_once({"facts": lambda: store.write(facts, "facts"),
                    "gold": lambda: gold.add_batch(store, version, checkpointed(signed))})
    return store.publish({**step.folders, **key_folders, **done["gold"], "facts": [*version.of("facts"), done["facts"]]}, batch)


# what Gold reads of a row
GOLD_COLUMNS = ["order_year", "order_month", "order_month_name", "market", "order_region", "order_country", "product_card_id",
                "product_name", "category_name", "department_name", "customer_id", "customer_segment", "shipping_mode",
                "delivery_status", "order_id", "order_item_id", "sales", "order_profit_per_order", "profit_margin_pct",
                "discount_pct", "order_item_quantity", "is_late", "delivery_delay_days", "days_for_shipping_real",
                "days_for_shipment_scheduled", "_sign"]


def facts(store: VersionedTables, version: Version | None = None) -> DataFrame:
    """The fact table of a version: facts of the first rows, between the bounds."""
    version = version or store.current()
    return store.read("facts", version).filter(silver.bounds_of(store, version).inside(F.col("sales")))


def run_daily(spark: SparkSession, landing_dir: str, root: str, **reader) -> Version:
    """Take new landing files to Bronze and through every layer, each micro-batch as one version."""
    store = VersionedTables(spark, f"{root.rstrip('/')}/layers")
    bronze_dir = f"{root.rstrip('/')}/bronze"

    def land(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, bronze_dir)
        run_batch(store, spark.read.parquet(f"{bronze_dir}/_batch={batch_id}"), batch_id)

    run_landing(spark, landing_dir, f"{root.rstrip('/')}/_checkpoint", land, **reader)
    return store.current()
