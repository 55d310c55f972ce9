"""Keep-first across batches (P8), bounds across batches (P11), and Silver as what lies between them.

State, as tables of ``VersionedTables``:

* ``rows``    the first row of each order item, typed and cleaned, not trimmed; one folder for each batch. Values far from
              the median lie in files of their own (``_edge``), so that bounds that move read few rows.
* ``seen``    the keys met so far, by hash partition. A batch is anti-joined with the partitions that its own keys fall
              into and adds a folder to each of these; a partition of many folders is rewritten as one.
* ``counts``  how often each value of Sales occurs among the first rows; folders of batches add up.
* ``bounds``  one row: the percentile bounds, found by rank search on ``counts``.

A batch reads its own wide rows, the keys and the counts. Old wide rows are read only where the bounds moved past them.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.quantiles import quantiles_of_counts, value_counts
from tidemark.incremental.tables import Version, VersionedTables
from tidemark.operators.silver import (BRONZE_ONLY, drop_bad_dates, drop_columns, fill_nulls, first_rows, normalise_strings,
                                       pick_rows, q, rename_to_snake, typed)
from tidemark.schemas import SALES_TRIM_BAND, SILVER_DROP
from tidemark.session import checkpointed

KEY = "Order Item Id"
KEY_PARTS = 64        # hash partitions of the keys; for 10^12 keys take some thousands
MERGE_AFTER = 8       # folders of a table or partition that are read together at most
CORE = (0.05, 0.95)   # values between these quantiles of the first batch are not at the edge
CENT = Decimal("0.01")
BOUNDS = "lo double, hi double, core_lo double, core_hi double"


@dataclass(frozen=True)
class Bounds:
    """Sales bounds (inclusive) and the quantiles that tell edge rows; None where no value has been seen."""

    lo: float | None = None
    hi: float | None = None
    core_lo: float | None = None
    core_hi: float | None = None

    def cents(self) -> tuple[Decimal, Decimal]:
        """The bounds as the least and greatest amounts in cents whose doubles lie between them: these reach the scan."""
        lo, hi = (Decimal(x).quantize(CENT, ROUND_HALF_EVEN) for x in (self.lo, self.hi))
        return lo if float(lo) >= self.lo else lo + CENT, hi if float(hi) <= self.hi else hi - CENT

    def inside(self, sales: Column) -> Column:
        if self.lo is None:
            return F.lit(False)
        lo, hi = self.cents()
        return (sales >= F.lit(lo)) & (sales <= F.lit(hi))

    def edge(self, sales: Column) -> Column:
        if self.core_lo is None:
            return F.lit(True)
        x = sales.cast("double")
        return ~F.coalesce((x >= self.core_lo) & (x <= self.core_hi), F.lit(False))


@dataclass(frozen=True)
class Step:
    """What a batch did to Silver, before it is published."""

    rows: DataFrame                 # the batch's first rows, as written
    bounds: Bounds
    before: Bounds
    folders: dict[str, dict[int, list[str]] | list[str]]


def key_part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def new_keys(store: VersionedTables, version: Version, first: DataFrame, parts: int) -> DataFrame:
    """The rows of ``first`` (one for each key of the batch) whose keys no earlier batch had, with their partition."""
    own = first.withColumn("_part", key_part(q(KEY), parts))
    touched = [r[0] for r in own.select("_part").distinct().collect()]          # `parts` numbers at most
    seen = store.read("seen", version, "key bigint", touched)
    if seen is None:
        return own
    seen = seen.withColumn("_seen_part", key_part(F.col("key"), parts))
    return own.join(seen, q(KEY).eqNullSafe(F.col("key")) & (F.col("_part") == F.col("_seen_part")), "left_anti")


def add_keys(store: VersionedTables, version: Version, new: DataFrame, parts: int) -> dict[int, list[str]]:
    """Folders of every partition of the keys after the batch; partitions without new keys stay as they are."""
    have = {p: list(f) for p, f in version.folders.get("seen", {}).items()}
    touched = sorted(r[0] for r in new.select("_part").distinct().collect())
    full = [p for p in touched if len(have.get(p, [])) >= MERGE_AFTER]
    keys = new.select(q(KEY).alias("key"), "_part")
    old = store.read("seen", version, "key bigint", full) if full else None
    if old is not None:
        keys = keys.unionByName(old.withColumn("_part", key_part(F.col("key"), parts)))
    folder = store.write(keys.repartition("_part"), "seen", "_part")
    for p in touched:
        have[p] = [*([] if p in full else have.get(p, [])), f"{folder}/_part={p}"]
    return have


def merged(store: VersionedTables, folders: list[str], table: str, schema: str, fold) -> list[str]:
    """The folders, or one with their fold where they have become many."""
    if len(folders) <= MERGE_AFTER:
        return folders
    return [store.write(fold(store.read_folders(folders, schema)), table)]


def add_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("v").agg(F.sum("c").alias("c"))


def add_batch(store: VersionedTables, version: Version, bronze: DataFrame, band=SALES_TRIM_BAND, parts: int = KEY_PARTS) -> Step:
    """Write what a batch of Bronze adds to Silver. Batches come in the order of their ingest, so a key that has been
    seen stays with its earlier row."""
    batch = drop_columns(bronze, SILVER_DROP + BRONZE_ONLY)
    new = checkpointed(new_keys(store, version, first_rows(drop_bad_dates(typed(batch)), KEY, "Sales"), parts))
    seen = add_keys(store, version, new, parts)

    sales = store.write(value_counts(new, q("Sales")), "counts")
    counts = merged(store, [*version.of("counts"), sales], "counts", "v double, c bigint", add_counts)
    found = checkpointed(add_counts(store.read_folders(counts, "v double, c bigint")))
    before = bounds_of(store, version)
    if before.core_lo is None:
        lo, hi, *core = quantiles_of_counts(found, [*band, *CORE])
    else:
        (lo, hi), core = quantiles_of_counts(found, list(band)), (before.core_lo, before.core_hi)
    bounds = Bounds(lo, hi, *core)
    kept = store.write(store.spark.createDataFrame([(lo, hi, *core)], BOUNDS).coalesce(1), "bounds")

    clean = normalise_strings(fill_nulls(typed(pick_rows(batch, new))))
    clean = rename_to_snake(clean.drop("_row_uid").withColumn("_silver_processed", F.lit(True)))
    folder = store.write(clean.withColumn("_edge", bounds.edge(F.col("sales"))), "rows", "_edge")
    return Step(store.spark.read.schema(_row_schema(clean)).parquet(store.path(folder)).drop("_edge"), bounds, before,
                {"rows": [*version.of("rows"), folder], "seen": seen, "counts": counts, "bounds": [kept]})


def _row_schema(clean: DataFrame):
    return clean.withColumn("_edge", F.lit(True)).schema


def bounds_of(store: VersionedTables, version: Version) -> Bounds:
    kept = store.read("bounds", version, BOUNDS)
    return Bounds(*kept.first()) if kept is not None else Bounds()


def stored_rows(store: VersionedTables, version: Version, schema) -> DataFrame | None:
    """All first rows of this version with ``_edge``, from the folders of the batches."""
    out = None
    for folder in version.of("rows"):       # each folder has partitions of its own
        df = store.spark.read.schema(schema).parquet(store.path(folder))
        out = df if out is None else out.unionByName(df)
    return out


def silver(store: VersionedTables, version: Version | None = None) -> DataFrame:
    """Silver of a version: the first rows between its bounds. The bounds are literals that reach the scan."""
    version = version or store.current()
    first = version.of("rows")[0]
    rows = stored_rows(store, version, store.spark.read.parquet(store.path(first)).schema)
    return rows.filter(bounds_of(store, version).inside(F.col("sales"))).drop("_edge")


def changed(store: VersionedTables, version: Version, step: Step) -> DataFrame:
    """Rows that enter Silver with this batch (``_sign`` 1) or leave it (-1): the batch's own between the new bounds, and old
    rows that the bounds moved past. Bounds that move at the edge read edge files only."""
    sales = F.col("sales")
    out = step.rows.filter(step.bounds.inside(sales)).withColumn("_sign", F.lit(1))
    old = stored_rows(store, version, _row_schema(step.rows))
    was, now = step.before, step.bounds
    if old is None or was == now or now.lo is None:
        return out
    if was.lo is None:
        moved = now.inside(sales)
        old = old.filter(moved)
    else:
        (a, b), (c, d) = was.cents(), now.cents()
        spans = [(min(x, y), max(x, y)) for x, y in ((a, c), (b, d)) if x != y]
        if not spans:
            return out
        moved = F.lit(False)
        for x, y in spans:
            moved = moved | ((sales >= F.lit(x)) & (sales <= F.lit(y)))
        old = old.filter(moved)
        if all(float(y) < was.core_lo or float(x) > was.core_hi for x, y in spans):
            old = old.filter(F.col("_edge"))
        old = old.filter(was.inside(sales) != now.inside(sales))
    return out.unionByName(old.drop("_edge").withColumn("_sign", F.when(now.inside(sales), 1).otherwise(-1)))

