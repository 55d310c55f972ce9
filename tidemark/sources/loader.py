"""Star load with the DDL's types, dimensions before the fact, visible as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import round2
from tidemark.incremental.tables import Version, VersionedTables
from tidemark.schemas import LOAD_ORDER, STAR_DDL


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the DDL's columns in DDL order, cast to the DDL's types (the reference's
    loader lost types and keys by letting the writer guess them); fractions go to 2 dp half
    away from zero, as in every report."""
    kinds = dict(df.dtypes)

    def to(c, t):
        return (round2(F.col(c)) if kinds[c] == "double" and t.endswith(",2)") else F.col(c)).cast(t).alias(c)

    return df.select(*[to(c, t) for c, t in STAR_DDL[table]])


def load_star(spark: SparkSession, tables: dict[str, DataFrame], target_root: str,
              jdbc_url: str | None = None, jdbc_props: dict | None = None, connections: int = 8) -> DataFrame:
    """Write the six tables in LOAD_ORDER to new Parquet folders under ``target_root`` and then publish them as one
    version; returns what was loaded, read back: see ``load_report``.

    A reader (``loaded``) sees all six tables of one run: a load that fails after any table leaves the version
    before. The version before stays on disk for readers that have begun; older ones are removed.

    With ``jdbc_url`` the loaded tables go on to a database, from the written Parquet, by at
    most ``connections`` connections; existing tables are emptied, not dropped, so that the
    DDL's types and keys stay (``truncate``).
    """
    store = VersionedTables(spark, target_root)
    folders = {name: [store.write(conform(tables[name], name), name)] for name in LOAD_ORDER}
    store.publish(folders)
    store.remove_unused(keep=2)
    if jdbc_url:
        for name, df in loaded(spark, target_root).items():
            (df.write.option("truncate", "true").option("numPartitions", connections)
             .jdbc(jdbc_url, name, mode="overwrite", properties=jdbc_props or {}))
    return load_report(spark, target_root)


def loaded(spark: SparkSession, target_root: str, version: Version | None = None) -> dict[str, DataFrame]:
    """The six tables of the latest load (or of a given version), in LOAD_ORDER."""
    store = VersionedTables(spark, target_root)
    version = version or store.current()
    return {name: store.read(name, version) for name in LOAD_ORDER}


def load_report(spark: SparkSession, target_root: str) -> DataFrame:
    """One row per loaded column: table, load position, column, type, rows, non-NULL values and a
    sum over the values (numbers: their sum; text: its length; dates: days; flags: the true ones)."""
    out = None
    for pos, (name, df) in enumerate(loaded(spark, target_root).items(), start=1):

        def total(column, kind):
            c = F.col(column)
            if kind == "string":
                c = F.char_length(c)
            elif kind == "date":
                c = F.datediff(c, F.lit("1970-01-01").cast("date"))
            elif kind == "boolean":
                c = c.cast("int")
            return F.coalesce(F.sum(c.cast("decimal(28,6)")), F.lit(0)).cast("decimal(38,6)")

        kinds = dict(df.dtypes)
        one = df.agg(F.count(F.lit(1)).alias("n"), *[
            F.struct(F.count(c).alias("non_null"), total(c, kinds[c]).cast("double").alias("value_sum")).alias(f"c{i}")
            for i, c in enumerate(df.columns)])
        part = one.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(pos).alias("load_position"), F.lit(c).alias("column_name"),
                     F.lit(kinds[c]).alias("data_type"), F.col("n").alias("row_count"),
                     F.col(f"c{i}.non_null").alias("non_null"), F.col(f"c{i}.value_sum").alias("value_sum"))
            for i, c in enumerate(df.columns)])))
        out = part if out is None else out.unionByName(part)
    return out
