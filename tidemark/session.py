"""Spark session set-up and the shared folder for written layer tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (dates are formatted and parsed as
# text), AQE for runtime coalescing / skew splitting / broadcast conversion.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # a sort-merge join whose measured partitions of one side all fit in this becomes a hash join
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    # Whole-stage methods above HotSpot's JIT limit (8000 bytes of bytecode) run
    # interpreted; above it, fall back to per-operator code that does get compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Written tables: half the size of Spark's default codec on raw text and digests.
WRITTEN = {"compression": "zstd"}


def build_session(master: str = "local[*]", app_name: str = "tidemark",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches; on a cluster the submitter's conf wins."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_base_conf(spark)
    return spark


def apply_base_conf(spark: SparkSession) -> None:
    """On a session we did not build, pin only what results depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def compiled_methods(spark: SparkSession):
    """While a wide table is written: no generated method beyond what HotSpot compiles (see BASE_CONF), unless the session
    says otherwise. Results do not depend on it."""
    name = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(name)
    if was != "65535":      # not Spark's default: somebody chose it
        yield
        return
    spark.conf.set(name, BASE_CONF[name])
    try:
        yield
    finally:
        spark.conf.set(name, was)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """While layers are written: the shuffle files of a write or count go when it ends (a setting of Spark 4.1; without it they
    lie on disk until the driver's garbage collection finds them unused). Results do not depend on it."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage-cutting writes.

    Read from ``spark.checkpoint.dir`` (what the cluster names).  Where it is unset, a
    local session gets a folder of its own; on a cluster that is an error, because a
    machine-local folder would hold only part of what the executors write.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR") or "/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:  # already set identically
        pass
    return root.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of df: computed now, once, as a written table in the shared folder (``checkpoint()``
    computes it twice unless it is cached)."""
    path = f"{checkpoint_root(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.options(**WRITTEN).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours on whatever store it lies."""
    where, store = _hadoop_path(spark, path)
    store.delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where, store = _hadoop_path(spark, path)
    return store.exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    where, store = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(where) if s.isDirectory()) if store.exists(where) else []
