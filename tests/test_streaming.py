"""Only new landing files are ingested; re-runs are idempotent."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.session import checkpointed
from tidemark.sources import csv_source
from tidemark.sources.csv_source import dense_scan_numbers, numbered_so, read_raw_csv, write_raw_csv
from tidemark.streaming import incremental_bronze as stream
from tidemark.streaming.incremental_bronze import run_incremental_bronze


def _arrive(df, staging, landing, name):
    """Stage a CSV outside the landing folder, then drop it in (as a file arrives)."""
    write_raw_csv(df.coalesce(1), staging)  # one part file holds all rows
    os.makedirs(landing, exist_ok=True)
    for p in glob.glob(staging + "/*.csv"):
        shutil.copy(p, f"{landing}/{name}")


def test_incremental_bronze_picks_only_new_files(spark, make_raw, raw_rows, tmp_dir):
    landing, bronze, ckpt = tmp_dir + "/landing", tmp_dir + "/bronze", tmp_dir + "/ckpt"
    _arrive(make_raw(raw_rows[:1]), tmp_dir + "/stage1", landing, "a.csv")
    run_incremental_bronze(spark, landing, bronze, ckpt)
    assert spark.read.parquet(bronze).count() == 1

    _arrive(make_raw(raw_rows[1:]), tmp_dir + "/stage2", landing, "b.csv")
    run_incremental_bronze(spark, landing, bronze, ckpt)
    b = spark.read.parquet(bronze)
    assert b.count() == 2
    assert {r["_source_file"].split("/")[-1] for r in b.collect()} == {"a.csv", "b.csv"}

    run_incremental_bronze(spark, landing, bronze, ckpt)  # nothing new
    assert spark.read.parquet(bronze).count() == 2


@pytest.mark.parametrize("moved", ["", "lost", "shifted"])
def test_files_are_numbered_without_a_copy_of_their_rows(spark, make_raw, raw_rows, tmp_dir, monkeypatch, moved):
    """Two scans give 1..n in the order of files; where the second one finds rows in other tasks, a written copy is numbered."""
    want = []
    for name, n in (("a", 3), ("b", 40), ("c", 1), ("d", 7)):
        rows = [raw_rows[1] | {"Order Item Id": f"{name}{i}"} for i in range(n)]
        want += [r["Order Item Id"] for r in rows]
        _arrive(make_raw(rows), f"{tmp_dir}/stage-{name}", tmp_dir + "/landing", name + ".csv")
    copies, real_copy, real_scan = [], stream.checkpointed, stream.dense_scan_numbers
    monkeypatch.setattr(stream, "checkpointed", lambda df: (copies.append(df), real_copy(df))[1])
    change = {"": lambda df: df, "lost": lambda df: df.filter("_row_number <> 5"),
              "shifted": lambda df: df.withColumn("_row_number", F.expr("_row_number + if(_source_file like '%c.csv', 1, 0)"))}[moved]
    monkeypatch.setattr(stream, "dense_scan_numbers", lambda scan: (lambda found: (change(found[0]), found[1]))(real_scan(scan)))
    assert stream.run_incremental_bronze(spark, tmp_dir + "/landing", tmp_dir + "/bronze", tmp_dir + "/ckpt") == 1
    found = sorted((r["_row_number"], r["Order Item Id"]) for r in spark.read.parquet(tmp_dir + "/bronze").collect())
    assert found == list(enumerate(want, start=1))
    assert len(copies) == (1 if moved else 0)


def test_scan_numbers_go_by_file_and_split(spark, make_raw, raw_rows, tmp_dir, monkeypatch):
    """Splits of a few rows, some tasks with several; other splits in the second scan are noticed."""
    want = []
    for name, n in (("a", 70), ("b", 5), ("c", 0), ("d", 2)):
        rows = [raw_rows[1] | {"Order Item Id": f"{name}{i}"} for i in range(n)]
        want += [r["Order Item Id"] for r in rows]
        _arrive(make_raw(rows), f"{tmp_dir}/stage-{name}", tmp_dir + "/landing", name + ".csv")
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = read_raw_csv(spark, tmp_dir + "/landing")
        numbered, starts = dense_scan_numbers(scan)
        assert numbered.columns == scan.columns
        rows = checkpointed(numbered)
        assert sorted((r["_row_number"], r["Order Item Id"]) for r in rows.collect()) == list(enumerate(want, start=1))
        assert starts.count() > 3 and numbered_so(rows, starts)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")     # the second scan deals other splits
        assert not numbered_so(numbered, starts)
        monkeypatch.setattr(csv_source, "SPLITS_BROADCAST", 0)
        assert dense_scan_numbers(scan) is None
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
