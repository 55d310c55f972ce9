"""Shared helpers: scratch tables in the cluster's shared folder, words, streaming over sorted rows."""

from __future__ import annotations

import ctypes
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

#: A word is a run of letters and digits; the Java pattern splits on everything else.
WORD = re.compile(r"[^\W_]+")
WORD_SPLIT = r"[^\p{L}\p{N}]+"
SALTS = 4096    # parts that the rows of one key are dealt to


def workers_find_package(spark: SparkSession) -> None:
    """Python workers that this session starts import the package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder; every call gets its own."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back with the same schema."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_array(text: Column) -> Column:
    """Lower-case words of a text as an array, built-in functions only."""
    return F.filter(F.split(F.lower(text), WORD_SPLIT), lambda w: w != F.lit(""))


def attached(rows: DataFrame, table: DataFrame, key: str, by: Column, how: str = "inner") -> DataFrame:
    """rows joined with table (one row a key), where a key may hold any share of the rows.

    A key's rows are dealt to SALTS parts by `by`, a hash that tells them apart; one narrow row of each part meets the
    table and takes its columns back to the part. how: inner or left.
    """
    dealt = rows.withColumn("salt", F.pmod(by, F.lit(SALTS)).cast("int"))
    return dealt.join(dealt.select(key, "salt").distinct().join(table, key, how), [key, "salt"]).drop("salt")


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of equal keys, in order, from batches whose rows are sorted by these keys.

    Holds one group at a time: use it only where the group size is bounded by construction.
    """
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if rows and key != now:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows


def emit(rows: Iterable[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


class Memo(dict):
    """Values of compute(key), kept in two generations of at most `size` keys: frequent keys stay, memory is bounded."""

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def ranges(sizes: list[int], most: int, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `rows` rows and `most` in all, one row at least: bounds memory in a task."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (total + n > most or i - start >= rows):
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def slices(texts: list, chars: int, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `rows` rows and `chars` code points, one row at least."""
    return ranges([len(t or "") for t in texts], chars, rows)


def text_slices(column: pa.Array, chars: int) -> Iterator[tuple[int, int, list[str | None]]]:
    """Row ranges of at most `chars` code points, one row at least, with their texts: only these are Python objects."""
    for lo, hi in ranges([n or 0 for n in pc.utf8_length(column).to_pylist()], chars):
        yield lo, hi, column.slice(lo, hi - lo).to_pylist()


def give_back() -> None:
    """Memory that this process has freed goes back to the machine: Arrow's pool and, where the C library can, malloc's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """mapInArrow function that gives its freed memory back when a task ends.

    Spark hands tasks round all idle workers, of which two chained functions leave twice as many as there are cores; each
    would keep what its largest task took.
    """
    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return lean_run


def batchwise(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """mapInArrow function from a function on one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out
    return run
