"""Tables made of written folders, with a pointer that is written last.

A writer puts every table into folders of its own and then publishes a *version*: which folders make up which table.
The version is one file of a few rows below ``_versions``; it appears by a rename, so a reader sees the
folders of the latest published version or, if the writer fails at any point before, those of the version before.
Old folders are never changed, so a reader that has begun goes on. There is one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import WRITTEN, delete_folder, folder_names, path_exists

_VERSIONS = "version long, batch long, table string, part int, folders array<string>"
WHOLE = -1      # the part of tables that have no parts

JOBS = 8        # Spark jobs of a batch that run side by side


def at_once(tasks: dict[str, Callable]) -> dict:
    """Results of independent tasks by name; each starts Spark jobs, which share the executors."""
    with ThreadPoolExecutor(JOBS) as pool:
        running = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: task.result() for name, task in running.items()}


@dataclass(frozen=True)
class Version:
    """What one version holds: for each table and part the folders, below the root; the latest batch that is in it."""

    number: int = 0
    batch: int | None = None
    folders: dict[str, dict[int, list[str]]] = field(default_factory=dict)

    def of(self, table: str, parts: list[int] | None = None) -> list[str]:
        found = self.folders.get(table, {})
        return [f for p in sorted(found) if parts is None or p in parts for f in found[p]]

    def names(self) -> set[str]:
        return {f for parts in self.folders.values() for folders in parts.values() for f in folders}


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> Version:
        """The latest version; number 0 where nothing has been published."""
        return self._version(None)

    def version(self, number: int) -> Version:
        return self._version(number)

    def _version(self, number: int | None) -> Version:
        if not path_exists(self.spark, f"{self.root}/_versions"):
            return Version()
        known = self.spark.read.schema(_VERSIONS).parquet(f"{self.root}/_versions")
        if number is None:
            number = known.agg(F.max("version")).first()[0]
        rows = known.filter(F.col("version") == number).collect()      # tables and parts of one version
        if not rows:
            return Version()
        folders: dict[str, dict[int, list[str]]] = {}
        for r in rows:
            folders.setdefault(r["table"], {})[r["part"]] = list(r["folders"])
        return Version(number, max((r["batch"] for r in rows if r["batch"] is not None), default=None), folders)

    def new_folder(self, table: str) -> str:
        """A name, below the root, for a folder that nobody reads before it is published."""
        return f"{table}/{uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def write(self, df: DataFrame, table: str, *partition_by: str) -> str:
        """Write a new folder of a table; not visible before it is published."""
        folder = self.new_folder(table)
        writer = df.write.options(**WRITTEN)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(folder))
        return folder

    def read(self, table: str, version: Version, schema: StructType | str | None = None, parts: list[int] | None = None) -> DataFrame | None:
        """A table of this version (or some parts of it); None where it has no folder."""
        return self.read_folders(version.of(table, parts), schema)

    def read_folders(self, folders: list[str], schema: StructType | str | None = None) -> DataFrame | None:
        if not folders:
            return None
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(*(self.path(f) for f in folders))

    def publish(self, folders: dict[str, dict[int, list[str]] | list[str]], batch: int | None = None) -> Version:
        """Make these folders the next version. The last step of a run: until it ends, readers see the version before."""
        number = self.current().number + 1
        tables = {t: x if isinstance(x, dict) else {WHOLE: x} for t, x in folders.items()}
        rows = [(number, batch, t, part, names) for t, parts in tables.items() for part, names in parts.items()]
        self.spark.createDataFrame(rows, _VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.root}/_versions")
        return Version(number, batch, tables)

    def remove_unused(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the latest ``keep`` versions holds (old ones and those of failed runs); their names."""
        now = self.current()
        used = set().union(*(self.version(n).names() for n in range(max(1, now.number - keep + 1), now.number + 1)))
        roots = {"/".join(f.split("/")[:2]) for f in used}
        gone = []
        for table in folder_names(self.spark, self.root):
            if not table.startswith("_"):
                for name in folder_names(self.spark, f"{self.root}/{table}"):
                    if f"{table}/{name}" not in roots:
                        delete_folder(self.spark, f"{self.root}/{table}/{name}")
                        gone.append(f"{table}/{name}")
        return gone
