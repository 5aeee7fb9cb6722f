"""Tables that are replaced as a whole in one step.

A versioned table is a folder with ``data/<number>-<id>/`` (the Parquet files of one version) and
``log/<number>`` (a small file that names that folder and its schema). New data are written first, then
the log file gets its final name by a rename that never overwrites: from that moment on, and
not before, readers see the new version. A writer that stops anywhere leaves the old version in place; of two
writers that began from the same version one gets ``ConcurrentReplace``. The file system must rename atomically (HDFS,
ABFS and local ones do).

A catalog name can stand for the newest version: a view, moved by one catalog operation after the
commit. If that operation does not take place, the view still shows the version before in full, and
``repair`` (or the next write) moves it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class ConcurrentReplace(RuntimeError):
    """Another writer committed the version that this one was to become."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _files(self):
        return self._at().getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        log = self._at("log")
        if not self._files().exists(log):
            return []
        return sorted(int(s.getPath().getName()) for s in self._files().listStatus(log) if s.getPath().getName().isdigit())

    def entry(self, version: int | None = None) -> tuple[str, StructType]:
        """(folder, schema) of a version, the newest by default."""
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"no version of a table at {self.path}")
        stream = self._files().open(self._at("log", f"{found[-1] if version is None else version:020d}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        row = json.loads(text)
        return f"{self.path}/data/{row['folder']}", StructType.fromJson(row["schema"])

    def read(self, version: int | None = None) -> DataFrame:
        folder, schema = self.entry(version)
        return self.spark.read.schema(schema).parquet(folder)

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Make the rows of ``df``, which may be read from this table, its next version."""
        number = max(self.versions(), default=0) + 1
        folder = f"{number:020d}-{uuid.uuid4().hex}"
        self._write_data(df, folder, partition_by)
        self._commit(number, self._prepare(folder, df.schema))
        return number

    def _write_data(self, df: DataFrame, folder: str, partition_by: list[str] | None) -> None:
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.path}/data/{folder}")

    def _prepare(self, folder: str, schema: StructType):
        """The log file under a name that is no version."""
        waiting = self._at("log", f".{uuid.uuid4().hex}")
        out = self._files().create(waiting, False)
        try:
            out.write(bytearray(json.dumps({"folder": folder, "schema": schema.jsonValue()}).encode()))
        finally:
            out.close()
        return waiting

    def _commit(self, number: int, waiting) -> None:
        """The one step that counts."""
        rename = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(rename, 0)
        final = self._at("log", f"{number:020d}")
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        try:
            context.rename(waiting, final, none)
        except Exception as problem:
            if self._files().exists(final):
                self._files().delete(waiting, False)
                raise ConcurrentReplace(f"version {number} of {self.path} was committed by another writer") from problem
            raise

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions and what no version names; returns the folders deleted.

        Data of a writer at work are not named yet: call this when none is.
        """
        found = self.versions()
        kept = {self.entry(v)[0].rsplit("/", 1)[1] for v in found[-keep:]} if keep else set()
        for v in found[: len(found) - keep]:
            self._files().delete(self._at("log", f"{v:020d}"), False)
        gone = 0
        data = self._at("data")
        for s in self._files().listStatus(data) if self._files().exists(data) else []:
            if s.getPath().getName() not in kept:
                gone += bool(self._files().delete(s.getPath(), True))
        return gone


def default_path(spark: SparkSession, name: str) -> str:
    """Where the versions of a catalog name lie unless a path is given."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions/{name}"


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def repair(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Let the catalog name show the newest version. A plain table of that name gives way once."""
    folder, _ = VersionedTable(spark, path or default_path(spark, name)).entry()
    if spark.catalog.tableExists(name) and not is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")


def replace_table(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> None:
    """Make ``df``, which may be read from ``name`` itself, the contents of catalog name ``name``.

    The rows are committed as a version at ``path`` first. A plain table that is replaced for the first time is dropped
    only after that: from the commit on ``current`` gives the new rows whatever happens to the catalog.
    """
    VersionedTable(spark, path or default_path(spark, name)).write(df)
    repair(spark, name, path)


def current(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """The contents of ``name``: its newest version, or the catalog table if it has none."""
    table = VersionedTable(spark, path or default_path(spark, name))
    return table.read() if table.versions() else spark.read.table(name)
