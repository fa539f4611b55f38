"""Tables that are replaced whole or not at all: a folder per version, and a mark written last."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class VersionedTable:
    """Versions of the table at ``path``.

    A version is a folder of its own under ``<path>/../_versions/<table>``. It counts from the
    moment an empty file that is named after it stands in the log beside it; stores create
    such a file at once or not at all. A write that is killed before leaves a folder that nothing
    names, and the table as it was. Readers hold on to the version that was the last when they
    were made. One job at a time writes to a table.

    Only names are listed and one empty file is made, through the file system that Spark itself
    uses for the path, so any store that Spark can write will do. A folder without a
    log is a table of one version: its files.
    """

    spark: SparkSession
    path: str

    @property
    def _base(self) -> str:
        root, _, name = self.path.rstrip("/").rpartition("/")
        return f"{root}/_versions/{name}"

    def _store(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._base)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self._base, *names]))

    def _names(self, *folder: str) -> list[str]:
        store, path = self._store(), self._at(*folder)
        if not store.exists(path):
            return []
        return sorted(status.getPath().getName() for status in store.listStatus(path))

    def versions(self) -> list[str]:
        """Names of the committed versions, oldest first."""
        return self._names("log")

    def current(self) -> str:
        """The folder that the last committed version lies in."""
        return self.folder(known[-1]) if (known := self.versions()) else self.path

    def folder(self, version: str) -> str:
        return f"{self._base}/data/{version}"

    def replace(
        self,
        df: DataFrame | None = None,
        *partition_by: str,
        keep: int = 2,
        write: Callable[[str], None] | None = None,
    ) -> str:
        """Write the rows as a new version and make it the current one; returns its name. The
        last ``keep`` versions stay for readers that hold on to them. ``write`` is for tables
        that need more than one write: it is given the folder."""
        known = self.versions()
        number = int(known[-1].partition("-")[0]) + 1 if known else 1
        version = f"{number:012d}-{uuid.uuid4().hex}"
        if write is None:
            df.write.partitionBy(*partition_by).parquet(self.folder(version))
        else:
            write(self.folder(version))
        if not self._store().createNewFile(self._at("log", version)):
            raise RuntimeError(f"version {version} of {self.path} is there already")
        self.vacuum(keep)
        return version

    def read(self, schema, version: str | None = None) -> DataFrame:
        """The rows of a version, the current one by default, with declared types."""
        folder = self.folder(version) if version else self.current()
        return self.spark.read.schema(schema).parquet(folder)

    def vacuum(self, keep: int = 2) -> None:
        """Drop all but the last ``keep`` versions, and what killed writes have left. Marks go
        first, so that no mark ever names a version in part."""
        known, store = self.versions(), self._store()
        for version in known[:-keep]:
            store.delete(self._at("log", version), False)
        for folder in self._names("data"):
            if folder not in known[-keep:]:
                store.delete(self._at("data", folder), True)
