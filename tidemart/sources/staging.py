"""Written tables that cut lineage, kept where every executor can read them again."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store that a folder name means, and the folder's path there."""
    scheme, _, path = uri.partition(":")
    if not path or scheme == "file":
        return pyarrow.fs.LocalFileSystem(), re.sub("^/+", "/", path) if path else uri
    return pyarrow.fs.FileSystem.from_uri(uri)


def staging_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, on every master; where none is set, the local
    folder for temporary files."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or tempfile.gettempdir()).rstrip("/")


class Staging:
    """One folder of staged tables, under ``folder`` or the session's checkpoint folder.

    ``drop`` it once nothing reads from them any more; what is left goes when Python ends.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.path = f"{folder or staging_root(spark)}/tidemart-{uuid.uuid4().hex}"
        atexit.register(self._drop_at_exit)

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        """Write the rows and read them back: later passes see exactly these rows, also
        when executors are lost in between."""
        target = f"{self.path}/{name}"
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self) -> None:
        store, path = file_system(self.path)
        if store.get_file_info(path).type != pyarrow.fs.FileType.NotFound:
            store.delete_dir(path)
        atexit.unregister(self._drop_at_exit)

    def _drop_at_exit(self) -> None:
        # A store that only Spark reaches keeps its folder.
        with contextlib.suppress(OSError, ValueError, NotImplementedError):
            self.drop()
