"""Tables stored by a join key, so that joins and sums on it read them without a shuffle."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.versions import VersionedTable


@dataclass(frozen=True)
class BucketedTable:
    """Rows by ``key`` in ``buckets`` buckets, and apart from them the rows of heavy keys.

    A bucket is read by one task, so a key that holds a large part of the table would make
    one task do that part of the work. Keys with more than half a bucket's fair share of the rows,
    ``2 * buckets`` of them at most, and rows without a key are stored without buckets, where
    Spark may split them as it likes. Both parts belong to one version
    (:class:`~tidemart.sources.versions.VersionedTable`).
    """

    spark: SparkSession
    path: str
    key: str
    buckets: int

    @property
    def _table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.path)

    def replace(self, df: DataFrame, unique: bool = False) -> str:
        """Store the rows as the new version. They are read several times: pass a stored table.
        With ``unique`` keys none can be heavy."""
        counts = df.groupBy(self.key).agg(F.count("*").alias("_rows"))
        total = df.count()
        heavy = counts.where(
            "false" if unique else f"{self.key} IS NOT NULL AND _rows * {2 * self.buckets}L > {total}L"
        )
        # At most 2 * buckets rows, by the condition.
        heavy = F.broadcast(heavy.select(F.col(self.key).alias("_heavy")))
        same = df[self.key] == F.col("_heavy")
        even = df.where(f"{self.key} IS NOT NULL").join(heavy, same, "left_anti")
        rest = df.join(heavy, same, "left_semi").unionByName(df.where(f"{self.key} IS NULL"))

        def write(folder: str) -> None:
            name = f"buckets_{uuid.uuid4().hex}"
            (
                even.repartition(self.buckets, self.key)
                .write.format("parquet")
                .bucketBy(self.buckets, self.key)
                .sortBy(self.key)
                .option("path", f"{folder}/even")
                .saveAsTable(name)
            )
            self._forget(name)
            rest.write.parquet(f"{folder}/heavy")

        return self._table.replace(write=write)

    def _forget(self, name: str) -> None:
        """Files stay: the table is an external one."""
        self.spark.sql(f"DROP TABLE {name}")

    def even(self, schema: str) -> DataFrame:
        """The rows of all other keys. Sums by the key and joins with a table of as many buckets
        need no shuffle."""
        name = f"buckets_{uuid.uuid4().hex}"
        place = f"{self._table.current()}/even".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({self.key})"
            f" SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        try:
            return self.spark.table(name)
        finally:
            self._forget(name)

    def heavy(self, schema: str) -> DataFrame:
        """The rows of heavy keys and of none."""
        return self.spark.read.schema(schema).parquet(f"{self._table.current()}/heavy")

    def read(self, schema: str) -> DataFrame:
        return self.even(schema).unionByName(self.heavy(schema))
