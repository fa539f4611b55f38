"""Layer tables: versioned Parquet directories under a warehouse root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.sources.schemas import LAYERS, columns_of
from tidemart.sources.versions import VersionedTable


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_table(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """Scan a table as it is now, with its declared types; files of another shape fail the
    read. The scan keeps to this version, also if the table is replaced meanwhile."""
    return VersionedTable(spark, table_path(root, layer, table)).read(LAYERS[layer][table])


def write_table(df: DataFrame, root: str, layer: str, table: str) -> None:
    """Replace a table whole or not at all, so that running a job again leaves the same content
    and a job that is killed leaves the content of before."""
    ordered = df.select(*columns_of(layer, table))
    VersionedTable(df.sparkSession, table_path(root, layer, table)).replace(ordered)


def preview(df: DataFrame, rows: int, *order: str) -> DataFrame:
    """The first rows, in the given order if any."""
    return (df.orderBy(*order) if order else df).limit(rows)
