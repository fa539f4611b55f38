"""Bronze sources: delimited exports read as whole lines with lineage columns."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.sources.schemas import RAW_SOURCES

#: Up to so many files each split is read by a task of its own, and up to so many files' header
#: rows are broadcast (8 bytes each).
LONE_SPLIT_FILES = 1_000
BROADCAST_FILES = 200_000

# Layout of monotonically_increasing_id: the row number within a partition is in the low bits.
_FIRST_ROW = f"id & {(1 << 33) - 1}L = 0"


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one export below its header, as ``rawdata``: every character of every line,
    blank ones too.

    The first line of each file is dropped by position; later lines that happen to equal it
    stay, and large files are split. No line is shuffled:

    * Of few files, no two splits are packed into one task, so a header is the first row of a
      task that begins at the start of a file, and one pass sees it.
    * Of more files, a first pass finds each file's header, the row with the lowest id among
      those that begin in its first block. Both passes read the same splits, so ids agree.
      One id a file is broadcast, up to ``BROADCAST_FILES``; beyond that Spark chooses the join.
    """
    files = len(spark.read.text(path).inputFiles())
    lone = _lone_splits(spark, path) if files <= LONE_SPLIT_FILES else None
    if lone is not None:
        return _placed(lone).where(f"NOT (block = 0 AND {_FIRST_ROW})").select("rawdata")
    lines = _placed(spark.read.text(path))
    headers = lines.where("block = 0").groupBy("file").agg(F.min("id").alias("id")).select("id")
    if files <= BROADCAST_FILES:
        headers = F.broadcast(headers)
    return lines.join(headers, "id", "left_anti").select("rawdata")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``rawdata`` of all lines with ``file``, ``block`` (the byte at which the split begins) and
    ``id``, whose low 33 bits number the rows of a task: of a split, where files are few."""
    files = len(spark.read.text(path).inputFiles())
    lone = _lone_splits(spark, path) if files <= LONE_SPLIT_FILES else None
    return _placed(spark.read.text(path) if lone is None else lone)


def _placed(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("value").alias("rawdata"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )


def _lone_splits(spark: SparkSession, path: str) -> DataFrame | None:
    """The same scan with one split to a task; None where the settings for it do not hold.

    A file that seems as costly to open as a whole partition is never packed with another.
    Settings belong to the session that a scan was made in, so it is made in a session of its
    own, and read from the caller's by way of a view that exists no longer than that.
    """
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    own, view = spark.newSession(), f"lines_{uuid.uuid4().hex}"
    wanted = {"spark.sql.files.maxPartitionBytes": most, "spark.sql.files.openCostInBytes": str(1 << 50)}
    for name, value in wanted.items():
        own.conf.set(name, value)
    packed = own.conf.get("spark.sql.files.maxPartitionNum", None) is not None
    if packed or any(own.conf.get(name) != value for name, value in wanted.items()):
        return None
    own.read.text(path).selectExpr("*", "_metadata").createGlobalTempView(view)
    try:
        return spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def with_lineage(lines: DataFrame, source: str, load_date: dt.date | None = None) -> DataFrame:
    """Add the source name and the load date (today by default) to raw lines."""
    stamp = F.current_date() if load_date is None else F.lit(load_date)
    return lines.select("rawdata", F.lit(source).alias("path_name"), stamp.alias("load_date"))


def read_source(
    spark: SparkSession, source: str, path: str, load_date: dt.date | None = None
) -> DataFrame:
    return with_lineage(raw_lines(spark, path), source, load_date)


def read_manifest(
    spark: SparkSession, manifest: Mapping[str, str], load_date: dt.date | None = None
) -> dict[str, DataFrame]:
    """One bronze DataFrame per entry of ``{source name: path}``."""
    unknown = set(manifest) - set(RAW_SOURCES)
    if unknown:
        raise ValueError(f"unknown sources in manifest: {sorted(unknown)}")
    return {name: read_source(spark, name, path, load_date) for name, path in manifest.items()}


def source_summary(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and one sample line per source. The sample is the smallest line, so that it
    does not depend on how files were split.

    Each source is aggregated on its own: grouped by source name, the smallest text would
    need every line sorted, since texts cannot be updated in a hash aggregation.
    """
    counts = [
        df.selectExpr(
            f"'{source}' AS path_name", "count(*) AS rows", "min(rawdata) AS sample_line"
        )
        for source, df in bronze.items()
    ]
    return reduce(DataFrame.unionByName, counts)
