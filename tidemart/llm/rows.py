"""Shared steps of the operators: row locators, staged tables and Arrow slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.sources.staging import Staging

#: Where a row is stored: a hash of its file's name, and its number in that file.
LOCATOR = ["loc_file", "loc_row"]


def _metadata(docs: DataFrame) -> Column:
    """Where rows of files lie, also if they have a column of that name."""
    return docs.metadataColumn("_metadata")


def stored(docs: DataFrame, staging: Staging) -> DataFrame:
    """The same rows as a scan of Parquet files; what is none yet is written once."""
    try:
        docs.select(_metadata(docs)["row_index"])
        return docs
    except AnalysisException:
        return staging.settle(docs, "stored")


def located(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns`` of stored rows with their locator, whatever else the rows hold."""
    at = _metadata(docs)
    return docs.select(
        *columns,
        F.xxhash64(at["file_path"]).alias("loc_file"),
        at["row_index"].alias("loc_row"),
    )


def only(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """Stored rows whose locator is among ``keepers``, with the columns they had."""
    names = docs.columns
    packed = located(docs, F.struct(*[docs[f"`{name}`"] for name in names]).alias("row"))
    kept = packed.join(keepers.select(*LOCATOR), LOCATOR, "left_semi")
    return kept.select(*[F.col(f"row.`{name}`").alias(name) for name in names])


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``text``, ``label`` and ``at`` of the documents that have the first ``sample`` labels 0
    or 1, by a hash of the doc_id (``at``). So many labels can be broadcast, and no text is
    shuffled to be chosen."""
    known = labels.where("label IN (0, 1)").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label")
    )
    known = known.withColumn("at", F.xxhash64("doc_id")).orderBy("at", "label").limit(sample)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.join(F.broadcast(known), "doc_id").select("text", "label", "at")


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice have about ``size`` bytes; a longer text
    stands alone. Empty batches are left out."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and where each begins; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every word ``[^\\x20\\x09-\\x0D]+``; ``gaps`` marks the
    bytes between other kinds of words."""
    ink = ~gaps[data]
    if not ink.any():
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    after = np.zeros(len(data), bool)
    after[1:] = ink[:-1]
    after[offsets[:-1][offsets[:-1] < len(data)]] = False
    before = np.zeros(len(data), bool)
    before[:-1] = ink[1:]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    before[last] = False
    begins = np.flatnonzero(ink & ~after)
    ends = np.flatnonzero(ink & ~before) + 1
    return begins, ends, np.searchsorted(offsets, begins, side="right") - 1
