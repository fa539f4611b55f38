"""Token ids in files of bit planes: fixed-size blocks, one zstandard frame per plane, and an
index of chunks and documents at the end of each file.

    "TMPLANE1" | planes of chunk 0 | planes of chunk 1 | ... | chunk index | document index |
    length of chunk index, length of document index (two 64-bit numbers) | "TMPLANE1"

Both indexes are Arrow streams. A chunk's planes are its ids' bits from the lowest to the
highest that is set in any of them, eight ids to a byte.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm import resident
from tidemart.llm.pieces import PieceIds, joined, literal
from tidemart.llm.rows import slices
from tidemart.sources.staging import Staging, file_system

MAGIC = b"TMPLANE1"
BLOCK = 1 << 16
SLICE_BYTES = 2 << 20


def shuffle_bits(ids: np.ndarray) -> list[bytes]:
    """Bit planes of up to a block of ids."""
    ids = ids.astype("<u4")
    width = int(ids.max()).bit_length() if len(ids) else 0
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return [np.packbits(bits[:, bit], bitorder="little").tobytes() for bit in range(width)]


def unshuffle_bits(planes: list[bytes], count: int) -> np.ndarray:
    bits = np.zeros((count, 32), np.uint8)
    for bit, plane in enumerate(planes):
        bits[:, bit] = np.unpackbits(np.frombuffer(plane, np.uint8), count=count, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file; holds one block of ids and the indexes."""

    def __init__(self, sink: pa.NativeFile, level: int = 3):
        self.sink, self.pack = sink, zstandard.ZstdCompressor(level=level)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0
        self.chunks: list[tuple[int, int, int, list[int]]] = []
        self.docs: list[tuple[list[int | None], list[int]]] = []
        self.at = sink.write(MAGIC)

    def add(self, doc_ids: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Append documents: their ids one after another, and how many each has."""
        self.docs.append((doc_ids, sizes.tolist()))
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // BLOCK * BLOCK
            for start in range(0, whole, BLOCK):
                self._chunk(ids[start : start + BLOCK])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.pack.compress(plane) for plane in shuffle_bits(ids)]
        lengths = [len(plane) for plane in planes]
        self.chunks.append((self.at, self.total, len(ids), lengths))
        self.at += self.sink.write(b"".join(planes))
        self.total += len(ids)

    def close(self) -> None:
        if self.held:
            self._chunk(np.concatenate(self.waiting))
        offsets, firsts, counts, lengths = zip(*self.chunks) if self.chunks else ([], [], [], [])
        chunks = pa.table(
            {
                "offset": pa.array(offsets, pa.int64()),
                "first": pa.array(firsts, pa.int64()),
                "count": pa.array(counts, pa.int64()),
                "lengths": pa.array(lengths, pa.list_(pa.int32())),
            }
        )
        docs = pa.table(
            {
                "doc_id": pa.array([x for ids, _ in self.docs for x in ids], pa.int64()),
                "n_tokens": pa.array([x for _, sizes in self.docs for x in sizes], pa.int64()),
            }
        )
        blobs = [_stream(chunks), _stream(docs)]
        self.sink.write(b"".join(blobs) + struct.pack("<QQ", *map(len, blobs)) + MAGIC)


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class PlaneReader:
    """Reads one file: its documents, and any range of its ids by the chunk index."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        end = source.size()
        source.seek(end - 24)
        tail = source.read(24)
        if tail[16:] != MAGIC:
            raise ValueError("not a file of bit planes")
        chunks, docs = struct.unpack("<QQ", tail[:16])
        source.seek(end - 24 - chunks - docs)
        self.chunks = pa.ipc.open_stream(source.read(chunks)).read_all().to_pylist()
        self.docs = pa.ipc.open_stream(source.read(docs)).read_all()

    def chunk(self, number: int) -> np.ndarray:
        chunk = self.chunks[number]
        self.source.seek(chunk["offset"])
        unpack, planes = zstandard.ZstdDecompressor(), []
        for length in chunk["lengths"]:
            planes.append(unpack.decompress(self.source.read(length)))
        return unshuffle_bits(planes, chunk["count"])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``; reads the chunks that hold them."""
        some = [np.empty(0, np.uint32)]
        for number in range(start // BLOCK, min(len(self.chunks), -(-stop // BLOCK))):
            first = self.chunks[number]["first"]
            some.append(self.chunk(number)[max(0, start - first) : stop - first])
        return np.concatenate(some)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Every document with its ids; one chunk and one document are held at a time."""
        number, rest = 0, np.empty(0, np.uint32)
        for doc_id, size in zip(*(self.docs.column(c).to_pylist() for c in self.docs.column_names)):
            parts = [rest]
            have = len(rest)
            while have < size:
                parts.append(self.chunk(number))
                number, have = number + 1, have + len(parts[-1])
            joined = np.concatenate(parts) if len(parts) > 1 else rest
            yield doc_id, joined[:size]
            rest = joined[size:]


class LibraryPieces:
    """Ids of pieces by the tokenizers library, many pieces in one call."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.width[number] = len(token)  # a character for each byte

    def encode_keys(
        self, keys: list[str], at_once: int = 4000
    ) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Pieces that begin with their only blank or line end are joined and encoded together,
        since no token reaches from one into the next. Others go alone."""
        joinable = [key for key in keys if key[0] != "\r"]
        alone = [key for key in keys if key[0] == "\r"]
        encode = self.tokenizer.encode_batch_fast
        ids, sizes = [], []
        for start in range(0, len(joinable), at_once):
            text = "".join(map(literal, joinable[start : start + at_once]))
            (found,) = encode([text], add_special_tokens=False)
            ids.append(np.array(found.ids, np.int32))
            data = np.frombuffer(text.encode(), np.uint8)
            begins = np.flatnonzero((data == 0x20) | (data == 0x0A))
            stops = np.append(begins[1:], len(data))
            ends = np.cumsum(self.width[ids[-1]])
            last = np.searchsorted(ends, stops)
            if not np.array_equal(ends[last], stops):
                raise ValueError("a token reaches over the end of a piece")
            sizes.append(np.diff(last + 1, prepend=0))
        texts = [literal(key) for key in alone]
        alone_ids, alone_sizes = joined([x.ids for x in encode(texts, add_special_tokens=False)])
        every = np.concatenate([*ids, alone_ids]), np.concatenate([*sizes, alone_sizes])
        return joinable + alone, *every


class LibraryIds:
    """Ids of texts as the library gives them. A text that holds the string of a special token
    goes to it whole, since such strings are found before anything is cut."""

    def __init__(self, path: str, limit: int = 900_000):
        self.library = LibraryPieces(path)
        self.pieces = PieceIds(self.library.encode_keys, limit)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        whole = np.zeros(len(texts), bool)
        for special in self.library.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self.pieces.ids(texts)
        ids, sizes = self.pieces.ids(pc.if_else(pa.array(~whole), texts, ""))
        found = self.library.tokenizer.encode_batch_fast(
            texts.filter(pa.array(whole)).to_pylist(), add_special_tokens=False
        )
        own, lengths = joined([x.ids for x in found])
        ids = np.insert(ids, np.repeat(np.cumsum(sizes)[whole], lengths), own)
        sizes[whole] = lengths
        return ids, sizes


def _pieces(path: str) -> LibraryIds:
    return resident.keep(("planes", path), lambda: LibraryIds(path))


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after every document."""
    return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1


def _write(path: str, folder: str, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, writer = _pieces(path), None
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.planes"
        store, root = file_system(folder)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    sink = store.open_output_stream(f"{root}/{name}")
                    writer = PlaneWriter(sink)
                ids, sizes = with_end(*pieces.ids(part.column("text")), end_id)
                writer.add(part.column("doc_id").to_pylist(), ids, sizes)
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "ids": [writer.total]})

    return run


def _read(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        for batch in batches:
            for shard in batch.to_pylist():
                with store.open_input_file(f"{root}/{shard['file']}") as source:
                    reader, start, rows = PlaneReader(source), shard["before"], []
                    for doc_id, ids in reader.documents():
                        check = zlib.crc32(ids.astype("<u4").tobytes())
                        rows.append((doc_id, start, len(ids), check))
                        start += len(ids)
                columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return run


def write_planes(docs: DataFrame, staging: Staging, path: str, end_id: int = 0) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order to ``<folder>/planes``; returns
    one row per file: ``shard``, ``file``, ``ids`` and ``before`` (the ids of earlier files).

    A null text counts as empty: the end id alone. Null doc_ids come first; rows with the same
    doc_id follow each other by a hash of their texts. Files are named by their attempt, and
    only those of attempts that Spark committed are listed, so that a lost executor leaves at
    most a file that nothing names. No row gives no file.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "shard bigint, file string, ids bigint"
    shards = ordered.mapInArrow(_write(path, f"{staging.path}/planes", end_id), schema)
    shards = staging.settle(shards, "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return shards.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_planes(shards: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document in the files."""
    files = max(1, shards.count())
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return shards.repartitionByRange(files, "shard").mapInArrow(_read(f"{folder}/planes"), schema)


def op9_bitplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's ids lie in the written files, and a checksum of what is read."""
    docs, staging = spark.read.parquet(f"{sf_dir}/documents.parquet"), Staging(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return read_planes(write_planes(docs, staging, path), staging.path)
