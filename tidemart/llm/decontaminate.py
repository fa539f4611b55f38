"""Passages of a benchmark in documents, found by suffix arrays over shards of the documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import resident
from tidemart.llm.rows import slices, text_bytes, words
from tidemart.llm.shingles import Powers, word_hashes
from tidemart.llm.suffixes import SuffixArray
from tidemart.sources.staging import Staging, file_system

SHARD_BYTES = 4 << 20
BLOCK_WORDS = 1 << 18
LOCATIONS = 1 << 20
TESTS = "item_id string, words array<bigint>"
FOUND = (
    "doc_id bigint, n_words bigint, spans array<struct<first: bigint, words: bigint>>,"
    " items array<string>,"
    " longest struct<words: bigint, word_at: bigint, item_id: string, item_at: bigint>"
)

# Words are made of 0-9, A-Z, a-z and everything beyond ASCII.
_GAPS = np.ones(256, bool)
_GAPS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _hashed(column: pa.Array, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, A-Z as a-z, one text after another, and the text of each."""
    data, offsets = text_bytes(column)
    begins, ends, owner = words(data, offsets, _GAPS)
    return word_hashes(data, begins, ends, powers).view(np.int64), owner


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    resident.let_go()
    powers = Powers()
    for batch in batches:
        for part in slices(batch, "text", SHARD_BYTES):
            hashes, owner = _hashed(part.column("text"), powers)
            counts = np.bincount(owner, minlength=part.num_rows)
            offsets = np.zeros(part.num_rows + 1, np.int32)
            np.cumsum(counts, out=offsets[1:])
            columns = [part.column("item_id"), pa.ListArray.from_arrays(offsets, hashes)]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "words"])


class Tests:
    """A block of benchmark items: their words one after another, and for each word its item,
    where that ends, and how many words a window has in it."""

    def __init__(self, items: list[str | None], hashes: np.ndarray, sizes: np.ndarray, window: int):
        self.items, self.hashes = items, hashes
        self.owner = np.repeat(np.arange(len(items)), sizes)
        stops = np.cumsum(sizes)
        self.starts, self.ends = (stops - sizes)[self.owner], stops[self.owner]
        self.least = np.minimum(sizes, window)[self.owner]
        self.place = np.empty(len(items), np.int64)
        self.place[sorted(range(len(items)), key=lambda n: items[n] or "")] = np.arange(len(items))


def _read_blocks(files: list[str], window: int) -> Iterator[Tests]:
    """The staged items, a bounded number of words at a time; a longer item stands alone."""
    for file in files:
        store, path = file_system(file)
        with store.open_input_file(path) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=1000):
                lists = batch.column("words")
                sizes = np.asarray(lists.value_lengths(), np.int64)
                values = np.asarray(lists.flatten())
                stops, start = np.cumsum(sizes), 0
                while start < len(sizes):
                    before = stops[start - 1] if start else 0
                    stop = max(start + 1, int(np.searchsorted(stops, before + BLOCK_WORDS, "right")))
                    items = batch.column("item_id").slice(start, stop - start).to_pylist()
                    yield Tests(items, values[before : stops[stop - 1]], sizes[start:stop], window)
                    start = stop


class Shard:
    """Some documents with their suffix array, and what was found of the benchmark so far."""

    def __init__(self, texts: pa.Array, powers: Powers, depth: int):
        self.hashes, self.owner = _hashed(texts, powers)
        self.docs = len(texts)
        self.counts = np.bincount(self.owner, minlength=self.docs)
        self.stops = np.cumsum(self.counts)
        self.ends = self.stops[self.owner]
        self.suffixes = SuffixArray(self.hashes, self.ends, depth)
        self.edges = np.zeros(len(self.hashes) + 1, np.int64)
        self.items: dict[int, set[str]] = {}
        self.longest: dict[int, tuple] = {}

    def _places(self, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word positions of ranges of slots with the number of their range, many at a time."""
        sizes = high - low
        stops, start = np.cumsum(sizes), 0
        while start < len(sizes):
            before = stops[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(stops, before + LOCATIONS, "right")))
            which = np.repeat(np.arange(start, stop), sizes[start:stop])
            inside = np.arange(len(which)) - (stops - sizes)[which] + before
            yield which, self.suffixes.slots[low[which] + inside]
            start = stop

    def search(self, tests: Tests) -> None:
        """Binary-search every suffix of the tests; note hits, items and longest matches."""
        _, low, high = self.suffixes.search(tests.hashes, tests.ends, tests.least)
        at = np.flatnonzero(high > low)
        if not len(at):
            return
        # Windows of the same words have the same range: they are marked once.
        kinds, first, kind = np.unique(
            np.stack([low[at], high[at], tests.least[at]]), axis=1, return_index=True, return_inverse=True
        )
        least = kinds[2]
        holders = np.unique(np.stack([kind.reshape(-1), tests.owner[at]]), axis=1)
        begins = np.searchsorted(holders[0], np.arange(len(least)))
        held = np.diff(np.append(begins, holders.shape[1]))
        for which, places in self._places(kinds[0], kinds[1]):
            self.edges += np.bincount(places, minlength=len(self.edges))
            self.edges -= np.bincount(places + least[which], minlength=len(self.edges))
            docs, which = np.unique(np.stack([self.owner[places], which]), axis=1)
            for doc, number in zip(docs.tolist(), which.tolist()):
                own = holders[1, begins[number] : begins[number] + held[number]]
                known = self.items.setdefault(doc, set())
                known.update(x for x in (tests.items[n] for n in own.tolist()) if x is not None)
        for which, places in self._places(low[at], high[at]):
            self._extend(tests, at[which], places)

    def _extend(self, tests: Tests, at: np.ndarray, places: np.ndarray) -> None:
        """Keep each document's longest match: of those, the first in it, then the least item."""
        inner = (at > tests.starts[at]) & (places > self.stops[self.owner[places]] - self.counts[self.owner[places]])
        same = np.zeros(len(at), bool)
        same[inner] = tests.hashes[at[inner] - 1] == self.hashes[places[inner] - 1]
        at, places = at[~same], places[~same]  # the others are part of a match that begins earlier
        size = tests.least[at].copy()
        live = np.arange(len(at))
        while len(live):
            a, b = at[live] + size[live], places[live] + size[live]
            on = (a < tests.ends[at[live]]) & (b < self.ends[places[live]])
            live, a, b = live[on], a[on], b[on]
            live = live[tests.hashes[a] == self.hashes[b]]
            size[live] += 1
        docs = self.owner[places]
        order = np.lexsort((tests.place[tests.owner[at]], places, -size, docs))
        lead = order[np.unique(docs[order], return_index=True)[1]]
        for n in lead.tolist():
            doc, item = int(docs[n]), tests.items[tests.owner[at[n]]]
            start = int(self.stops[doc] - self.counts[doc])
            new = (-int(size[n]), int(places[n]) - start, item or "", int(at[n] - tests.starts[at[n]]), item)
            if doc not in self.longest or new[:4] < self.longest[doc][:4]:
                self.longest[doc] = new

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, first word and number of words of every run of hit words."""
        hit = np.cumsum(self.edges[:-1]) > 0
        begin, end = hit.copy(), hit.copy()
        head = np.ones(len(hit), bool)
        head[1:] = self.owner[1:] != self.owner[:-1]
        begin[1:] &= ~hit[:-1] | head[1:]
        end[:-1] &= ~hit[1:] | head[1:]
        first, last = np.flatnonzero(begin), np.flatnonzero(end)
        docs = self.owner[first]
        return docs, first - (self.stops - self.counts)[docs], last - first + 1


def _search(files: list[str], folder: str, window: int, depth: int, held: bool, emit: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, blocks = Powers(), []
        if held:
            blocks = resident.keep(("tests", folder, window), lambda: list(_read_blocks(files, window)))
        else:
            resident.let_go()
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                shard = Shard(part.column("text"), powers, depth)
                for tests in blocks if held else _read_blocks(files, window):
                    shard.search(tests)
                yield emit(part, shard)

    return run


def _report(part: pa.RecordBatch, shard: Shard) -> pa.RecordBatch:
    docs, first, sizes = shard.spans()
    offsets = np.zeros(shard.docs + 1, np.int32)
    np.cumsum(np.bincount(docs, minlength=shard.docs), out=offsets[1:])
    spans = pa.StructArray.from_arrays([pa.array(first), pa.array(sizes)], names=["first", "words"])
    items = [sorted(shard.items.get(n, ())) for n in range(shard.docs)]
    longest = [shard.longest.get(n) for n in range(shard.docs)]
    longest = [x and {"words": -x[0], "word_at": x[1], "item_id": x[4], "item_at": x[3]} for x in longest]
    kind = pa.struct({"words": pa.int64(), "word_at": pa.int64(), "item_id": pa.string(), "item_at": pa.int64()})
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array(shard.counts, pa.int64()),
            pa.ListArray.from_arrays(offsets, spans),
            pa.array(items, pa.list_(pa.string())),
            pa.array(longest, kind),
        ],
        names=["doc_id", "n_words", "spans", "items", "longest"],
    )


def _clean_rows(part: pa.RecordBatch, shard: Shard) -> pa.RecordBatch:
    clean = np.ones(shard.docs, bool)
    clean[shard.spans()[0]] = False
    return part.filter(pa.array(clean))


class Benchmark:
    """Benchmark items (``item_id``, ``text``), ready to be searched for in documents.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z as a-z. A window is
    ``window`` consecutive words of an item; an item with fewer, but not none, is one window.

    Documents are searched where they lie: each task cuts its rows into shards of a few megabytes
    (a longer text stands alone), builds a shard's suffix array, and binary-searches every suffix
    of every item in it. Items are hashed to a table in the checkpoint folder and read from there
    in blocks of a bounded number of words, so neither the driver nor a task holds the benchmark
    whole; one of few words stays in the workers between shards.

    A null text has no words, and null or wordless items have no window. Windows of an item
    without an id hit words but are no item's. Repeated items, repeated rows and ties are counted
    like any other. Further columns of either table are not read.
    """

    def __init__(self, items: DataFrame, staging: Staging, window: int = 10):
        texts = items.select(
            F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
        )
        tests = staging.settle(texts.mapInArrow(_item_words, TESTS).where("size(words) > 0"), "tests")
        size = tests.agg(F.max(F.size("words")), F.sum(F.size("words"))).first()
        depth, total = size[0] or 1, size[1] or 0
        folder = f"{staging.path}/tests"
        self._run = lambda emit: _search(
            sorted(tests.inputFiles()), folder, window, depth, total <= BLOCK_WORDS, emit
        )

    def find(self, docs: DataFrame) -> DataFrame:
        """Of every document: ``doc_id``, ``n_words``, ``spans`` of words inside any occurrence of
        a window, the ``items`` that have one in it, in order, and the ``longest`` verbatim match
        of at least a window: its words, where it begins, and its item's id and word."""
        texts = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
        )
        return texts.mapInArrow(self._run(_report), FOUND)

    def without(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that hold no window, as they were."""
        return docs.mapInArrow(self._run(_clean_rows), docs.schema)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark in each document."""
    benchmark = Benchmark(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Staging(spark))
    found = benchmark.find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = found.withColumn("n_hit", F.expr("aggregate(spans, 0L, (sum, span) -> sum + span.words)"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
