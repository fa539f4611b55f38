"""Groups of spelling variants, by the rotations of words that end in a mark."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import resident
from tidemart.llm.rows import slices
from tidemart.operators.dense_index import dense_index
from tidemart.sources.staging import Staging

SLICE_BYTES = 2 << 20
HELD_WORDS = 200_000
HELD_KEYS = 200_000
END = "$"
#: Longer keys are replaced by a fingerprint.
LITERAL = 64

_RUN = re.compile("[a-zÀ-ÿ]+")
_SMALL = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

# What an entry under a key is: the key is the whole rotation, or the rotation without its last
# character, which is where the word may be changed; FIRST marks the first of equal neighbours.
SKIP, FIRST, WHOLE = range(3)


def _count(batches: Iterator[pa.RecordBatch], least: int, typos: int) -> Iterator[pa.RecordBatch]:
    """Words of at least ``least`` characters with their counts, partial ones, many at a time."""
    resident.let_go()
    counts: Counter[str] = Counter()
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            for doc_id, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text"))):
                if not text:
                    continue
                runs = Counter(_RUN.findall(text.encode().translate(_SMALL).decode()))
                lead = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs.items():
                    if typos:
                        hashed = zlib.crc32(run.encode(), lead)
                        if hashed % typos == 0:
                            at = hashed % len(run)
                            run = run[:at] + run[at + 1 :]
                    if len(run) >= least:
                        counts[run] += n
                if len(counts) >= HELD_WORDS:
                    yield _counted(counts)
                    counts.clear()
    yield _counted(counts)


def _counted(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
        names=["word", "n"],
    )


def word_counts(docs: DataFrame, least_length: int = 5, typos: int = 0) -> DataFrame:
    """``word`` and ``n`` of the maximal runs of letters ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z as a-z.

    ``typos`` plants misspellings: where it divides the hash of ``<doc_id>:<run>``, the run loses
    the character that the hash points to (a null doc_id counts as empty). Words are combined in
    each task before they are shuffled.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    partial = texts.mapInArrow(lambda rows: _count(rows, least_length, typos), "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


class _Rotations:
    """The keys of one word: parts of its rotations, all as long as the word."""

    def __init__(self, word: str):
        self.whole = word + END + word + END
        self.long = len(word) >= LITERAL
        if self.long:
            # Running hashes, so that a word of thousands of letters costs no square of it.
            points = np.frombuffer(self.whole.encode("utf-32-le"), np.uint32).astype(object)
            self.sums = [_running(points, base) for base in _BASES]

    def key(self, start: int, length: int) -> str:
        if not self.long or length <= LITERAL:
            return self.whole[start : start + length]
        parts = [
            (sums[start + length] - sums[start] * pow(base, length, _PRIME)) % _PRIME
            for sums, base in zip(self.sums, _BASES)
        ]
        return f"#{length}:{parts[0]:x}:{parts[1]:x}"


_PRIME = (1 << 61) - 1
_BASES = tuple(int.from_bytes(hashlib.sha256(x).digest()[:7], "little") for x in (b"a", b"b"))


def _running(points: np.ndarray, base: int) -> list[int]:
    sums = [0]
    for point in points:
        sums.append((sums[-1] * base + int(point)) % _PRIME)
    return sums


def _rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rotations of the words, each as the keys under which its neighbours will lie."""
    keys: list[str] = []
    kinds: list[int] = []
    standings: list[int] = []

    def flush() -> pa.RecordBatch:
        columns = [pa.array(keys, pa.string()), pa.array(kinds, pa.int8()), pa.array(standings, pa.int64())]
        batch = pa.RecordBatch.from_arrays(columns, names=["key", "kind", "standing"])
        for column in (keys, kinds, standings):
            column.clear()
        return batch

    resident.let_go()
    for batch in batches:
        for word, standing in zip(batch.column("word").to_pylist(), batch.column("standing").to_pylist()):
            size, turn = len(word), _Rotations(word)
            before = ""
            for at, letter in enumerate(word):
                keys.append(turn.key(at + 1, size))
                kinds.append(SKIP if letter == before else FIRST)
                keys.append(turn.key(at, size + 1))
                kinds.append(WHOLE)
                standings += (standing, standing)
                before = letter
                if len(keys) >= HELD_KEYS:
                    yield flush()
            keys.append(turn.key(size, size + 1))
            kinds.append(WHOLE)
            standings.append(standing)
    yield flush()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal keys in sorted entries; a group that goes on in the next batch waits."""
    resident.let_go()
    waiting: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([waiting, table]).combine_chunks() if waiting is not None else table
        key = table.column("key")
        new = np.ones(len(table), bool)
        new[1:] = pc.not_equal(key.slice(1), key.slice(0, len(table) - 1)).to_numpy()
        last = int(np.flatnonzero(new)[-1])
        waiting = table.slice(last)
        yield _neighbours(table.slice(0, last), new[:last])
    if waiting is not None:
        new = np.zeros(len(waiting), bool)
        new[0] = True
        yield _neighbours(waiting, new)


def _neighbours(table: pa.Table, new: np.ndarray) -> pa.RecordBatch:
    """``standing``, its best neighbour and the number of neighbours, per entry and group.

    Under one key, words that skip a character differ by a replacement. The word that has the key
    as whole rotation lacks the skipped character of the others; of equal characters next to each
    other, the first alone stands for that, so that a pair meets under one key only.
    """
    kind = table.column("kind").to_numpy()
    standing = table.column("standing").to_numpy()
    group = np.cumsum(new) - 1
    groups = int(group[-1]) + 1 if len(group) else 0
    none = np.iinfo(np.int64).max
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def best_two(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the chosen entries per group, and their two least standings."""
        count = np.bincount(group[chosen], minlength=groups)
        start = np.cumsum(count) - count
        sorted_ = np.append(standing[chosen], [none, none])  # in order within a group
        first = np.where(count > 0, sorted_[start], none)
        return count, first, np.where(count > 1, sorted_[np.minimum(start + 1, len(sorted_) - 1)], none)

    skips, firsts, wholes = (np.flatnonzero(x) for x in (kind != WHOLE, kind == FIRST, kind == WHOLE))
    count, first, second = best_two(skips)
    of = group[skips]
    other = np.where(first[of] == standing[skips], second[of], first[of])
    out.append((standing[skips], other, count[of] - 1))
    whole_count, whole, _ = best_two(wholes)
    of = group[firsts]
    out.append((standing[firsts], whole[of], whole_count[of]))
    count, first, _ = best_two(firsts)
    of = group[wholes]
    out.append((standing[wholes], first[of], count[of]))
    columns = [np.concatenate(column) for column in zip(*out)]
    some = columns[2] > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(column[some], pa.int64()) for column in columns], names=["standing", "near", "n_near"]
    )


class SpellingVariants:
    """Words that differ by exactly one inserted, deleted or replaced character, and the most
    frequent of them.

    1. Words get a standing: more occurrences first, then code-point order.
    2. Every rotation of a word with an end mark gives two entries: the rotation itself, and the
       rotation without its last character. Sorted, neighbours lie under the same prefix, where the
       changed character is skipped. A prefix and one character make a word, so a group
       has no more entries than there are letters, and one; none can become hot.
    3. Groups are scanned in sorted order. An entry puts out its best neighbour and their number;
       no pair is written.
    """

    def __init__(self, staging: Staging, least_count: int = 3, factor: int = 2):
        self.staging, self.least_count, self.factor = staging, least_count, factor

    def find(self, counts: DataFrame) -> DataFrame:
        """``word``, ``n``, ``n_near``, ``form`` (its near word of largest n, then the first in
        code-point order, if that n is ``factor`` times the word's n at least), ``form_n`` and
        ``root`` of each word with ``least_count`` occurrences. No word gives no row."""
        staging = self.staging
        words = counts.where(f"n >= {self.least_count}").selectExpr("-n AS less", "word")
        words = dense_index(words, ["less", "word"], "standing", staging)
        words = staging.settle(words.selectExpr("standing", "word", "-less AS n"), "words")
        entries = words.select("word", "standing").mapInArrow(_rotate, "key string, kind tinyint, standing bigint")
        entries = entries.repartition("key").sortWithinPartitions("key", "standing")
        near = entries.mapInArrow(_scan, "standing bigint, near bigint, n_near bigint")
        near = near.groupBy("standing").agg(F.min("near").alias("near"), F.sum("n_near").alias("n_near"))
        known = words.selectExpr("standing AS near", "word AS form", "n AS form_n")
        found = words.join(near, "standing", "left").join(known, "near", "left")
        frequent = f"form_n >= {self.factor} * n"
        found = found.selectExpr(
            "standing", "word", "n", "coalesce(n_near, 0L) AS n_near",
            *[f"IF({frequent}, {name}, NULL) AS {name}" for name in ("near", "form", "form_n")],
        )
        found = staging.settle(found, "forms")
        ends = self._ends(found.where("near IS NOT NULL").selectExpr("standing", "near AS target"))
        roots = ends.join(words.selectExpr("standing AS target", "word AS root"), "target").select("standing", "root")
        found = found.join(roots, "standing", "left")
        return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

    def _ends(self, steps: DataFrame) -> DataFrame:
        """The last ``target`` of each chain of forms. Each round doubles the way covered; counts
        grow along a chain, so it ends, after a number of rounds that grows with their logarithm's."""
        number = 0
        while True:
            further = steps.selectExpr("standing AS target", "target AS far")
            jumped = steps.join(further, "target", "left").selectExpr(
                "standing", "coalesce(far, target) AS target", "far IS NOT NULL AS moved"
            )
            number += 1
            jumped = self.staging.settle(jumped, f"chains_{number}")
            steps = jumped.select("standing", "target")
            if jumped.where("moved").isEmpty():
                return steps


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, with planted misspellings."""
    docs, staging = spark.read.parquet(f"{sf_dir}/documents.parquet"), Staging(spark)
    return SpellingVariants(staging).find(word_counts(docs, least_length=5, typos=97))
