"""Near-duplicate documents by min-max hashing, with every link confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import resident
from tidemart.llm.components import components
from tidemart.llm.rows import LOCATOR, located, only, slices, stored, text_bytes
from tidemart.llm.shingles import MinMax, Powers, shingle_sets
from tidemart.sources.staging import Staging

SLICE_BYTES = 1 << 20
SIGNED = "doc_id bigint, loc_file bigint, loc_row bigint, n bigint, fp binary, bands array<bigint>"
SETS = "fp binary, n bigint, shingles array<bigint>"


def _fingerprints(values: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """128 bits of each set; equal sets have equal ones."""
    raw, out, start = values.tobytes(), [], 0
    for size in sizes.tolist():
        stop = start + 8 * size
        out.append(hashlib.blake2b(raw[start:stop], digest_size=16).digest() if size else None)
        start = stop
    return out


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, values)


def _sign(k: int, hashing: MinMax) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident.let_go()
        powers = Powers()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                values, sizes = shingle_sets(*text_bytes(part.column("text")), k, powers)
                filled = sizes > 0
                keys = np.empty((0, hashing.bands), np.int64)
                if filled.any():
                    starts = (np.cumsum(sizes) - sizes)[filled]
                    keys = hashing.band_keys(hashing.signatures(values, starts))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", *LOCATOR)),
                        pa.array(sizes),
                        pa.array(_fingerprints(values, sizes), pa.binary()),
                        _lists(keys.reshape(-1), filled * hashing.bands),
                    ],
                    names=["doc_id", *LOCATOR, "n", "fp", "bands"],
                )

    return run


def _collect_sets(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident.let_go()
        powers = Powers()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                values, sizes = shingle_sets(*text_bytes(part.column("text")), k, powers)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_fingerprints(values, sizes), pa.binary()),
                        pa.array(sizes),
                        _lists(values.view(np.int64), sizes),
                    ],
                    names=["fp", "n", "shingles"],
                )

    return run


class NearDuplicates:
    """Links texts whose sets of ``k``-word shingles have ``100 * common >= percent * all``.

    1. Texts with the same set form a class; from here on there is one row per class.
    2. ``rows * bands`` minima and maxima, from half as many permutations, are banded. At the
       least similarity asked for, a pair shares no band with probability
       ``(1 - (percent / 100) ** rows) ** bands``: 8e-7 for 85, 5 and 24, 2e-7 for 80, 4 and 30.
    3. Full sets are gathered for classes that share a band. A shingle that no other of them
       has cannot be common to two, which bounds each class's similarity to any other and
       drops the classes that can have no link.
    4. In each band every class is compared with one of its members, on full sets. Classes that
       are already connected need no more links.
    5. Bands that still hold several components go through an exact prefix filter: their classes
       are compared where they share one of their rarest shingles, and only if sizes and places
       leave room for enough common ones. Again one member of each shingle comes first.

    No band and no shingle is capped. What is left to compare in pairs are classes of different
    components that share a rare shingle.
    """

    def __init__(self, k: int = 5, percent: int = 80, rows: int = 4, bands: int = 30):
        self.k, self.percent, self.rows, self.bands = k, percent, rows, bands

    def _possible(self, a: str, b: str) -> Column:
        return F.expr(
            f"({100 + self.percent}) * least({a}.n - {a}.own, {b}.n - {b}.own)"
            f" >= {self.percent} * ({a}.n + {b}.n)"
        )

    def _similar(self, a: str, b: str) -> Column:
        return F.expr(
            f"({100 + self.percent}) * size(array_intersect({a}.shingles, {b}.shingles))"
            f" >= {self.percent} * ({a}.n + {b}.n)"
        )

    def find(self, docs: DataFrame, staging: Staging) -> DataFrame:
        """``doc_id``, locator, ``n_shingles``, ``component_id`` and ``stays`` of every row.

        ``component_id`` is the smallest doc_id reachable over links, the row's own included;
        ``stays`` marks one row of each component: the first by doc_id, then by locator. Null
        and empty texts, and texts without a word, link with nothing and stay. Repeated rows
        are of one component. A null doc_id counts as larger than all others and is a
        component's id only if the component has no other. No input row gives no row.
        """
        docs = stored(docs, staging)
        texts = located(docs, F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        signed = texts.mapInArrow(_sign(self.k, MinMax(self.rows, self.bands)), SIGNED)
        signed = staging.settle(signed, "signed")
        classes = self._classes(signed, staging)
        leads = classes.select("fp", "lead")
        linked = self._linked(docs, classes, staging)
        better = linked.groupBy("component").agg(F.min("lead").alias("better"))
        better = linked.join(better, "component").select("fp", "better")
        leads = leads.join(better, "fp", "left").select(
            "fp", F.coalesce("better", "lead").alias("lead")
        )
        # Written, so that the next join has shuffles of its own: those can be split where very
        # many rows share a fingerprint.
        leads = staging.settle(leads, "leads")
        row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *LOCATOR)
        filled = signed.where("fp IS NOT NULL").join(leads, "fp")
        filled = filled.select(
            "doc_id", *LOCATOR, "n", "lead.doc_id", (row == F.col("lead")).alias("stays")
        )
        empty = signed.where("fp IS NULL").select("doc_id", *LOCATOR, "n", "doc_id", F.lit(True))
        return filled.union(empty).toDF(
            "doc_id", *LOCATOR, "n_shingles", "component_id", "stays"
        )

    def _classes(self, signed: DataFrame, staging: Staging) -> DataFrame:
        """One row per distinct set: its fingerprint, first row, size and band keys."""
        row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *LOCATOR)
        first = F.min(F.struct(row.alias("lead"), "n", "bands")).alias("first")
        classes = signed.where("fp IS NOT NULL").groupBy("fp").agg(first)
        return staging.settle(classes.select("fp", "first.*"), "classes")

    def _linked(self, docs: DataFrame, classes: DataFrame, staging: Staging) -> DataFrame:
        """``fp``, ``lead`` and ``component`` of every class that has a link."""
        buckets = classes.select("fp", F.explode("bands").alias("key"))
        shared = buckets.groupBy("key").count().where("count > 1").select("key")
        shared = staging.settle(buckets.join(shared, "key"), "shared")
        wanted = shared.select("fp").distinct().join(classes, "fp").select("lead.*")
        texts = located(docs, F.col("text").cast("string").alias("text"))
        texts = texts.join(wanted.select(*LOCATOR).hint("shuffle_hash"), LOCATOR, "left_semi")
        sets = texts.select("text").mapInArrow(_collect_sets(self.k), SETS)
        sets = staging.settle(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
        rows = self._rows(shared, sets, staging)
        links = staging.settle(self._confirmed(self._stars(rows), sets), "stars")
        merged = components(links, staging, "stars_merged")
        rows = self._prefixes(rows, merged, sets, staging)
        if not rows.isEmpty():
            stars = staging.settle(self._confirmed(self._stars(rows), sets), "prefix_stars")
            if not stars.isEmpty():
                links = links.unionByName(stars)
                merged = components(links, staging, "prefix_stars_merged")
                rows = self._labelled(rows.drop("component"), merged)
            across = staging.settle(self._confirmed(self._across(rows), sets), "across")
            if not across.isEmpty():
                merged = components(links.unionByName(across), staging, "merged")
        nodes = sets.select("node", "fp").join(merged, "node")
        return staging.settle(
            nodes.join(classes, "fp").select("fp", "lead", "component"), "linked"
        )

    def _rows(self, shared: DataFrame, sets: DataFrame, staging: Staging) -> DataFrame:
        """``key``, ``node``, ``n``, ``own`` for the classes that may have a link; ``own`` counts
        the shingles that no other candidate has, and ``apart`` is their share."""
        shingle = sets.select("node", F.explode("shingles").alias("shingle"))
        single = shingle.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("node").alias("node"))
        own = single.where("sets = 1").groupBy("node").agg(F.count("*").alias("own"))
        nodes = sets.select("node", "fp", "n").join(own, "node", "left").na.fill(0, ["own"])
        nodes = nodes.where(f"100 * (n - own) >= {self.percent} * n")
        rows = shared.join(nodes, "fp").select(
            "key", "node", "n", "own", (F.col("own") / F.col("n")).alias("apart"), F.col("node").alias("component")
        )
        return staging.settle(rows, "rows")

    def _stars(self, rows: DataFrame) -> DataFrame:
        """Pairs of each class and one member of each of its keys: the one with the least share
        of shingles of its own, which is what near copies were made from rather than one of
        them. So the keys of a group mostly elect the same one, and their pairs are few."""
        member = F.struct("node", "n", "own", "component")
        central = F.struct("apart", F.xxhash64("node"))
        hub = rows.groupBy("key").agg(F.min_by(member, central).alias("y"))
        pairs = rows.alias("x").join(hub, "key").where("x.component <> y.component")
        return pairs.where(self._possible("x", "y"))

    def _confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs that are similar, once each."""
        pairs = pairs.select(
            F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
        ).distinct()
        x = sets.select(F.col("node").alias("a"), "n", "shingles").alias("x")
        y = sets.select(F.col("node").alias("b"), "n", "shingles").alias("y")
        return pairs.join(x, "a").join(y, "b").where(self._similar("x", "y")).select("a", "b")

    @staticmethod
    def _labelled(rows: DataFrame, merged: DataFrame) -> DataFrame:
        rows = rows.join(merged, "node", "left")
        return rows.withColumn("component", F.coalesce("component", "node"))

    def _prefixes(self, rows: DataFrame, merged: DataFrame, sets: DataFrame, staging: Staging) -> DataFrame:
        """Rows again for the classes of bands that have several components, with shingles as keys.

        Ordered from the rarest shingle among these classes to the most frequent one, two
        similar sets share one of their first ``n - ceil(percent * n / 100) + 1``. ``own`` counts
        the shingles before the key: at the first that is common, those cannot be.
        """
        rows = self._labelled(rows.drop("component"), merged)
        ends = F.min("component").alias("least"), F.max("component").alias("most")
        open_ = rows.groupBy("key").agg(*ends).where("least <> most").select("key")
        columns = ["node", "n", "component", "apart"]
        nodes = rows.join(open_, "key").select("node", "component", "apart").distinct()
        tokens = nodes.join(sets, "node").select(*columns, F.explode("shingles").alias("key"))
        held = tokens.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1")
        ordered = F.sort_array(F.collect_list(F.struct("sets", "key"))).alias("held")
        held = tokens.join(held, "key").groupBy(*columns).agg(ordered)
        reach = f"n - ({self.percent} * n + 99) div 100 + 1"
        held = held.selectExpr("*", "n - size(held) AS alone")
        first = f"slice(held, 1, CAST(greatest(0, {reach} - alone) AS INT))"
        places = held.selectExpr(*columns, "alone", f"posexplode({first}) AS (at, entry)")
        return staging.settle(
            places.selectExpr("entry.key AS key", *columns, "alone + at AS own"), "prefixes"
        )

    def _across(self, rows: DataFrame) -> DataFrame:
        """Pairs of different components that share a key and may be similar."""
        x, y = rows.alias("x"), rows.alias("y")
        apart = F.expr("x.key = y.key AND x.component < y.component")
        return x.join(y, apart & self._possible("x", "y"))


def one_of_each(docs: DataFrame, staging: Staging, finder: NearDuplicates) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each component stays."""
    docs = stored(docs, staging)
    return only(docs, finder.find(docs, staging).where("stays"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that share 85 % of their 3-word shingles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = NearDuplicates(k=3, percent=85, rows=5, bands=24).find(docs, Staging(spark))
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
