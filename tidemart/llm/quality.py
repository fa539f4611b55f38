"""Quality by hierarchical empirical Bayes: a document's own evidence, with what its path and
its host are like, each shrunk towards the level above."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import logistic, resident
from tidemart.llm.fertility import repeated_words
from tidemart.llm.rows import labelled_sample, slices, text_bytes, words
from tidemart.llm.shingles import Powers, word_hashes
from tidemart.sources.staging import Staging

SLICE_BYTES = 1 << 20
FEATURES = [
    "length", "word_size", "upper", "digits", "symbols", "bars", "exclaims", "stops",
    "echoes", "distinct", "repeats", "lines",
]


def _share(kind: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(kind)] = True
    return table


_UPPER = _share(bytes(range(0x41, 0x5B)))
_DIGIT = _share(b"0123456789")
_SYMBOL = _share(b"#*$%&<>@^~=+_{}[]\\")
_STOP = _share(b".?")


def describe(column: pa.Array, powers: Powers) -> np.ndarray:
    """A row of ``FEATURES`` for every text of an Arrow array."""
    data, offsets = text_bytes(column)
    texts = len(column)
    begins, ends, owner = words(data, offsets)
    n = np.bincount(owner, minlength=texts)
    of_byte = np.repeat(np.arange(texts), np.diff(offsets))
    ink = np.maximum(np.bincount(owner, weights=ends - begins, minlength=texts), 1)
    some = np.maximum(n, 1)

    def share(table: np.ndarray) -> np.ndarray:
        return np.bincount(of_byte[table[data]], minlength=texts) / ink

    hashes = word_hashes(data, begins, ends, powers, fold=False)
    echo = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]) if len(hashes) else []
    echoes = np.bincount(owner[1:][echo], minlength=texts) if len(hashes) else np.zeros(texts)
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=texts)
    last = data[ends - 1] if len(ends) else np.empty(0, np.uint8)
    return np.column_stack(
        [
            np.log1p(n),
            ink / some,
            share(_UPPER),
            share(_DIGIT),
            np.sqrt(share(_SYMBOL)),
            np.sqrt(share(_share(b"|"))),
            np.sqrt(share(_share(b"!"))),
            np.bincount(owner[_STOP[last]], minlength=texts) / some,
            echoes / some,
            np.log(np.maximum(distinct, 1)) / np.log(some + 1),
            repeated_words(hashes, owner, texts) / some,
            np.log1p(np.bincount(of_byte[data == 10], minlength=texts)) - np.log1p(n),
        ]
    )


def _described(column: pa.Array) -> np.ndarray:
    resident.let_go()
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    powers = Powers()
    rows = [describe(part.column("text"), powers) for part in slices(batch, "text", SLICE_BYTES)]
    return np.concatenate(rows) if rows else np.empty((0, len(FEATURES)))


@dataclass(frozen=True)
class Evidence:
    """A document classifier: log-odds of good quality from a text's features."""

    weights: tuple[float, ...]
    mean: tuple[float, ...]
    bias: float

    def log_odds(self) -> Callable[[Column], Column]:
        weights, mean, bias = np.array(self.weights), np.array(self.mean), self.bias

        @F.arrow_udf("double")
        def of(column: pa.Array) -> pa.Array:
            # Far from 0 the fit says no more than that it is sure.
            return pa.array(np.clip((_described(column) - mean) @ weights + bias, -12, 12))

        return of


def _features(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def of(column: pa.Array) -> pa.Array:
        return pa.array(_described(column).tolist(), pa.list_(pa.float64()))

    return of(text)


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Evidence:
    """Fit the texts of ``docs`` and the ``label`` (1: good) of their doc_id, with at most
    ``sample`` labels. Without both kinds of them every text gets even odds."""
    rows = labelled_sample(docs, labels, sample)
    seen = rows.select("label", _features(F.col("text")).alias("row")).collect()
    labels = np.array([row.label for row in seen])
    if len(set(labels.tolist())) < 2:
        return Evidence((0.0,) * len(FEATURES), (0.0,) * len(FEATURES), 0.0)
    x = np.array([row.row for row in seen])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights, bias = logistic.fit((x - mean) / spread, labels)
    return Evidence(tuple((weights / spread).tolist()), tuple(mean.tolist()), bias)


def sites(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path of a document. A source that is a URL or has slashes is cut at its host
    and first path segment; the path of any other source is its language."""
    source = F.coalesce(F.col("source").cast("string"), F.lit("")) if "source" in docs.columns else F.lit("")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    bare = F.regexp_replace(source, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, r"^([^/?#]*)", 1)
    path = F.regexp_extract(bare, r"^[^/?#]*/([^/?#]*)", 1)
    return F.lower(host), F.when(bare.contains("/"), path).otherwise(lang)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def posteriors(evidence: DataFrame, strength: float = 20.0) -> DataFrame:
    """``host``, ``path``, ``host_good``, ``path_good`` and ``all_good`` from all rows' ``host``,
    ``path`` and ``odds``.

    The mean probability of all documents is the prior of a host, whose posterior mean is the
    prior of its paths; a prior weighs as much as ``strength`` documents. The sums of paths are
    added up to hosts, and those to the whole, so the rows are shuffled once, already summed.
    """
    good = 1 / (1 + F.exp(-F.col("odds")))
    paths = evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(good).alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    whole = hosts.agg(F.sum("host_n").alias("all_n"), F.sum("host_s").alias("all_s"))
    # One row: a mean of all documents, half a document of either kind added.
    whole = whole.select(((F.col("all_s") + 0.5) / (F.col("all_n") + 1)).alias("all_good"))
    hosts = hosts.join(F.broadcast(whole))
    host_good = (F.col("host_s") + strength * F.col("all_good")) / (F.col("host_n") + strength)
    hosts = hosts.select("host", "all_good", host_good.alias("host_good"))
    path_good = (F.col("s") + strength * F.col("host_good")) / (F.col("n") + strength)
    return paths.join(hosts, "host").select(
        "host", "path", "host_good", path_good.alias("path_good"), "all_good"
    )


class QualityClassifier:
    """Rejects documents whose score is below ``least``.

    A document's log-odds are its evidence plus what its path differs from the whole, so a
    site without documents of its own to speak of changes nothing. Null and empty texts are
    scored by their features like any other; a null source or language is a site of its own;
    equal rows get equal scores; no row gives no row.
    """

    def __init__(self, evidence: Evidence, strength: float = 20.0, least: float = 0.5):
        self.evidence, self.strength, self.least = evidence, strength, least

    def scored(self, docs: DataFrame, staging: Staging) -> DataFrame:
        """``doc_id``, ``odds``, ``host_good``, ``path_good``, ``score`` and ``kept``."""
        host, path = sites(docs)
        log_odds = self.evidence.log_odds()
        rows = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            host.alias("host"),
            path.alias("path"),
            log_odds(F.col("text").cast("string")).alias("odds"),
        )
        rows = staging.settle(rows, "evidence")
        # Written, so that Spark knows its size: few sites are broadcast, many are not.
        site = staging.settle(posteriors(rows, self.strength), "sites")
        joined = rows.join(site, ["host", "path"]).withColumn("score", self._score())
        return joined.select(
            "doc_id", "odds", "host_good", "path_good", "score",
            (F.col("score") >= self.least).alias("kept"),
        )

    @staticmethod
    def _score() -> Column:
        odds = F.col("odds") + _logit(F.col("path_good")) - _logit(F.col("all_good"))
        return 1 / (1 + F.exp(-odds))

    def kept(self, docs: DataFrame, staging: Staging) -> DataFrame:
        """The rows of ``docs`` that are not rejected. A text is read twice, and never shuffled
        while the sites' posteriors are small enough for Spark to broadcast."""
        names = docs.columns
        host, path = sites(docs)
        odds = self.evidence.log_odds()(F.col("text").cast("string"))
        rows = docs.select(host.alias("host"), path.alias("path"), odds.alias("odds"))
        site = staging.settle(posteriors(rows, self.strength), "sites")
        packed = docs.select(
            F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
            host.alias("host"), path.alias("path"), odds.alias("odds"),
        )
        joined = packed.join(site, ["host", "path"]).where(self._score() >= self.least)
        return joined.select(*[F.col(f"row.`{name}`").alias(name) for name in names])


def from_labels(docs: DataFrame, labels: DataFrame) -> QualityClassifier:
    """Learned from the labels outside the held-out fifth."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    known = labels.where(~held_out).select("doc_id", F.col("quality").alias("label"))
    return QualityClassifier(learn(docs, known))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, with their sites' posteriors."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return from_labels(docs, labels).scored(docs, Staging(spark))
