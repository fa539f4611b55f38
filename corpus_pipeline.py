"""From documents to token ids: quality, exact and near duplicates, mixture, encoding.

A stage works on all rows that the one before it kept, as written to Parquet and read again,
and returns them with the columns of ``documents``; the last returns ids.

For all of them: further columns, whatever their names, are kept as they are. Rows are taken as
rows, so repeated ones are copies of each other like any others, and a null doc_id counts as larger
than every number. Null, empty and very long texts are texts; each stage says what it makes of
them. A table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import bpe, exact, minhash, mixing, quality
from tidemart.llm.shipping import ship
from tidemart.sources.staging import Staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects. Null and empty texts are judged
    by their features, all zero; without labels of both kinds evidence is even, and sites decide."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.from_labels(docs, labels).kept(docs, Staging(spark))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for blanks: the longest, then the first. Null,
    empty and blank texts are one group."""
    ship(spark)
    return exact.one_of_each(docs, Staging(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by four fifths of their five-word shingles: the first.
    Texts without a word link with nothing and stay; shorter ones are a shingle as they are."""
    ship(spark)
    return minhash.one_of_each(docs, Staging(spark), minhash.NearDuplicates(k=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of a mixture of four fifths of all tokens, each once. A leaf's prefix is cut
    behind the document that fills it. Texts without tokens go with their place in the order;
    a null source or language is an empty name."""
    ship(spark)
    mixture = mixing.Mixture(0.8, mixing.WEIGHTS, epochs=1, seed=17)
    return mixture.chosen(docs, mixing.document_levels(), Staging(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the bytes they decode to; a null text has none."""
    ship(spark)
    # Workers of the earlier stages are still there, so each holds less than it would alone.
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), held=120_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL cannot express the classifier; tests hold every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, staging = spark.read.parquet(f"{sf_dir}/documents.parquet"), Staging(spark)
    for number, (name, stage) in enumerate(STAGES):
        docs = staging.settle(stage(spark, docs, sf_dir), f"{number}_{name}")
    return docs
