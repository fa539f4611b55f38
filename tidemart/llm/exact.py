"""Exact deduplication as a stream with disk-backed keyed state that never expires."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.rows import LOCATOR, located, only, stored
from tidemart.sources.staging import Staging

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def bare(text: Column) -> Column:
    """The text without blanks, tabs and line ends; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class ExactDuplicates:
    """Groups of texts that are the same but for blanks.

    Rows stream through a keyed aggregation whose state lies in RocksDB under
    ``<folder>/state``: per digest the number of rows so far, and of the row that stays its
    identifier and where its content is stored. Rows of a micro-batch are combined before they
    are shuffled, so a text that makes up much of the input is a few rows per task.
    Each row whose digest has other rows is then compared, byte for byte, with the content that
    the state points to; texts that only share a digest are grouped apart.

    ``files`` bounds a micro-batch. ``digest`` can be replaced by a weaker one in tests.
    """

    def __init__(self, files: int = 1000, digest=sha256):
        self.files, self.digest = files, digest

    def find(self, docs: DataFrame, staging: Staging) -> DataFrame:
        """``doc_id``, locator, ``digest``, ``keep`` (the row that stays), ``group_size`` and
        ``stays`` of every row.

        The row with the most code points stays, then the smallest doc_id (null counts as the
        largest), then the first stored. Null and empty texts are one group. Repeated rows are
        members like any other. No input row gives no row.
        """
        docs = stored(docs, staging)
        length = F.char_length(F.coalesce(F.col("text").cast("string"), F.lit("")))
        rows = located(
            docs,
            F.col("doc_id").cast("bigint").alias("doc_id"),
            self.digest(bare(F.col("text"))).alias("digest"),
            length.alias("length"),
        )
        rows = staging.settle(rows, "digests")
        state = staging.settle(self.stream(rows.schema, staging), "groups")
        found = rows.join(state, "digest")
        clashes = self._clashes(docs, found, staging)
        if not clashes.isEmpty():
            found = self._apart(found, clashes)
        here = F.struct(*LOCATOR)
        kept = F.struct(*[F.col(f"keep.{name}").alias(name) for name in LOCATOR])
        return found.select(
            "doc_id", *LOCATOR, "digest", "keep", "group_size", (here == kept).alias("stays")
        )

    @staticmethod
    def _first() -> Column:
        """The row that stays, as a minimum."""
        return F.min(
            F.struct(
                (-F.col("length")).alias("shortness"),
                F.col("doc_id").isNull().alias("none"),
                "doc_id",
                *LOCATOR,
            )
        ).alias("keep")

    def stream(self, schema, staging: Staging) -> DataFrame:
        """Let the digests pass through the state, and read what it holds afterwards. Called
        again for the same folder, it goes on from the state and takes new files only."""
        spark, checkpoint = staging.spark, f"{staging.path}/state"
        own = spark.newSession()  # the state's settings stay out of the caller's session
        for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
            own.conf.set(name, spark.conf.get(name))
        own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
        # Files as large as what is in them: a store per partition would reserve megabytes each.
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
        # One bound for all stores of an executor, however many partitions it holds.
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
        own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "200")
        source = own.readStream.schema(schema).option("maxFilesPerTrigger", self.files)
        groups = (
            source.parquet(f"{staging.path}/digests")
            .groupBy("digest")
            .agg(F.count("*").alias("group_size"), self._first())
        )
        query = (
            groups.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        held = own.read.format("statestore").load(checkpoint)
        counted, kept = held.schema["value"].dataType.names[-2:]
        if held.schema["value"].dataType[kept].dataType.typeName() != "struct":
            raise RuntimeError(f"the state has another layout: {held.schema.simpleString()}")
        return held.select(
            F.col("key.digest").alias("digest"),
            F.col(f"value.`{counted}`").alias("group_size"),
            F.col(f"value.`{kept}`").alias("keep"),
        )

    def _clashes(self, docs: DataFrame, found: DataFrame, staging: Staging) -> DataFrame:
        """``digest``, ``text`` and locator of all rows of digests that more texts share."""
        hits = found.where("group_size > 1").select(
            *LOCATOR,
            "digest",
            (F.struct(*LOCATOR) == F.struct("keep.loc_file", "keep.loc_row")).alias("kept"),
        )
        texts = located(docs, bare(F.col("text")).alias("text"))
        hits = staging.settle(texts.join(hits.hint("shuffle_hash"), LOCATOR), "hits")
        kept = hits.where("kept").selectExpr("digest AS kept_digest", "text AS kept_text")
        # Digests are never null. Null-safe, the join is partitioned by other expressions than
        # what follows, so adaptive execution can split a digest that very many rows share.
        other = hits.where("NOT kept").join(kept, F.expr("digest <=> kept_digest"))
        other = other.where("text <> kept_text")
        return hits.join(other.select("digest").distinct(), "digest", "left_semi")

    def _apart(self, found: DataFrame, clashes: DataFrame) -> DataFrame:
        """The groups again where one digest stood for several texts."""
        rows = found.join(clashes.select(*LOCATOR, "text"), LOCATOR, "left")
        plain = rows.where("text IS NULL").drop("text")
        mixed = rows.where("text IS NOT NULL").drop("group_size", "keep")
        groups = mixed.groupBy("digest", "text").agg(
            F.count("*").alias("group_size"), self._first()
        )
        return plain.unionByName(mixed.join(groups, ["digest", "text"]).drop("text"))


def one_of_each(docs: DataFrame, staging: Staging) -> DataFrame:
    """The rows of ``docs`` without exact duplicates."""
    docs = stored(docs, staging)
    return only(docs, ExactDuplicates().find(docs, staging).where("stays"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the row that stays of its group of equal texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = ExactDuplicates().find(docs, Staging(spark))
    return found.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        F.col("stays").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
