"""Mixing sources to target weights by budgets handed down a tree of domain, language and
source. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.sources.staging import Staging

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ["domain", "lang", "source"]


class Mixture:
    """Budgets for the leaves of a tree, and each leaf's share of its documents.

    ``budget`` is a share of all tokens. A node's budget is split among its children by their
    ``weights`` (level -> value -> weight, 1 where none is given; nothing goes to weight 0). A
    child takes no more than its capacity, ``epochs`` times its tokens; what it leaves goes to
    its siblings by their weights, and only what all of them together cannot take has already
    gone to the siblings of their parent. What no leaf can take stays unused.

    A leaf takes whole epochs, then a prefix of one more. Documents of an epoch are ordered by
    MD5 of seed, epoch and doc_id, so rows with the same doc_id have one place together.
    """

    def __init__(
        self,
        budget: float,
        weights: dict[str, dict[str, float]],
        epochs: int = 1,
        seed: int = 0,
        bucket_rows: int = 5000,
    ):
        self.budget, self.weights, self.epochs, self.seed = budget, weights, epochs, seed
        self.bucket_rows = bucket_rows

    def _weight(self, level: str) -> Column:
        out = F.lit(1.0)
        for value, weight in self.weights.get(level, {}).items():
            out = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(out)
        return out

    def _reach(self, level: str) -> Column:
        reached = F.when(self._weight(level) > 0, F.col("capacity")).otherwise(0.0)
        return F.sum(reached).alias("capacity")

    def key(self) -> Column:
        """A document's place in the epoch numbered ``whole``."""
        name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        return F.md5(F.concat(F.lit(f"{self.seed}:"), F.col("whole").cast("string"), F.lit(":"), name))

    def _share(self, nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
        """Split ``given`` of each parent among its children.

        Children are filled to ``level * weight`` but not beyond capacity. In order of capacity
        over weight, a child is full if what the fuller ones leave is enough for it.
        """
        nodes = nodes.withColumn("weight", self._weight(level))
        nodes = nodes.withColumn("point", F.expr("capacity / nullif(weight, 0)"))
        siblings = Window.partitionBy(*parent)
        order = siblings.orderBy(F.col("point").asc_nulls_last(), level)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        real = F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0.0)
        left = F.col("given") - F.coalesce(F.sum(real).over(before), F.lit(0.0))
        lighter = F.sum("weight").over(siblings) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
        nodes = nodes.withColumn("full", F.coalesce(F.col("point") * lighter <= left, F.lit(False)))
        filled = F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0.0)).over(siblings)
        open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(siblings)
        rest = (F.col("given") - filled) * F.col("weight") / F.nullif(open_weight, F.lit(0.0))
        taken = F.when(F.col("full"), F.col("capacity")).otherwise(F.coalesce(rest, F.lit(0.0)))
        return nodes.withColumn("taken", taken)

    def leaves(self, rows: DataFrame) -> DataFrame:
        """Budget ``tokens_given`` and number of ``whole`` epochs of every leaf."""
        leaf = rows.groupBy(*LEVELS).agg(
            F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents")
        )
        leaf = leaf.withColumn("capacity", F.col("tokens").cast("double") * self.epochs)
        # A node can take what its children of positive weight can, from the leaves upwards.
        langs = leaf.groupBy("domain", "lang").agg(self._reach("source"), F.sum("capacity").alias("all"))
        domains = langs.groupBy("domain").agg(self._reach("lang"), F.sum("all").alias("all"))
        # The whole tree has few nodes at this level; the sum is one row.
        whole = domains.agg((F.sum("all") * (self.budget / self.epochs)).alias("given"))
        domains = domains.join(F.broadcast(whole)).withColumn("root", F.lit(0))
        domains = self._share(domains, ["root"], "domain")
        langs = self._under(langs, domains, ["domain"])
        langs = self._share(langs, ["domain"], "lang")
        leaf = self._under(leaf, langs, ["domain", "lang"])
        leaf = self._share(leaf, ["domain", "lang"], "source")
        leaf = leaf.withColumn("tokens_given", F.floor(F.col("taken") + 1e-6))
        leaf = leaf.withColumn("whole", F.expr("coalesce(tokens_given DIV nullif(tokens, 0), 0)"))
        return leaf.select(*LEVELS, "tokens", "documents", "tokens_given", "whole")

    @staticmethod
    def _under(nodes: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
        return nodes.join(parents.select(*on, F.col("taken").alias("given")), on)

    def cuts(self, rows: DataFrame, leaves: DataFrame) -> DataFrame:
        """Where each leaf's prefix ends: ``last_key``, the last place that is part of it, and
        ``last_before``, the tokens before that place. Null: the prefix is empty.

        Places are summed by ranges of keys first, about ``bucket_rows`` documents each, so
        that a leaf with a third of all documents is spread over many tasks.
        """
        placed = rows.join(leaves, LEVELS).withColumn("key", self.key())
        places = placed.groupBy(*LEVELS, "key").agg(
            F.sum("n_tokens").alias("n"),
            F.first("documents").alias("documents"),
            F.first(F.expr("tokens_given - whole * tokens")).alias("rest"),
        )
        ranges = F.ceil(F.col("documents") / self.bucket_rows)
        at = F.conv(F.substring("key", 1, 7), 16, 10).cast("bigint")
        places = places.withColumn("bucket", F.floor(at * ranges / (1 << 28)))
        buckets = places.groupBy(*LEVELS, "bucket").agg(F.sum("n").alias("bucket_n"))
        earlier = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        buckets = buckets.withColumn("earlier", F.coalesce(F.sum("bucket_n").over(earlier), F.lit(0)))
        places = places.join(buckets, [*LEVELS, "bucket"])
        # Only the bucket that the prefix ends in has to be ordered.
        places = places.where("earlier < rest AND rest <= earlier + bucket_n")
        inside = Window.partitionBy(*LEVELS, "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("earlier") + F.coalesce(F.sum("n").over(inside), F.lit(0))
        places = places.withColumn("before", before).where("before < rest")
        last = F.max(F.struct("key", "before")).alias("last")
        return places.groupBy(*LEVELS).agg(last).select(
            *LEVELS, F.col("last.key").alias("last_key"), F.col("last.before").alias("last_before")
        )

    def plan(self, docs: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
        """Rows ``doc_id``, levels and ``n_tokens`` of ``docs`` (with a column for each level),
        and the leaves with their budgets and cuts."""
        rows = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            *[F.coalesce(F.col(level).cast("string"), F.lit("")).alias(level) for level in LEVELS],
            F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
            .cast("bigint")
            .alias("n_tokens"),
        )
        rows = staging.settle(rows, "tokens")
        leaves = staging.settle(self.leaves(rows), "leaves")
        cuts = self.cuts(rows, leaves)
        return rows, staging.settle(leaves.join(cuts, LEVELS, "left"), "cuts")

    def mixed(self, docs: DataFrame, staging: Staging) -> DataFrame:
        """Every row with its leaf, ``whole_epochs``, ``last_tokens`` (taken in the epoch after
        them; of the last place, as many as are left) and ``taken_tokens``.

        Null and empty texts have no tokens and nothing is taken of them. A null level counts
        as an empty name. Repeated rows are taken together. No row gives no row.
        """
        rows, leaves = self.plan(docs, staging)
        rows = rows.join(leaves, LEVELS).withColumn("key", self.key())
        rest = F.expr("least(n_tokens, tokens_given - whole * tokens - last_before)")
        last = F.when(F.col("key") < F.col("last_key"), F.col("n_tokens"))
        last = last.when(F.col("key") == F.col("last_key"), rest).otherwise(0)
        taken = F.col("whole") * F.col("n_tokens") + F.col("last_tokens")
        return rows.withColumn("last_tokens", last.cast("bigint")).select(
            "doc_id", *LEVELS, "n_tokens", F.col("whole").alias("whole_epochs"), "last_tokens",
            taken.alias("taken_tokens"),
        )

    def chosen(self, docs: DataFrame, levels: dict[str, Column], staging: Staging) -> DataFrame:
        """The rows of ``docs`` that an epoch or the prefix has, each once and whole; for
        mixtures of one epoch. Texts without tokens go with their place in the order; leaves
        without any tokens give none. Texts are not shuffled while the leaves can be
        broadcast."""
        names = docs.columns
        named = docs.select("doc_id", "text", *[levels[level].alias(level) for level in LEVELS])
        leaves = self.plan(named, staging)[1]
        packed = docs.select(
            F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            *[F.coalesce(levels[level].cast("string"), F.lit("")).alias(level) for level in LEVELS],
        )
        packed = packed.join(leaves, LEVELS).withColumn("key", self.key())
        inside = (F.col("whole") > 0) | F.coalesce(F.col("key") <= F.col("last_key"), F.lit(False))
        return packed.where(inside).select(
            *[F.col(f"row.`{name}`").alias(name) for name in names]
        )


def document_levels() -> dict[str, Column]:
    """The tree over ``documents``: which domain a source is of, language, source."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    domain = F.when(source == "src0", "crawl").when(source.rlike("^src[1-9]$"), "reference")
    return {
        "domain": domain.otherwise("community"),
        "lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "source": source,
    }


WEIGHTS = {
    "domain": {"crawl": 2, "reference": 5, "community": 3},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document a mixture of three quarters of all tokens takes, where small
    sources may be read up to three times."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    levels = document_levels()
    named = docs.select("doc_id", "text", *[levels[level].alias(level) for level in LEVELS])
    return Mixture(0.75, WEIGHTS, epochs=3, seed=17).mixed(named, Staging(spark))
