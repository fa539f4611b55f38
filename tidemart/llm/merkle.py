"""Merkle manifest of a dataset whose nodes are labelled by the leaf ranks they cover."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.dense_index import dense_index
from tidemart.sources.staging import Staging

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "struct<before: string, after: string>"


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of UTF-8 text."""
    return F.sha2(text, 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def small_letters(text: Column) -> Column:
    """The text with A-Z as a-z and nothing else changed."""
    return F.translate(text.cast("string"), _CAPITALS, _SMALL)


def _joined(members: str, value: str = "m.digest") -> Column:
    return F.expr(f"array_join(transform({members}, m -> {value}), '')")


@dataclass(frozen=True)
class Forest:
    """Trees over numbered leaves. ``levels[k - 1]`` holds the nodes of level ``k``: ``tree``,
    its number of leaves ``n``, the leaf ranks ``lo`` to ``hi`` that a node covers, ``digest``,
    and ``members``, the nodes or leaves below it in order, with their own ranks."""

    fan: int
    leaves: DataFrame
    levels: tuple[DataFrame, ...]

    def roots(self) -> DataFrame:
        """``tree`` and ``digest`` of every tree's root; a lone leaf is its tree's root."""
        found = self.leaves.where("n = 1").select("tree", "digest")
        for level, nodes in enumerate(self.levels, 1):
            found = found.unionByName(self._tops(level, nodes).select("tree", "digest"))
        return found

    def _tops(self, level: int, nodes: DataFrame) -> DataFrame:
        return nodes.where(f"n <= {self.fan**level}L")

    def nodes(self) -> DataFrame:
        """``tree``, ``level``, ``lo``, ``hi`` and ``digest`` of all nodes and leaves."""
        found = self.leaves.selectExpr("tree", "0 AS level", "lo", "lo AS hi", "digest")
        for level, nodes in enumerate(self.levels, 1):
            found = found.unionByName(nodes.selectExpr("tree", f"{level} AS level", "lo", "hi", "digest"))
        return found

    def paths(self, above: DataFrame, *carried: str) -> DataFrame:
        """The leaves with ``path``: at each level up to the root, and on from there as ``above``
        (``tree``, ``path``, ``carried``) says, the digests of the siblings before and after.

        Level by level from the top, each node is joined with the one node of the level above
        that contains its interval. Both sides are bucketed by the ranks which a node of that
        level covers, so a bucket holds one parent and ``fan`` children at most. The parent's
        interval without the child's own, left and right of it, holds the siblings.
        """
        columns = ["tree", "lo", "hi", "members", "path", *carried]
        parents = None
        for level in range(len(self.levels), 0, -1):
            nodes = self.levels[level - 1]
            known = self._tops(level, nodes).join(above, "tree").select(*columns)
            if parents is not None:
                span = self.fan ** (level + 1)
                child = nodes.withColumn("bucket", F.expr(f"lo div {span}L")).alias("c")
                parent = parents.withColumn("bucket", F.expr(f"lo div {span}L")).alias("p")
                inside = F.expr(
                    "c.tree = p.tree AND c.bucket = p.bucket AND c.lo >= p.lo AND c.hi <= p.hi"
                )
                found = child.join(parent, inside).select(
                    "c.tree", "c.lo", "c.hi", "c.members",
                    self._grown("p.members", "c.lo", "c.hi", "p.path").alias("path"),
                    *[f"p.{name}" for name in carried],
                )
                known = known.unionByName(found)
            parents = known
        lone = self.leaves.where("n = 1").join(above, "tree")
        leaf = [name for name in self.leaves.columns if name not in ("n", "tree", "lo", "digest")]
        lone = lone.select("digest", *leaf, "path", *carried)
        if parents is None:
            return lone
        # A leaf's parent holds it already: no join, and the leaves are not moved again.
        each = parents.select("members", "path", *carried, F.explode("members").alias("own"))
        grown = self._grown("members", "own.lo", "own.hi", "path").alias("path")
        return lone.unionByName(
            each.select("own.digest", *[f"own.{name}" for name in leaf], grown, *carried)
        )

    @staticmethod
    def _grown(members: str, lo: str, hi: str, path: str) -> Column:
        """``path`` with the step from ``[lo, hi]`` to the node that has ``members`` in front."""
        before = f"array_join(transform(filter({members}, m -> m.hi < {lo}), m -> m.digest), '')"
        after = f"array_join(transform(filter({members}, m -> m.lo > {hi}), m -> m.digest), '')"
        return F.expr(f"concat(array(named_struct('before', {before}, 'after', {after})), {path})")


def grow(leaves: DataFrame, staging: Staging, name: str, fan: int = FAN) -> Forest:
    """Trees over ``leaves``: ``tree``, ``lo`` (rank in the tree from 0), ``n`` (leaves of the
    tree), ``digest`` and further columns. While a tree has several nodes, every ``fan``
    consecutive ones (the last run: fewer, even one) get a parent.

    A run is the only group that is ever gathered. Each level is a written table.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    below, levels, width = leaves.withColumn("hi", F.col("lo")), [], 1
    while width < largest:
        extra = [c for c in below.columns if c not in ("tree", "n", "lo", "hi", "digest")]
        member = F.struct("lo", "hi", "digest", *extra)
        runs = (
            below.where(f"n > {width}L")
            .groupBy("tree", "n", F.expr(f"lo div {width * fan}L").alias("run"))
            .agg(F.sort_array(F.collect_list(member)).alias("members"))
        )
        nodes = runs.select(
            "tree",
            "n",
            F.expr("members[0].lo AS lo"),
            F.expr("element_at(members, -1).hi AS hi"),
            digest(_joined("members")).alias("digest"),
            "members",
        )
        levels.append(staging.settle(nodes, f"{name}_{len(levels) + 1}"))
        below, width = levels[-1].drop("members"), width * fan
    return Forest(fan, leaves, tuple(levels))


class Manifest:
    """A tree of digests per ``group`` over its rows by ``order``, and one over the groups' roots.

    1. A row becomes a leaf where it lies: the digest of its encoded fields. Texts are read once
       and never shuffled.
    2. Leaves are ranked by group and order without a one-task sort (:func:`dense_index`), so a
       group with a third of all rows is spread over many ranges.
    3. ``grow`` builds the levels; a node is labelled with the ranks it covers, and so is a
       group in the tree above the groups.

    Nulls are encoded as such. Rows with a null group form a group of their own, the first; null
    orders come first in a group. Rows of the same order follow each other by digest, so equal
    rows are interchangeable. No row gives no leaf and no root. Columns of other names are not read.
    """

    def __init__(
        self,
        docs: DataFrame,
        staging: Staging,
        fields: tuple[str, ...] = FIELDS,
        group: str = "source",
        order: str = "doc_id",
        tampered: dict[str, Column] | None = None,
        fan: int = FAN,
    ):
        """``tampered`` replaces fields in a second leaf, ``changed``; null where nothing does."""
        plain = {name: docs[f"`{name}`"] for name in fields}
        changed = F.lit(None).cast("string")
        if tampered:
            touched = F.lit(False)
            for name, value in tampered.items():
                touched = touched | value.isNotNull()
            other = {n: F.coalesce(tampered[n], c) if n in tampered else c for n, c in plain.items()}
            changed = F.when(touched, self._leaf(other.values()))
        rows = docs.select(
            docs[f"`{group}`"].cast("string").alias("grp"),
            docs[f"`{order}`"].cast("bigint").alias("ord"),
            self._leaf(plain.values()).alias("digest"),
            changed.alias("changed"),
        )
        ranked = dense_index(rows, ["grp", "ord", "digest"], "place", staging)
        sizes = ranked.groupBy("grp").agg(F.count("*").alias("n"), F.min("place").alias("first"))
        sizes = staging.settle(dense_index(sizes, ["grp"], "tree", staging), "groups")
        numbered = ranked.join(sizes.withColumnRenamed("grp", "own"), F.expr("grp <=> own"))
        leaves = numbered.selectExpr("tree", "n", "place - first AS lo", "digest", "ord", "changed")
        self.groups = sizes.select("grp", "tree", "n")
        self.rows = grow(leaves, staging, "rows", fan)
        self.subroots = staging.settle(self.rows.roots(), "subroots")
        over = self.subroots.selectExpr(
            "0L AS tree", "tree - 1 AS lo", f"{sizes.count()}L AS n", "digest", "tree AS ord"
        )
        self.top = grow(over, staging, "top", fan)

    @staticmethod
    def _leaf(values) -> Column:
        return digest(F.concat(*[encoded(value) for value in values]))

    def root(self) -> str | None:
        """The digest of the whole dataset; None if it has no row."""
        found = self.top.roots().first()
        return found and found.digest

    def nodes(self) -> DataFrame:
        """The manifest: ``grp``, ``level``, ``lo``, ``hi`` and ``digest`` of every node."""
        return self.rows.nodes().join(self.groups.select("grp", "tree"), "tree").drop("tree")

    def proofs(self) -> DataFrame:
        """``ord``, ``digest``, ``changed``, ``subroot``, ``root`` and ``path`` of every leaf: what
        one needs besides a row to compute the root again (see :func:`folded`)."""
        start = self.top.roots().selectExpr(
            "tree", "digest AS root", f"CAST(array() AS array<{_STEP}>) AS path"
        )
        groups = self.top.paths(start, "root").selectExpr("ord AS tree", "digest AS subroot", "root", "path")
        return self.rows.paths(groups, "subroot", "root")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings level by level."""
    return F.aggregate(
        path, leaf, lambda below, step: digest(F.concat(step["before"], below, step["after"]))
    )


def proof_text(path: Column) -> Column:
    """The siblings' digests level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, proofs and checks of all documents, a fifth of which is tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    every_fifth = F.crc32(docs["doc_id"].cast("string")) % 5 == 0
    tampered = {"text": F.when(every_fifth, small_letters(docs["text"]))}
    proofs = Manifest(docs, Staging(spark), tampered=tampered).proofs()
    proofs = proofs.withColumn(
        "folded_root", folded(F.coalesce("changed", "digest"), F.col("path"))
    )
    return proofs.select(
        F.col("ord").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        digest(proof_text(F.col("path"))).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
