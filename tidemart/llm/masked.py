"""Masked pseudo-likelihood: a small window network, trained in numpy on all documents, predicts
every token from those on both sides of it."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import resident
from tidemart.llm.rows import slices, text_bytes, words
from tidemart.llm.shingles import Powers, word_hashes
from tidemart.sources.staging import Staging

SLICE_BYTES = 1 << 20
HELD = 1 << 20  # words that a task holds before it puts out their counts
COMMON = 1 << 18  # words whose counts every task has; others are joined


@dataclass(frozen=True)
class Shape:
    """Sizes of the network. Words are hashed to ``classes * members`` tokens; a token is
    predicted by its class and then by its place in the class."""

    classes: int = 32
    members: int = 64
    window: int = 3
    width: int = 8
    hidden: int = 24
    batch: int = 8192
    rate: float = 0.05

    @property
    def tokens(self) -> int:
        return self.classes * self.members

    def parts(self) -> dict[str, tuple[int, ...]]:
        """Names and shapes of the parameters, in the order in which they are stored."""
        return {
            "embed": (self.tokens + 1, self.width),  # the last is for places outside the text
            "inner": (2 * self.window * self.width, self.hidden),
            "inner_bias": (self.hidden,),
            "to_class": (self.hidden, self.classes),
            "class_bias": (self.classes,),
            "to_member": (self.classes, self.hidden, self.members),
            "member_bias": (self.classes, self.members),
        }

    def split(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts().items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def start(self, counts: np.ndarray, seed: int = 3) -> np.ndarray:
        """Small random weights, and biases that give every token its share of the corpus."""
        random = np.random.default_rng(seed)
        flat = np.concatenate(
            [random.normal(0, 0.1, int(np.prod(shape))) for shape in self.parts().values()]
        ).astype(np.float32)
        parts = self.split(flat)
        parts["embed"][-1] = 0
        parts["inner_bias"][:] = 0
        table = counts.reshape(self.classes, self.members) + 0.5
        parts["class_bias"][:] = np.log(table.sum(axis=1) / table.sum())
        parts["member_bias"][:] = np.log(table / table.sum(axis=1, keepdims=True))
        return flat


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


class Network:
    """The network with its parameters; ``step`` also learns, by Adagrad."""

    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat = shape, flat.astype(np.float32).copy()
        self.parts = shape.split(self.flat)
        self.past = np.full(len(flat), 1e-2, np.float32)

    def around(self, tokens: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The tokens on both sides of each, the outside of its text as one of its own."""
        n, w, none = len(tokens), self.shape.window, self.shape.tokens
        out = np.full((n, 2 * w), none, np.int32)
        for distance in range(1, w + 1):
            if n > distance:
                same = owner[distance:] == owner[:-distance]
                out[distance:, w - distance][same] = tokens[:-distance][same]
                out[:-distance, w + distance - 1][same] = tokens[distance:][same]
        return out

    def step(self, context: np.ndarray, tokens: np.ndarray, learn: bool) -> np.ndarray:
        """Log-probability of every token given its context."""
        shape, parts, n = self.shape, self.parts, len(tokens)
        order = np.argsort((tokens // shape.members).astype(np.uint16), kind="stable")
        context, sorted_tokens = context[order], tokens[order]
        kinds, places = sorted_tokens // shape.members, sorted_tokens % shape.members
        x = parts["embed"][context].reshape(n, -1)
        hidden = np.tanh(x @ parts["inner"] + parts["inner_bias"])
        by_class = _softmax(hidden @ parts["to_class"] + parts["class_bias"])
        every = np.arange(n)
        log_p = np.log(by_class[every, kinds] + 1e-20)
        if learn:
            slopes = {name: np.zeros_like(part) for name, part in parts.items() if name != "embed"}
            by_class[every, kinds] -= 1
            slopes["to_class"] = hidden.T @ by_class
            slopes["class_bias"] = by_class.sum(axis=0)
            back = by_class @ parts["to_class"].T
        edges = np.searchsorted(kinds, np.arange(shape.classes + 1)).tolist()
        for kind in range(shape.classes):
            a, b = edges[kind], edges[kind + 1]
            if a == b:
                continue
            member = _softmax(hidden[a:b] @ parts["to_member"][kind] + parts["member_bias"][kind])
            at = every[: b - a]
            log_p[a:b] += np.log(member[at, places[a:b]] + 1e-20)
            if learn:
                member[at, places[a:b]] -= 1
                slopes["to_member"][kind] = hidden[a:b].T @ member
                slopes["member_bias"][kind] = member.sum(axis=0)
                back[a:b] += member @ parts["to_member"][kind].T
        if learn:
            back *= 1 - hidden**2
            slopes["inner"] = x.T @ back
            slopes["inner_bias"] = back.sum(axis=0)
            inputs = (back @ parts["inner"].T).reshape(-1, shape.width)
            flat = context.reshape(-1)
            embed = np.empty_like(parts["embed"])
            for column in range(shape.width):
                embed[:, column] = np.bincount(
                    flat, weights=inputs[:, column], minlength=shape.tokens + 1
                )
            slopes["embed"] = embed
            slope = np.concatenate([slopes[name].reshape(-1) for name in parts]) / n
            self.past += slope * slope
            self.flat -= shape.rate * slope / np.sqrt(self.past)
        out = np.empty(n)
        out[order] = log_p
        return out


def _hashes(part: pa.RecordBatch, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of a slice of texts, and the text of each."""
    resident.let_go()
    data, offsets = text_bytes(part.column("text"))
    begins, ends, owner = words(data, offsets)
    hashes = word_hashes(data, begins, ends, powers) if len(begins) else np.empty(0, np.uint64)
    return hashes, owner


def _token(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    return (hashes % np.uint64(shape.tokens)).astype(np.int32)


def _tokens(part: pa.RecordBatch, shape: Shape, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    hashes, owner = _hashes(part, powers)
    return _token(hashes, shape), owner


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words with their counts, put out whenever many are held."""
    powers, held, size = Powers(), [], 0

    def out() -> pa.RecordBatch:
        values, at = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["word", "n"])

    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            found = np.unique(_hashes(part, powers)[0], return_counts=True)
            if len(found[0]):
                held.append(found)
                size += len(found[0])
            if size > HELD:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _count(shape: Shape) -> Callable:
    """Counts of tokens from those of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(shape.tokens, np.int64)
        for batch in batches:
            found = _token(batch.column("word").to_numpy().view(np.uint64), shape)
            np.add.at(counts, found, batch.column("n").to_numpy())
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["at", "n"])

    return run


def _train(shape: Shape, flat: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, network, seen = Powers(), Network(shape, flat), 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                tokens, owner = _tokens(part, shape, powers)
                context = network.around(tokens, owner)
                # Mini-batches of tokens from all over the slice, in an order of its own.
                mixed = np.random.default_rng(seen).permutation(len(tokens))
                for start in range(0, len(tokens), shape.batch):
                    some = mixed[start : start + shape.batch]
                    network.step(context[some], tokens[some], learn=True)
                seen += len(tokens)
        if seen:
            weight = np.full(len(flat), float(seen))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(network.flat * weight), pa.array(weight)],
                names=["at", "value", "weight"],
            )

    return run


def _score(shape: Shape, flat: np.ndarray, table: Words) -> Callable:
    """A row for each text (``real`` is false): its tokens and what is known of its
    log-likelihood. And one for each of its words that is not among the common ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, network = Powers(), Network(shape, flat)
        whole = np.log(table.tokens + 1.0)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                hashes, owner = _hashes(part, powers)
                tokens = _token(hashes, shape)
                context, log_p = network.around(tokens, owner), np.empty(len(tokens))
                for start in range(0, len(tokens), shape.batch):
                    some = slice(start, start + shape.batch)
                    log_p[some] = network.step(context[some], tokens[some], learn=False)
                log_p -= whole[tokens]
                place = np.minimum(np.searchsorted(table.common, hashes), len(table.common) - 1)
                known = table.common[place] == hashes
                log_p[known] += table.logs[place[known]]
                texts = part.num_rows
                sizes = np.bincount(owner, minlength=texts).astype(np.int64)
                sums = np.bincount(owner, weights=log_p, minlength=texts).astype(float)
                # Distinct words of each text: texts come in order, words are sorted inside them.
                rare, of = hashes[~known], owner[~known]
                order = np.lexsort((rare, of))
                rare, of = rare[order], of[order]
                new = np.ones(len(rare), bool)
                new[1:] = (rare[1:] != rare[:-1]) | (of[1:] != of[:-1])
                at = np.flatnonzero(new)
                n = np.diff(np.append(at, len(rare)))
                rows = part.select(["at", "doc_id"])
                keys = pa.concat_arrays([rows.column("at"), pa.array(rare[at].view(np.int64))])
                both = rows.take(pa.array(np.concatenate([np.arange(texts), of[at]])))
                zeros = np.zeros(len(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        *both.columns,
                        keys.cast(pa.int64()),
                        pa.array(np.arange(texts + len(at)) >= texts),
                        pa.array(np.concatenate([sizes, n])),
                        pa.array(np.concatenate([sums, zeros])),
                    ],
                    names=["at", "doc_id", "word", "real", "n", "value"],
                )

    return run


@dataclass(frozen=True)
class Words:
    """How often each word is in the corpus. ``tokens`` has the counts of all tokens; ``common``
    and ``logs`` are hashes of the commonest words, sorted, and the logarithms of their counts;
    ``table`` has all words, and stays on the cluster."""

    table: DataFrame
    tokens: np.ndarray
    common: np.ndarray
    logs: np.ndarray


def sized(distinct: int) -> Shape:
    """A network for so many distinct words: its tokens grow with their square root."""
    classes = 32
    while 2 * (2 * classes) ** 2 <= 3.2 * distinct**0.5:
        classes *= 2
    return Shape(classes=classes, members=2 * classes)


class MaskedModel:
    """Trained on every document once.

    The words of all documents are counted in a table that grows with them and stays on the
    cluster; the network predicts tokens, into which words are hashed (``shape``; by default
    sized by the number of distinct words). A word's probability is that of its token times
    its exact share of the token's count, to which one is added for all words that are not in
    the table. Words are told apart by a hash of 64 bits.

    Documents are dealt into ``rounds`` parts by a hash of their text. In a round, each
    partition trains a copy of the network on its documents of that part; the copies are
    averaged by their numbers of tokens, in one shuffle whose rows grow with the partitions.
    The average and the ``COMMON`` commonest words come to the driver.
    """

    def __init__(self, shape: Shape | None = None, rounds: int = 3, staging: Staging | None = None):
        self.shape, self.rounds, self.staging = shape, rounds, staging
        self.words: Words | None = None

    def count(self, texts: DataFrame) -> Words:
        area = Staging(texts.sparkSession, self.staging and self.staging.path)
        table = texts.mapInArrow(_words, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        table = area.settle(table, "words")
        if self.shape is None:
            self.shape = sized(table.count())
        counts = np.zeros(self.shape.tokens)
        found = table.mapInArrow(_count(self.shape), "at bigint, n bigint")
        for row in found.groupBy("at").agg(F.sum("n").alias("n")).collect():
            counts[row.at] = row.n
        # A word that is there once adds the logarithm of 1.
        table = table.where("n > 1")
        common = table.orderBy(F.desc("n"), "word").limit(COMMON).toArrow()
        hashes = common.column("word").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        logs = np.log(common.column("n").to_numpy()[order].astype(float))
        if not len(hashes):
            return Words(table, counts, np.zeros(1, np.uint64), np.zeros(1))
        return Words(table, counts, hashes[order], logs)

    def train(self, docs: DataFrame) -> np.ndarray:
        texts = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
        self.words = self.count(texts)
        flat = self.shape.start(self.words.tokens)
        for number in range(self.rounds):
            part = texts.where(F.pmod(F.xxhash64("text"), F.lit(self.rounds)) == number)
            copies = part.mapInArrow(_train(self.shape, flat), "at bigint, value double, weight double")
            mean = (F.sum("value") / F.sum("weight")).alias("mean")
            new = flat.copy()
            for row in copies.groupBy("at").agg(mean).collect():
                new[row.at] = row.mean
            flat = new
        return flat

    def score(self, docs: DataFrame, flat: np.ndarray) -> DataFrame:
        """``doc_id``, ``n_tokens``, ``log_likelihood`` (the sum over all words) and
        ``per_token`` of every row. Null and empty texts have no words, a sum of 0 and a null
        mean; equal texts get equal scores; rows keep their order; no row gives no row. ``train``
        comes first."""
        texts = docs.select(
            F.monotonically_increasing_id().alias("at"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
        )
        schema = "at bigint, doc_id bigint, word bigint, real boolean, n bigint, value double"
        run = _score(self.shape, flat, dataclasses.replace(self.words, table=None))
        rows = texts.mapInArrow(run, schema)
        # Rows of texts have keys of their own, which meet no word.
        table = self.words.table.select("word", F.lit(True).alias("real"), F.log("n").alias("log_n"))
        rows = rows.join(table, ["word", "real"], "left")
        found = F.when(F.col("real"), F.col("n") * F.coalesce("log_n", F.lit(0.0))).otherwise(F.col("value"))
        sums = rows.groupBy("at").agg(
            F.max("doc_id").alias("doc_id"),
            F.sum(F.when(F.col("real"), 0).otherwise(F.col("n"))).alias("n_tokens"),
            F.sum(found).alias("log_likelihood"),
        )
        mean = F.col("log_likelihood") / F.nullif(F.col("n_tokens"), F.lit(0))
        return sums.orderBy("at").select("doc_id", "n_tokens", "log_likelihood").withColumn("per_token", mean)


def op10_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihoods of all documents under a model trained on all of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = MaskedModel()
    return model.score(docs, model.train(docs))
