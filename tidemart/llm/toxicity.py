"""Toxicity by a weighted finite-state grammar over marked words.

A lexicon turns each word into a mark; the composed transducers of :mod:`tidemart.llm.grammar`
read the marks of a clause. Texts are scored by what the best paths through their clauses put out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import logistic, resident
from tidemart.llm.grammar import (
    DENIED,
    INSULT,
    MENACE,
    MODAL,
    NEGATION,
    OBJECT,
    OTHER,
    PLAIN,
    QUOTED,
    REPORT,
    TARGET,
    TARGETED,
    THREAT,
    best_path,
)
from tidemart.llm.rows import labelled_sample
from tidemart.sources.staging import Staging

END = 8  # added to the mark of a word that ends its clause

# Function words and verbs of the grammar.
TARGETS = "your yours they he she du ihr tu vos tú usted ustedes vosotros"
OBJECTS = "you u them him dich dir euch te toi vous ti"
MODALS = "will shall should must gonna going would werde werden muss sollte vais va allons voy vamos debo"
NEGATIONS = "not no never isn't aren't don't wasn't nicht kein keine nie pas jamais nunca jamás ni"
REPORTS = "said says say wrote told called quoted reported allegedly sagte sagt schrieb nannte angeblich dit disait écrit dijo dice escribió llamó"
THREATS = "kill killing destroy hurt beat shoot stab burn töten umbringen schlagen vernichten tuer frapper brûler détruire matar golpear quemar destruir"
INSULTS = "idiot moron loser scum trash stupid pathetic worthless disgusting"

_MARKS = {
    word: mark
    for text, mark in (
        (TARGETS, TARGET), (OBJECTS, OBJECT), (MODALS, MODAL),
        (NEGATIONS, NEGATION), (REPORTS, REPORT), (THREATS, THREAT),
    )
    for word in text.split()
}
_EDGES = ".,;:!?…()[]{}\"'«»“”„‘’*#$%&|<>-_"
_CLOSES = re.compile(r"[.!?;:…][\"'»”’)\]]*$")
PREFIXES = (3, 4, 5, 6, 7)

#: Outputs of the grammar that a text's score is made of.
FEATURES = ["plain", "targeted", "negated", "reported", "threat", "strongest", "dense"]


#: What a kind of match is called among the outputs.
_CALLED = {PLAIN: "plain", TARGETED: "targeted", DENIED: "negated", QUOTED: "reported", MENACE: "threat"}


def strip(word: str) -> str:
    return word.strip(_EDGES)


class Lexicon(dict):
    """Mark of each word as it stands in a lower-cased text, worked out when first met; those
    of at most ``limit`` words are held. Weights are of whole words (``=word``) or beginnings."""

    def __init__(self, weights: dict[str, float], limit: int = 500_000):
        super().__init__()
        self.weights, self.limit = weights, limit

    def weight(self, word: str) -> float:
        found = self.weights.get("=" + word)
        if found is None:
            found = max((self.weights.get(word[:n], 0.0) for n in PREFIXES if len(word) > n), default=0.0)
        return found

    def __missing__(self, raw: str) -> int:
        if len(self) > self.limit:
            self.clear()
        word = strip(raw)
        mark = _MARKS.get(word, OTHER)
        if mark == OTHER and self.weight(word) > 0:
            mark = INSULT
        if _CLOSES.search(raw):
            mark += END
        self[raw] = mark
        return mark


def features(text: str, lexicon: Lexicon) -> list[float]:
    """What the grammar makes of a text, in the order of ``FEATURES``."""
    found = text.lower().split()
    marks = np.fromiter(map(lexicon.__getitem__, found), np.int8, len(found))
    kinds = marks & 7
    hits = np.flatnonzero((kinds == INSULT) | (kinds == THREAT))
    sums, strongest, matches = Counter(), 0.0, 0
    if len(hits):
        stops = np.flatnonzero(marks >= END)
        clauses = dict.fromkeys(np.searchsorted(stops, hits).tolist())
        for clause in clauses:
            start = int(stops[clause - 1]) + 1 if clause else 0
            stop = int(stops[clause]) + 1 if clause < len(stops) else len(found)
            weights = [lexicon.weight(strip(word)) or 1.0 for word in found[start:stop]]
            score, path = best_path(kinds[start:stop].tolist(), weights)
            for kind, weight in path:
                sums[_CALLED[kind]] += weight
            matches += len(path)
            strongest = max(strongest, score)
    sizes = [np.log1p(sums[kind]) for kind in FEATURES[:5]]
    return [*sizes, np.log1p(strongest), np.log1p(1000 * matches / (len(found) + 100))]


def _terms(text: str) -> set[str]:
    words = {strip(word) for word in text.lower().split()}
    terms = {"=" + word for word in words if len(word) > 2}
    for n in PREFIXES:
        terms.update(word[:n] for word in words if len(word) > n)
    return terms


def _count_terms(batches: Iterator[pa.RecordBatch], limit: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Texts of each label that have a term, for every term of either label. Counts are put out
    whenever more than ``limit`` terms are held, so a term can come more than once."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            counts[label].update(_terms(text or ""))
            if len(counts[0]) + len(counts[1]) > limit:
                yield from _counted(*counts)
                counts = (Counter(), Counter())
    yield from _counted(*counts)


def _counted(clean: Counter, toxic: Counter) -> Iterator[pa.RecordBatch]:
    terms = list(clean.keys() | toxic.keys())
    for start in range(0, len(terms), 50_000):
        some = terms[start : start + 50_000]
        yield pa.RecordBatch.from_pydict(
            {"term": some, "toxic": [toxic[t] for t in some], "clean": [clean[t] for t in some]}
        )


class Grammar:
    """What is learned: the weights of terms, and those of the grammar's outputs."""

    def __init__(self, terms: dict[str, float], outputs: list[float], mean: list[float], bias: float):
        self.terms, self.outputs, self.mean, self.bias = terms, outputs, mean, bias

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-((rows - self.mean) @ np.array(self.outputs) + self.bias)))


#: For tables without labels of both kinds.
UNLEARNED = Grammar(
    {"=" + word: 3.0 for word in INSULTS.split()}, [1.5, 2.5, 0.2, 0.4, 2.5, 1.0, 0.5], [0.0] * 7, -2.5
)


def learn(
    docs: DataFrame, labels: DataFrame, staging: Staging, sample: int = 20_000, support: int = 6
) -> Grammar:
    """Learn from the texts of ``docs`` and the ``label`` (1: toxic) of their doc_id.

    At most ``sample`` labels are used: half of them for the lexicon, half for the outputs'
    weights. A term of the lexicon is in ``support`` toxic
    texts or more and e**2 times as common among them; the sample's texts bound their number.
    """
    rows = staging.settle(labelled_sample(docs, labels, sample), "sample")
    half = rows.where("pmod(at, 2) = 0").select("text", "label")
    sizes = {row.label: row["count"] for row in half.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return UNLEARNED
    terms = half.mapInArrow(_count_terms, "term string, toxic bigint, clean bigint")
    terms = terms.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    terms = terms.withColumn("weight", odds).where(f"toxic >= {support} AND weight >= 2")
    weights = {row.term: row.weight for row in terms.collect()}
    weights = dict(sorted(weights.items())) or dict(UNLEARNED.terms)
    other = rows.where("pmod(at, 2) = 1").select(F.lit(0).cast("bigint").alias("doc_id"), "label", "text")
    seen = other.mapInArrow(_apply(tuple(weights.items()), None), "label int, features array<double>")
    seen = seen.collect()
    labels = np.array([row.label for row in seen])
    if len(set(labels.tolist())) < 2:
        return Grammar(weights, UNLEARNED.outputs, UNLEARNED.mean, UNLEARNED.bias)
    x = np.array([row.features for row in seen])
    outputs, bias = logistic.fit(x - x.mean(axis=0), labels)
    return Grammar(weights, outputs.tolist(), x.mean(axis=0).tolist(), bias)


def _lexicon(terms: tuple[tuple[str, float], ...]) -> Lexicon:
    return resident.keep(("toxicity", terms), lambda: Lexicon(dict(terms)))


def _apply(terms: tuple[tuple[str, float], ...], grammar: Grammar | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(terms)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column("text").to_pylist()
                rows = [features(text or "", lexicon) for text in texts]
                if grammar is None:
                    columns = {"label": part.column("label"), "features": rows}
                else:
                    scores = grammar.scores(np.array(rows))
                    columns = {"doc_id": part.column("doc_id"), "score": scores}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``doc_id`` and ``score`` of every row, from its whole text alone. Null and empty texts
    have no clause and get the score of a text without a match; equal texts get equal scores;
    no row gives no row."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    run = _apply(tuple(grammar.terms.items()), grammar)
    return texts.mapInArrow(run, "doc_id bigint, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the labels outside the held-out fifth."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    known = labels.where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    grammar = learn(docs, known, Staging(spark))
    return score(docs, grammar).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
