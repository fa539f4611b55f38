"""Quality rules from tokenizer fertility, with rejection bands per language or script."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import resident
from tidemart.llm.quantiles import exact_quantiles
from tidemart.llm.rows import slices, text_bytes, words
from tidemart.llm.shingles import Powers, mix, word_hashes
from tidemart.sources.staging import Staging

SLICE_BYTES = 1 << 20
SPACE = " \t\n\x0b\x0c\r"
WINDOW = 8

#: Fixed: the characters that count as symbols.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

#: Fixed: first code points of large blocks of scripts, in order.
SCRIPTS = [
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0900, "Indic"), (0x0E00, "Southeast Asian"),
    (0x1100, "Korean"), (0x1200, "Other"), (0x1E00, "Latin"), (0x2000, "Other"),
    (0x3040, "Japanese"), (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Korean"),
    (0xD800, "Other"), (0x20000, "Han"), (0x30000, "Other"),
]
_SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
_SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_OF = np.array([_SCRIPT_NAMES.index(name) for _, name in SCRIPTS])

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
METRICS = ["chars_per_token", "fallback_share", "entropy"]
SCHEMA = ", ".join(
    ["doc_id bigint", "lang string", "script string", "n_tokens bigint"]
    + [f"{name} bigint" for name in COUNTS]
    + [f"{name} double" for name in METRICS]
)


def repeated_words(hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Words inside 8-word windows that their text has twice or more, the first included."""
    if len(hashes) < WINDOW:
        return np.zeros(texts, np.int64)
    last = len(hashes) - WINDOW + 1
    whole = np.flatnonzero(owner[:last] == owner[WINDOW - 1 :])
    windows = mix(owner[whole].astype(np.uint64))
    for j in range(WINDOW):
        windows = mix(windows + hashes[whole + j])
    order = np.argsort(windows)
    same = windows[order[1:]] == windows[order[:-1]]
    again = np.zeros(len(whole), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    edges[whole[again]] += 1
    edges[whole[again] + WINDOW] -= 1
    return np.bincount(owner[np.cumsum(edges[:-1]) > 0], minlength=texts)


def duplicate_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


class WordTokens:
    """What a public vocabulary makes of each distinct word: its ids and byte fallbacks."""

    def __init__(self, path: str, limit: int = 400_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.runs: list[list[int]] = []

    def ids(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        new = set(found).difference(self.numbers)
        if len(self.numbers) + len(new) > self.limit and self.numbers:
            self._clear()
            new = set(found)
        if new:
            new = list(new)
            self.numbers.update(zip(new, range(len(self.runs), len(self.runs) + len(new))))
            self.runs.extend(self.model.encode(new, num_threads=1))
        runs = list(map(self.runs.__getitem__, map(self.numbers.__getitem__, found)))
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        ids = [i for run in runs for i in run]
        return np.array(ids, np.int64), sizes


def _tokens(path: str) -> WordTokens:
    return resident.keep(("fertility", path), lambda: WordTokens(path))


def _scripts(texts: int, owner: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The commonest script of each text's letters; "None" without letters."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    kinds = _SCRIPT_OF[np.searchsorted(_SCRIPT_STARTS, points, side="right") - 1]
    names = len(_SCRIPT_NAMES)
    letters = (points >= 0x41) & ((points >= 0x80) | ((points | 0x20) - 0x61 < 26))
    counts = np.bincount(owner[letters] * names + kinds[letters], minlength=texts * names)
    counts = counts.reshape(texts, names)
    best = np.array([*_SCRIPT_NAMES, "None"])
    return best[np.where(counts.any(axis=1), counts.argmax(axis=1), names)]


def measure(part: pa.RecordBatch, tokens: WordTokens, powers: Powers) -> list[pa.Array]:
    """All counts and metrics of a slice of documents, in the order of the schema."""
    column = part.column("text")
    data, offsets = text_bytes(column)
    texts = len(column)
    begins, ends, owner = words(data, offsets)
    n_words = np.bincount(owner, minlength=texts)
    # Code points begin at bytes that continue no other; those of white space are not in words.
    lead = (data & 0xC0) != 0x80
    of_byte = np.repeat(np.arange(texts), np.diff(offsets))
    points = np.bincount(of_byte[lead], minlength=texts)
    blank = np.isin(data, np.frombuffer(SPACE.encode(), np.uint8))
    word_chars = points - np.bincount(of_byte[blank], minlength=texts)
    symbols = np.bincount(of_byte[_SYMBOL[data]], minlength=texts)
    strings = [text or "" for text in column.to_pylist()]
    lines = np.fromiter(map(duplicate_lines, strings), np.int64, texts)
    repeats = repeated_words(word_hashes(data, begins, ends, powers, fold=False), owner, texts)
    raw = data.tobytes()
    found = [raw[b:e].decode() for b, e in zip(begins.tolist(), ends.tolist())]
    ids, sizes = tokens.ids(found)
    doc = np.repeat(owner, sizes)
    n_tokens = np.bincount(doc, minlength=texts)
    fallback = np.bincount(doc[tokens.is_byte[ids]], minlength=texts)
    kinds, times = np.unique(doc << 20 | ids, return_counts=True)
    share = times / n_tokens[kinds >> 20]
    entropy = np.bincount(kinds >> 20, weights=-share * np.log2(share), minlength=texts)
    some = np.maximum(n_tokens, 1)
    columns = [n_words, word_chars, symbols, lines, repeats]
    metrics = [word_chars / some, fallback / some, entropy]
    script = _scripts(texts, of_byte[lead], data)
    return [
        pa.array(script),
        pa.array(n_tokens),
        *[pa.array(x.astype(np.int64)) for x in columns],
        *[pa.array(x.astype(np.float64)) for x in metrics],
    ]


def _run(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, tokens = Powers(), _tokens(path)
        names = ["doc_id", "lang", "script", "n_tokens", *COUNTS, *METRICS]
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                columns = [part.column("doc_id"), part.column("lang")]
                yield pa.RecordBatch.from_arrays(columns + measure(part, tokens, powers), names=names)

    return run


def fertility(docs: DataFrame, path: str) -> DataFrame:
    """Counts and fertility of every row. A null text has no words; all its numbers are 0."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        lang.alias("lang"),
    )
    return texts.mapInArrow(_run(path), SCHEMA)


#: How many spreads a metric may lie below its median and above it, and the least spread in its
#: own unit. Chosen on labelled texts of sf0.1 outside the held-out fifth, so that about a
#: hundredth of the good ones goes. Few symbols or fragments lie above the median, and long texts
#: use more of a vocabulary: a high entropy is no fault.
WIDTHS = {
    "chars_per_token": (4.0, 8.0), "fallback_share": (3.0, 3.0), "entropy": (2.0, float("inf")),
}
FLOORS = {"chars_per_token": 0.05, "fallback_share": 0.01, "entropy": 0.15}
#: Characters per token of long texts vary less than those of all texts; the others do not.
LEAST = {"chars_per_token": 0.1, "fallback_share": 1.0, "entropy": 1.0}


def judged(
    docs: DataFrame, staging: Staging, path: str, widths: dict[str, tuple[float, float]] = WIDTHS
) -> DataFrame:
    """Every row with ``base_failed`` and ``kept``.

    The base rule fails texts of fewer than 20 words, or with more than 30 % of their words in
    repeated windows. Beyond it, a band per language (per script where the language is null)
    rejects texts whose characters per token, byte-fallback share or token entropy lie more than
    their ``widths`` in spreads from the median of all texts of the group that pass the base rule. A
    spread is the distance of the quartiles with a floor, and wider for texts of few tokens;
    each side of the median has its own width.
    Null and empty texts fail; repeated rows are judged alike; no row gives no row.
    """
    rows = staging.settle(fertility(docs, path), "fertility")
    failed = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
    rows = rows.withColumn("base_failed", F.expr(failed))
    rows = rows.withColumn("band", F.coalesce("lang", "script"))
    # Written, so that Spark knows its size: a few languages are broadcast, many are not.
    passed = rows.where("NOT base_failed")
    bands = staging.settle(exact_quantiles(passed, "band", METRICS, [0.25, 0.5, 0.75], staging), "bands")
    rows = rows.join(bands, "band", "left")
    inside = F.lit(True)
    for name in METRICS:
        q = f"q_{name}"
        spread = F.expr(
            f"greatest({q}[2] - {q}[0], {FLOORS[name]}D)"
            f" * sqrt({LEAST[name]}D + 100D / greatest(n_tokens, 1))"
        )
        off = F.col(name) - F.col(q)[1]
        below, above = widths[name]
        inside = inside & (-off <= below * spread)
        if above < float("inf"):
            inside = inside & (off <= above * spread)
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def op8_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = judged(docs, Staging(spark), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", *COUNTS, "base_failed", "kept", "n_tokens", *METRICS)
