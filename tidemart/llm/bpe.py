"""Byte-level BPE by recursive DuckDB queries inside Spark's partitions."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import resident
from tidemart.llm.pieces import PieceIds, literal
from tidemart.llm.rows import slices

SLICE_BYTES = 2 << 20
#: Words, and about as many pieces, that a worker holds; fewer cost time and change no result.
HELD = 400_000

#: Each round contracts, in every word that has one, the leftmost pair of least rank. A key is
#: the word's number and a token's place in it; words without a pair left are done.
CONTRACT = """
WITH RECURSIVE step(k, tok, more) AS (
  SELECT k, tok, true FROM seed
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT k, tok, lead(tok) OVER o AS next_tok, lead(k) OVER o AS next_k
     FROM step WHERE more WINDOW o AS (ORDER BY k)
   ), best AS (
     SELECT k >> 32 AS word, min(rank << 32 | (k & 4294967295)) AS pick,
       arg_min(next_k, rank << 32 | (k & 4294967295)) AS gone
     FROM pairs JOIN merges ON pair = (tok << 32 | next_tok)
     WHERE next_k >> 32 = k >> 32 GROUP BY 1
   )
   SELECT k, CASE WHEN (k & 4294967295) = (pick & 4294967295) THEN pick >> 32 ELSE tok END,
     pick IS NOT NULL
   FROM pairs LEFT JOIN best ON word = k >> 32 WHERE gone IS DISTINCT FROM k)
)
SELECT list(tok ORDER BY k) AS ids FROM step WHERE NOT more GROUP BY k >> 32 ORDER BY k >> 32
"""

#: Bytes are held as the characters with the same numbers.
EXPAND = """
SELECT doc, string_agg(chars, '' ORDER BY place) AS chars
FROM tokens LEFT JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """One vocabulary: a rank file's merges as a table of pairs, its tokens as another. The ids
    of up to ``limit`` words are held, four bytes each, for other pieces that have them; a tenth
    of them are contracted at once."""

    def __init__(self, path: str, pattern: str, limit: int = HELD):
        self.ranks = read_ranks(path)
        # White space as Unicode has it; the class \\s of this library has four characters more.
        pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pattern = regex.compile(pattern)
        self.letters = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.words: dict[bytes, bytes] = {}
        self.limit, self.at_once = limit, limit // 10
        self.duck = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        self.duck.register("tokens_in", self._vocabulary())
        self.duck.execute("CREATE TABLE vocabulary AS FROM tokens_in")
        self.duck.register("merges_in", self._merges())
        self.duck.execute("CREATE TABLE merges AS FROM merges_in")

    def _vocabulary(self) -> pa.Table:
        chars = [token.decode("latin-1") for token in self.ranks]
        return pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "chars": chars})

    def _merges(self) -> pa.Table:
        """Every pair of tokens that together are a token."""
        pairs, ranks = [], []
        for token, rank in self.ranks.items():
            for at in range(1, len(token)):
                left, right = self.ranks.get(token[:at]), self.ranks.get(token[at:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    ranks.append(rank)
        return pa.table({"pair": pa.array(pairs, pa.int64()), "rank": pa.array(ranks, pa.int64())})

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of non-empty words, four bytes each. One round for each merge of the word that needs the most."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        firsts = np.repeat(np.cumsum(lengths) - lengths, lengths)
        data = np.frombuffer(b"".join(words), np.uint8)
        keys = np.repeat(np.arange(len(words)), lengths) << 32 | np.arange(len(data)) - firsts
        self.duck.register("seed", pa.table({"k": keys, "tok": self.letters[data]}))
        found = self.duck.sql(CONTRACT).to_arrow_table().column("ids").combine_chunks()
        raw = found.values.to_numpy().astype(np.int32).tobytes()
        at = (4 * found.offsets.to_numpy()).tolist()
        return [raw[start:stop] for start, stop in zip(at, at[1:])]

    def encode_keys(self, keys: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Ids of pieces; words of the pattern are merged apart, whole tokens not at all."""
        found = [[word.encode() for word in self.pattern.findall(literal(key))] for key in keys]
        new = set(chain.from_iterable(found)).difference(self.words)
        if len(self.words) + len(new) > self.limit:
            self.words.clear()
            new = set(chain.from_iterable(found))
        rest = []
        for word in new:
            rank = self.ranks.get(word)
            if rank is None:
                rest.append(word)
            else:
                self.words[word] = rank.to_bytes(4, "little")
        for start in range(0, len(rest), self.at_once):
            some = rest[start : start + self.at_once]
            self.words.update(zip(some, self.contract(some)))
        runs = [b"".join(map(self.words.__getitem__, words)) for words in found]
        sizes = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        return keys, np.frombuffer(b"".join(runs), np.int32), sizes

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of every text, from the ids of all texts one after another."""
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = np.arange(len(ids), dtype=np.int64)
        self.duck.register("tokens", pa.table({"doc": doc, "place": place, "id": ids}))
        table = self.duck.sql(EXPAND).to_arrow_table()
        out = [b""] * len(sizes)
        for at, chars in zip(table.column("doc").to_pylist(), table.column("chars").to_pylist()):
            out[at] = chars.encode("latin-1")
        return out


def _bpe(path: str, pattern: str, held: int = HELD) -> tuple[ByteBpe, PieceIds]:
    def make() -> tuple[ByteBpe, PieceIds]:
        bpe = ByteBpe(path, pattern, held)
        return bpe, PieceIds(bpe.encode_keys, held + held // 8)

    return resident.keep(("bpe", path, pattern, held), make)


def _run(path: str, pattern: str, digests: bool, held: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = _bpe(path, pattern, held)
        written = [str(i) for i in range(max(bpe.ranks.values()) + 1)]
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, sizes = pieces.ids(part.column("text"))
                decoded = bpe.decode(ids, sizes)
                stops = np.cumsum(sizes)
                if digests:
                    every, ids_out = ids.tolist(), []
                    for start, stop in zip((stops - sizes).tolist(), stops.tolist()):
                        line = ",".join(map(written.__getitem__, every[start:stop]))
                        ids_out.append(hashlib.sha256(line.encode()).hexdigest())
                    decoded_out = pa.array([hashlib.sha256(x).hexdigest() for x in decoded])
                    ids_out = pa.array(ids_out)
                else:
                    ids_out = pa.ListArray.from_arrays(np.r_[0, stops].astype(np.int32), ids)
                    decoded_out = pa.array(decoded, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), ids_out, decoded_out],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )
            resident.give_back()

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def encode(
    docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, held: int = HELD
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``decoded`` (the ids' bytes) of every row.

    A null text counts as empty and gives no ids; repeated rows are encoded like any other; no
    row gives no row. Each partition works alone: nothing is shuffled, a lost task is run again.
    A word is contracted once per worker however often it occurs. One that is thousands of
    bytes long takes as many rounds as it has merges.
    """
    schema = "doc_id bigint, n_tokens bigint, ids array<int>, decoded binary"
    return _texts(docs).mapInArrow(_run(path, pattern, False, held), schema)


def encode_digests(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """As ``encode``, with SHA-256 digests of the ids (decimal, joined by commas) and bytes."""
    schema = "doc_id bigint, n_tokens bigint, ids string, decoded string"
    out = _texts(docs).mapInArrow(_run(path, pattern, True, HELD), schema)
    return out.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})


def decode(ids: Column, path: str) -> Column:
    """Bytes of a column of id lists, by the same ordered aggregation. Null gives null; ids that
    the vocabulary does not have give nothing."""
    pattern = public_tokenizers.PATTERN

    @F.pandas_udf("binary")
    def bytes_of(column):
        bpe, _ = _bpe(path, pattern)
        lists = [np.empty(0, np.int32) if x is None else np.asarray(x, np.int32) for x in column]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        out = bpe.decode(np.concatenate(lists) if lists else np.empty(0, np.int32), sizes)
        return column.__class__([None if x is None else y for x, y in zip(column, out)])

    return bytes_of(ids)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of every document's ids and of the bytes they decode to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
