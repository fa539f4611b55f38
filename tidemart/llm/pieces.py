"""Texts as sequences of distinct pieces, so that a tokenizer sees each piece once.

The public byte-level vocabularies cut a text by one pattern before they merge. It never joins
a character with a blank behind it, and a single line end stands alone, so cutting there first
changes nothing. ``re`` counts a few more characters as white space than the pattern does;
that only leaves some pieces longer.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What keeps a text from being cut at every blank and line end.
_UNEVEN = (
    r"[ \n][ \n]|^[ \n]|[ \n]$|[\t\v\f\r\x1c-\x1f]"
    r"|[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
_ENDS = (",", ".")
_CUT = re.compile(r" (?=\S)")
#: In front of a piece that has no blank before it.
_PLAIN = "\r"

#: From keys to the same keys in any order, their ids one after another, and their counts.
Encoder = Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray]]


def cut(text: str) -> list[str]:
    """Keys of a text's pieces, in order. See ``literal``."""
    if not text:
        return []
    if text.replace("\n", " ").split(" ") == text.split():
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = _PLAIN + keys[0]
        return keys
    first, *others = _CUT.split(text)
    return [_PLAIN + first, *[_PLAIN + " " + other for other in others]]


def literal(key: str) -> str:
    """The characters that a key stands for."""
    if key[0] == _PLAIN:
        return key[1:]
    return key if key[0] == "\n" else " " + key


class PieceIds:
    """Ids of texts by way of their distinct pieces.

    Holds the ids of at most ``limit`` pieces beyond those of the texts at hand; then it starts
    over, which costs time but changes no result.
    """

    def __init__(self, encode: Encoder, limit: int = 450_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.flat = np.empty(1 << 20, np.int32)
        self.starts = np.empty(1 << 18, np.int64)
        self.sizes = np.empty(1 << 18, np.int64)
        self.used = 0

    def _learn(self, keys: set[str]) -> None:
        """A comma or full stop at the end of a piece, after a letter, is a token of its own, so
        such pieces are put together from the piece before it, which is often known."""
        ended = [key for key in keys if key[-1:] in _ENDS and key[-2:-1].isalpha()]
        plain = keys.difference(ended)
        plain.update(key[:-1] for key in ended)
        plain.update(_PLAIN + key[-1] for key in ended)
        plain = plain.difference(self.numbers)
        if plain:
            self._add(*self.encode(list(plain)))
        if ended:
            halves = [half for key in ended for half in (key[:-1], _PLAIN + key[-1])]
            numbers = np.fromiter(map(self.numbers.__getitem__, halves), np.int64, len(halves))
            sizes = self.sizes[numbers]
            self._add(ended, self._gather(numbers, sizes), sizes.reshape(-1, 2).sum(axis=1))

    def _gather(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids of numbered pieces, one after another."""
        before = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[numbers] - before, sizes) + np.arange(int(sizes.sum()))
        return self.flat[at]

    def _add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.numbers)
        self.flat = _room(self.flat, self.used + len(ids))
        self.starts = _room(self.starts, known + len(keys))
        self.sizes = _room(self.sizes, known + len(keys))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[known : known + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[known : known + len(keys)] = sizes
        self.numbers.update(zip(keys, range(known, known + len(keys))))
        self.used += len(ids)

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an array of texts one after another, and how many each text has. A null text
        counts as empty."""
        distinct, at, pieces = _cut_all(pc.fill_null(column, ""))
        new = set(distinct).difference(self.numbers)
        if len(self.numbers) + len(new) > self.limit and self.numbers:
            self._clear()
            new = set(distinct)
        if new:
            self._learn(new)
        known = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        numbers = known[at]
        sizes = self.sizes[numbers]
        stops = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(pieces)]
        return self._gather(numbers, sizes), np.diff(stops, prepend=0)


def _cut_all(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct keys of all texts, which of them each piece is, and the pieces of each text.

    Texts with single blanks and line ends only are cut by Arrow, others by ``cut``.
    """
    if pc.any(pc.match_substring_regex(texts, _UNEVEN)).as_py():
        cuts = list(map(cut, texts.to_pylist()))
        keys = pa.array(list(chain.from_iterable(cuts)), pa.string())
        pieces = np.fromiter(map(len, cuts), np.int64, len(cuts))
    else:
        marked = pc.binary_join_element_wise(_PLAIN, pc.replace_substring(texts, "\n", " \n"), "")
        lists = pc.split_pattern(marked, " ")
        keys, pieces = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    found = keys.dictionary_encode()
    distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
    return distinct, found.indices.to_numpy(), pieces


def joined(runs: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as ids one after another, and their counts."""
    sizes = np.fromiter(map(len, runs), np.int64, len(runs))
    return np.fromiter(chain.from_iterable(runs), np.int32, int(sizes.sum())), sizes


def _room(array: np.ndarray, length: int) -> np.ndarray:
    if length <= len(array):
        return array
    larger = np.empty(max(length, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger
