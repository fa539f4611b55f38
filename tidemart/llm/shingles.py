"""Sets of word shingles as sorted 64-bit hashes, for whole Arrow batches at a time."""

from __future__ import annotations

import numpy as np

from tidemart.llm.rows import words

_U = np.uint64
_RANDOM = np.random.default_rng(20_260_101)
_BASE = _U(int(_RANDOM.integers(1 << 62, 1 << 63)) | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_LETTER = _RANDOM.integers(1, 1 << 63, 256).astype(_U) << _U(1) | _U(1)
_FOLDED = _LETTER.copy()
_FOLDED[0x41:0x5B] = _LETTER[0x61:0x7B]
_PLACE = _RANDOM.integers(1, 1 << 63, 64).astype(_U) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of the base of the word hash and of its inverse, as far as needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def reach(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < length:
            steps = np.full(length, _BASE)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=_U)
            steps = np.full(length, _INVERSE)
            steps[0] = 1
            self.down = np.cumprod(steps, dtype=_U)
        return self.up[:length], self.down[:length]


def word_hashes(
    data: np.ndarray, begins: np.ndarray, ends: np.ndarray, powers: Powers, fold: bool = True
) -> np.ndarray:
    """A hash of each word, by differences of one running polynomial; ``fold`` takes A-Z as a-z."""
    up, down = powers.reach(max(len(data), 1))
    running = np.zeros(len(data) + 1, _U)
    np.cumsum((_FOLDED if fold else _LETTER)[data] * up[: len(data)], out=running[1:], dtype=_U)
    return mix((running[ends] - running[begins]) * down[begins])


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, k: int, powers: Powers
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted, one text after another, and their numbers.

    A text with fewer than ``k`` words, but one at least, has its whole word sequence as its
    only shingle; a text without words has none.
    """
    begins, ends, owner = words(data, offsets)
    texts = len(offsets) - 1
    if not len(begins):
        return np.empty(0, _U), np.zeros(texts, np.int64)
    hashes = word_hashes(data, begins, ends, powers)
    counts = np.bincount(owner, minlength=texts)
    first = np.cumsum(counts) - counts
    heads, values = [], []
    last = max(len(owner) - k + 1, 0)
    whole = np.flatnonzero(owner[:last] == owner[k - 1 :])
    if len(whole):
        heads.append(whole)
        values.append(sum(mix(hashes[whole + j] ^ _PLACE[j]) for j in range(k)))
    for m in range(1, k):
        short = first[counts == m]
        if len(short):
            heads.append(short)
            values.append(sum(mix(hashes[short + j] ^ _PLACE[j]) for j in range(m)) + _PLACE[-m])
    heads, values = np.concatenate(heads), mix(np.concatenate(values))
    if len(values) > len(whole):
        order = np.argsort(heads, kind="stable")
        heads, values = heads[order], values[order]
    of = owner[heads]
    sizes = np.bincount(of, minlength=texts)
    stops = np.cumsum(sizes)
    for start, stop in zip((stops - sizes).tolist(), stops.tolist()):
        if stop - start > 1:
            values[start:stop].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[new], np.bincount(of[new], minlength=texts)


class MinMax:
    """Signatures that keep the least and the greatest value under each permutation, so that
    ``values`` of them cost half as many hash evaluations; banded into ``bands`` keys."""

    def __init__(self, rows: int, bands: int, seed: int = 7):
        if rows * bands % 2:
            raise ValueError("rows times bands must be even")
        random = np.random.default_rng(seed)
        self.rows, self.bands = rows, bands
        self.permutations = rows * bands // 2
        self.flips = random.integers(0, 1 << 63, self.permutations).astype(_U) << _U(1)
        self.factors = random.integers(0, 1 << 63, self.permutations).astype(_U) << _U(1) | _U(1)

    def signatures(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row per set; ``starts`` are where the (non-empty) sets begin in ``values``."""
        out = np.empty((2 * self.permutations, len(starts)), _U)
        for p in range(self.permutations):
            seen = ((values ^ self.flips[p]) * self.factors[p]) >> _U(32)
            out[p] = np.minimum.reduceat(seen, starts)
            out[self.permutations + p] = np.maximum.reduceat(seen, starts)
        return out.T

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        """Equal keys mean equal values in all rows of the same band."""
        keys = np.empty((len(signatures), self.bands), _U)
        for band in range(self.bands):
            key = np.full(len(signatures), band + 1, _U)
            for row in range(self.rows):
                key = mix(key * _BASE + signatures[:, band * self.rows + row])
            keys[:, band] = key
        return keys.view(np.int64)
