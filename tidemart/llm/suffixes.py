"""Suffix arrays over the words of a shard of documents, and binary search in them."""

from __future__ import annotations

import numpy as np


class SuffixArray:
    """All suffixes of a shard's documents in order, compared word by word to ``depth`` words.

    ``hashes`` are the words of all documents, one after another, and ``ends[i]`` is where the
    document of word ``i`` ends: a suffix stops there, and sorts before those that go on.
    """

    def __init__(self, hashes: np.ndarray, ends: np.ndarray, depth: int):
        self.vocabulary, words = np.unique(hashes, return_inverse=True)
        self.words, self.ends = words.astype(np.int32), ends
        self.slots = self._sorted(max(depth, 1))

    def _sorted(self, depth: int) -> np.ndarray:
        """Prefix doubling; each round sorts only the suffixes that are still tied."""
        count = len(self.words)
        if not count:
            return np.empty(0, np.int64)
        slots = np.argsort(self.words)
        ordered = self.words[slots]
        new = np.ones(count, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        start = np.maximum.accumulate(np.where(new, np.arange(count), 0))
        rank = np.empty(count, np.int64)
        rank[slots] = start
        known = 1
        while known < depth:
            tied = np.flatnonzero(~(new & np.append(new[1:], True)))
            if not len(tied):
                break
            at = slots[tied]
            behind = at + known
            within = behind < self.ends[at]
            second = np.where(within, rank[np.minimum(behind, count - 1)] + 1, 0)
            key = start[tied] * (count + 1) + second
            order = np.argsort(key)
            at, key = at[order], key[order]
            slots[tied] = at
            new[tied[1:]] = key[1:] != key[:-1]
            start = np.maximum.accumulate(np.where(new, np.arange(count), 0))
            rank[at] = start[tied]
            known *= 2
        return slots

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The shard's number of each word, -1 for words that it lacks."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def _first(self, low, high, depth, wanted, after: bool) -> np.ndarray:
        """Binary search for many ranges at once: the first slot whose word at ``depth`` is not
        below ``wanted``, or is above it (``after``)."""
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            suffix = self.slots[middle]
            at = suffix + depth
            word = np.where(at < self.ends[suffix], self.words[np.minimum(at, len(self.words) - 1)], -1)
            right = word <= wanted[open_] if after else word < wanted[open_]
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
            open_ = open_[low[open_] < high[open_]]
        return low

    def search(
        self, hashes: np.ndarray, ends: np.ndarray, least: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the suffix of the tests at each of their words: how many words its longest
        verbatim match in the shard has, and the slots of all suffixes that agree with its
        first ``least`` words (none: an empty range)."""
        count = len(hashes)
        words = self.of(hashes)
        length = np.zeros(count, np.int64)
        found = np.zeros((2, count), np.int64)
        live = np.flatnonzero(words >= 0)
        ordered = self.words[self.slots]
        low = np.searchsorted(ordered, words[live], "left")
        high = np.searchsorted(ordered, words[live], "right")
        depth = 1
        while len(live):
            length[live] = depth
            whole = least[live] == depth
            found[0, live[whole]], found[1, live[whole]] = low[whole], high[whole]
            more = live + depth < ends[live]
            more[more] = words[live[more] + depth] >= 0
            live, low, high = live[more], low[more], high[more]
            wanted = words[live + depth]
            low, high = (
                self._first(low, high, depth, wanted, False),
                self._first(low, high, depth, wanted, True),
            )
            there = low < high
            live, low, high = live[there], low[there], high[there]
            depth += 1
        return length, found[0], found[1]
