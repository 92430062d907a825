"""A full-text index over word numbers: suffix order, Burrows-Wheeler transform in a wavelet tree, common prefixes."""
from __future__ import annotations

from functools import cached_property

import numpy as np


class WaveletTree:
    """Ranks of symbols in a sequence, one packed bit vector a binary digit, largest digit first.

    Every 64 bits are one word with the count of ones before it. `place(c, i)` leads position i of the sequence down
    to its place among the sorted symbols, so its distance from `place(c, 0)` is the number of c before i.
    """

    def __init__(self, sequence: np.ndarray, most: int):
        self.levels = []
        for digit in range(max(1, int(most).bit_length()) - 1, -1, -1):
            ones = ((sequence >> digit) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(sequence) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((digit, words, before, len(sequence) - int(ones.sum())))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        self.first = self.place(np.arange(most + 1), np.zeros(most + 1, np.int64))

    def place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for digit, words, before, zeros in self.levels:
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(words[word] & below)
            at = np.where((symbols >> digit) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        return self.place(symbols, at) - self.first[symbols]


def nearest_smaller(values: np.ndarray, step: int) -> np.ndarray:
    """For each position the nearest one before (step -1) or after (1) it with a smaller value; the ends, which hold the
    smallest value, point at themselves."""
    to = np.clip(np.arange(len(values)) + step, 0, len(values) - 1)
    open_ = np.arange(1, len(values) - 1)
    while len(open_):
        open_ = open_[values[to[open_]] >= values[open_]]
        to[open_] = to[to[open_]]
    return to


class FMIndex:
    """Texts of symbols 1 to `most`, given one after the other in `symbols` with their `lengths`.

    Suffixes are ordered as far as the longest text goes, by doubling the ordered length; each text ends in a 0, which
    no query holds, so nothing is found across texts.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, most: int):
        ends = np.cumsum(lengths + 1) - 1
        body = np.zeros(len(symbols) + len(lengths), np.int64)
        inside = np.ones(len(body), bool)
        inside[ends] = False
        body[inside] = symbols
        self.most, self.size, longest = most, len(body), int(lengths.max(initial=0)) + 1
        ranks, covered = [np.append(body, -1)], 1
        order = np.argsort(body, kind="stable")
        while covered < longest:
            last = ranks[-1]
            following = np.full(self.size, -1, np.int64)
            following[:max(self.size - covered, 0)] = last[covered:-1]
            key = last[:-1] * (max(self.size, most) + 2) + following + 1
            order = np.argsort(key, kind="stable")
            fresh = np.empty(self.size + 1, np.int64)
            fresh[order] = np.cumsum(np.diff(key[order], prepend=-1) != 0) - 1
            fresh[-1] = -1
            ranks.append(fresh)
            covered *= 2
        self.text = np.searchsorted(ends, order)                     # of which text each suffix is
        self.start = order - np.append(0, ends + 1)[self.text]
        self.common = self._common_prefixes(order, ranks, ends)
        self.tree = WaveletTree(body[order - 1], most)
        self.below = np.append(0, np.cumsum(np.bincount(body, minlength=most + 1)))[:-1]

    def _common_prefixes(self, order: np.ndarray, ranks: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
        """Symbols that each suffix shares with the one before it in order; -1 at both ends."""
        a, b = order[:-1], order[1:]
        shared = np.zeros(len(b), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            at, to = np.minimum(a + shared, self.size), np.minimum(b + shared, self.size)
            shared += np.where(ranks[level][at] == ranks[level][to], 1 << level, 0)
        shared = np.minimum(shared, np.minimum(ends[self.text[:-1]] - a, ends[self.text[1:]] - b))
        return np.concatenate([[-1], shared, [-1]])

    @cached_property
    def _smaller(self) -> tuple[np.ndarray, np.ndarray]:
        return nearest_smaller(self.common, -1), nearest_smaller(self.common, 1)

    def _parent(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The smallest larger interval of suffixes with a common prefix, and the length of that prefix."""
        before, after = self._smaller
        depth = np.maximum(self.common[low], self.common[high])
        wide_low = np.where(self.common[low] == depth, before[low], low)
        wide_high = np.where(self.common[high] == depth, after[high], high)
        root = depth <= 0
        return np.where(root, 0, wide_low), np.where(root, self.size, wide_high), np.maximum(depth, 0)

    def matching_statistics(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each position of the queries the length of the longest match that begins there, and one row of its interval.

        Queries are read backwards side by side. A match grows by one symbol while its interval does not become empty;
        otherwise it gives symbols up at its end, interval by interval. Symbols of 0 match nothing.
        """
        offset = np.cumsum(lengths) - lengths
        longest, row = np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64)
        by_length = np.argsort(-lengths, kind="stable")
        active = np.searchsorted(-lengths[by_length], -np.arange(1, int(lengths.max(initial=0)) + 1), side="right")
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.size, np.int64)
        length = np.zeros(len(lengths), np.int64)
        for back, n in enumerate(active):
            query = by_length[:n]
            at = offset[query] + lengths[query] - 1 - back
            symbol = symbols[at]
            todo = np.flatnonzero(symbol > 0)
            none = np.flatnonzero(symbol <= 0)
            low[none], high[none], length[none] = 0, self.size, 0
            while len(todo):
                s = symbol[todo]
                new_low, new_high = (self.below[s] + self.tree.rank(s, x[todo]) for x in (low, high))
                hit = new_low < new_high
                done = todo[hit]
                low[done], high[done] = new_low[hit], new_high[hit]
                length[done] += 1
                todo = todo[~hit]
                todo = todo[length[todo] > 0]
                if len(todo):
                    low[todo], high[todo], length[todo] = self._parent(low[todo], high[todo])
            longest[at], row[at] = length[:n], low[:n]
        return longest, row

    def smallest(self, values: np.ndarray, window: int) -> np.ndarray:
        """For each row the smallest value, one a text, of the texts that hold the first `window` symbols of its suffix."""
        if not self.size:
            return values[:0]
        starts = np.flatnonzero(self.common[:-1] < window)
        group = np.cumsum(self.common[:-1] < window) - 1
        return np.minimum.reduceat(values[self.text], starts)[group]
