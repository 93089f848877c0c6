"""A compressed FM-index over integer symbols, searched many patterns at a time."""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


class WaveletMatrix:
    """Ranks of symbols in a sequence: one packed bit vector per bit of the alphabet."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = list(reversed(range(max(1, int(symbols - 1).bit_length()))))
        self.words, self.before, self.zeros = [], [], []
        s = sequence
        for level in self.levels:
            bit = (s >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            words = np.zeros(len(s) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        self.base = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, words, before, zeros in zip(self.levels, self.words, self.before, self.zeros):
            block = at >> 6
            ones = before[block] + np.bitwise_count(words[block] & ((ONE << (at & 63).astype(np.uint64)) - ONE))
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(symbol, at) - self.base[symbol]


class FMIndex:
    """Index of a text of symbols 1 and up, in which 0 separates passages.

    Suffixes are sorted by their first ``order`` symbols, which is all that
    patterns of up to that length need.
    """

    def __init__(self, text: np.ndarray, order: int):
        n = len(text)
        symbols = int(text.max(initial=0)) + 1
        rank = text.astype(np.int64)
        length = 1
        while length < order:
            follow = np.zeros(n, np.int64)
            follow[: n - length] = rank[length:] + 1
            key = rank * (n + symbols + 1) + follow
            _, rank = np.unique(key, return_inverse=True)
            length *= 2
            if rank.max(initial=0) == n - 1:
                break
        self.text, self.order = text, order
        self.suffixes = np.argsort(rank, kind="stable")
        self.bwt = WaveletMatrix(text[self.suffixes - 1], symbols)
        self.begins = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))

    def search(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval [lo, hi) of the ``length`` symbols at each place of the text.

        Backward search, all places together; a place whose interval is down
        to itself is left there: it occurs once.
        """
        c = self.text[starts + length - 1]
        lo, hi = self.begins[c].copy(), self.begins[c + 1].copy()
        live = np.flatnonzero(hi - lo > 1)
        for step in reversed(range(length - 1)):
            c = self.text[starts[live] + step]
            lo[live] = self.begins[c] + self.bwt.rank(c, lo[live])
            hi[live] = self.begins[c] + self.bwt.rank(c, hi[live])
            live = live[hi[live] - lo[live] > 1]
            if not len(live):
                break
        return lo, hi
