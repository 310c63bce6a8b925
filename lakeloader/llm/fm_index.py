"""A compressed FM-index over word numbers, with a wavelet matrix for its ranks."""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


class BitRank:
    """Bits in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.cumsum(ones, dtype=np.int32) - ones

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        word = at >> 6
        mask = (ONE << (at & 63).astype(np.uint64)) - ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int32)


class WaveletMatrix:
    """Ranks of every symbol of a sequence, one bit vector per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, BitRank, int]] = []
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            self.levels.append((bit, BitRank(ones), int(len(symbols) - ones.sum())))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        self.first = self._down(np.arange(alphabet, dtype=np.int32), np.zeros(alphabet, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ranks, zeros in self.levels:
            ones = ranks.ones(at)
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._down(symbol, at) - self.first[symbol]


class FmIndex:
    """Backward search for patterns of up to `depth` symbols.

    `text` holds numbers from 1 on, and a 0 after each document. Suffixes are sorted
    by their first `depth` symbols, which is all that such patterns need.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text, depth
        self.suffixes = np.argsort(_order(text, depth), kind="stable")
        alphabet = int(text.max()) + 1 if len(text) else 1
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet))))
        self.matrix = WaveletMatrix(text[self.suffixes - 1], alphabet)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with the symbol and go on as those from `low` to `high` do."""
        ranks = self.matrix.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        base = self.smaller[symbol]
        return base + ranks[: len(symbol)], base + ranks[len(symbol) :]

    def matching(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics at the threshold: the patterns of `length` symbols at
        `starts` that occur more than once, as `(which, low, high)` over the suffixes.

        Symbols are added from the right. A pattern leaves as soon as it occurs once.
        """
        which = np.arange(len(starts))
        symbol = self.text[starts + length - 1]
        low, high = self.smaller[symbol], self.smaller[symbol + 1]
        for offset in range(length - 2, -2, -1):
            several = high - low > 1
            which, low, high = which[several], low[several], high[several]
            if offset < 0 or not len(which):
                break
            low, high = self.extend(self.text[starts[which] + offset], low, high)
        return which, low, high


def _order(text: np.ndarray, depth: int) -> np.ndarray:
    """For each place the rank of its first `depth` symbols, by doubling."""

    def joined(left: np.ndarray, right: np.ndarray, by: int) -> np.ndarray:
        after = np.zeros(len(right), np.int64)
        after[: max(len(right) - by, 0)] = right[by:] + 1
        pairs = left.astype(np.int64) * (int(after.max(initial=0)) + 1) + after
        return np.unique(pairs, return_inverse=True)[1].reshape(-1)

    done, total, power, width = None, 0, text.astype(np.int64), 1
    while True:
        if depth & width:
            done = power if done is None else joined(done, power, total)
            total += width
        if total == depth:
            return done
        power, width = joined(power, power, width), width * 2
