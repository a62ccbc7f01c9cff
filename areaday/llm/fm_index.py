"""An FM-index of a sequence of numbers: wavelet-tree ranks, backward search, sampled suffix positions.

All searches run side by side as arrays: one step narrows the ranges of every phrase, or moves every occurrence.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in their order, by prefix doubling; the last symbol must be the only smallest.

    The first order is by as many symbols as one number holds. Later rounds sort only suffixes that are still alike.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    span = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for ahead in range(min(span, n)):
        key[: n - ahead] |= symbols[ahead:].astype(np.int64) << (bits * (span - 1 - ahead))
    order = np.argsort(key, kind="stable")
    # The rank of a suffix is the first place of those that are alike so far.
    new = np.concatenate(([True], np.diff(key[order]) != 0))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    places = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(places):
        suffixes = order[places]
        after = suffixes + span
        key = rank[suffixes] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by_key = np.argsort(key, kind="stable")
        suffixes, key = suffixes[by_key], key[by_key]
        order[places] = suffixes
        new = np.concatenate(([True], np.diff(key) != 0))
        rank[suffixes] = places[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        places = places[~(new & np.append(new[1:], True))]
        span *= 2
    return order


class Bits:
    """Bits in words of 64, with the count of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        self.words = packed.view("<u8")
        self.counts = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, before: np.ndarray) -> np.ndarray:
        word, bit = before >> 6, (before & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.counts[word] + np.bitwise_count(below)


class WaveletTree:
    """Counts of a symbol before a position, by the bits of one level after the other (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.bits, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            ones = (symbols >> level) & 1 == 1
            self.bits.append(Bits(ones))
            zeros = symbols[~ones]
            self.zeros.append(len(zeros))
            symbols = np.concatenate((zeros, symbols[ones]))

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        first = np.zeros_like(before)
        for depth, (bits, zeros) in enumerate(zip(self.bits, self.zeros, strict=True)):
            one = (symbol >> (self.levels - 1 - depth)) & 1 == 1
            ones_before, ones_first = bits.ones(before), bits.ones(first)
            before = np.where(one, zeros + ones_before, before - ones_before)
            first = np.where(one, zeros + ones_first, first - ones_first)
        return before - first


class FMIndex:
    """The index of ``symbols``, which are at least 1 and below ``size``; 0 is the end mark."""

    def __init__(self, symbols: np.ndarray, size: int, sample: int = SAMPLE):
        whole = np.append(symbols, 0).astype(np.int32)
        suffixes = suffix_array(whole)
        self.last = whole[suffixes - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(whole, minlength=size))))
        self.tree = WaveletTree(self.last, size)
        self.sampled = suffixes % sample == 0
        self.positions = suffixes[self.sampled]
        self.samples_before = np.cumsum(self.sampled) - 1

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that start with each phrase; ``phrases`` has a row per phrase, aligned to the right."""
        width = phrases.shape[1]
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.last), np.int64)
        for step in range(width):
            active = np.flatnonzero((step < lengths) & (low < high))
            symbol = phrases[active, width - 1 - step]
            low[active] = self.before[symbol] + self.tree.rank(symbol, low[active])
            high[active] = self.before[symbol] + self.tree.rank(symbol, high[active])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of the suffixes in ``rows``: step back in the text until one is sampled."""
        found, rows, steps = np.empty(len(rows), np.int64), rows.copy(), 0
        open_ = np.arange(len(rows))
        while len(open_):
            here = rows[open_]
            hit = self.sampled[here]
            found[open_[hit]] = self.positions[self.samples_before[here[hit]]] + steps
            open_, here = open_[~hit], here[~hit]
            symbol = self.last[here]
            rows[open_] = self.before[symbol] + self.tree.rank(symbol, here)
            steps += 1
        return found
