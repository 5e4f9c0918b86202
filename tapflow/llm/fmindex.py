"""A compressed FM-index of word sequences, in numpy, for one bounded shard.

The shard's sequences are laid end to end, each closed by a separator; their
Burrows-Wheeler transform is kept as a wavelet matrix of packed bit vectors
with rank samples.  Backward search extends all queries by one word at a time.
Every suffix carries the number of its document, and a sparse table of minima
answers "does this interval hold a document before mine".
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank: 64-bit words and a count before each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Rank of any symbol in a sequence of symbols below 2 ** levels."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.bits, self.zeros = levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.bits.append(Bits(bit.astype(np.uint8)))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        start = np.zeros_like(low)
        for i in range(self.levels):
            bit = (symbol >> (self.levels - 1 - i)) & 1 == 1
            ends = np.concatenate([start, low, high])
            ones = self.bits[i].rank(ends)
            ends = np.where(np.tile(bit, 3), self.zeros[i] + ones, ends - ones)
            start, low, high = np.split(ends, 3)
        return low - start, high - start


class FMIndex:
    """``words``: non-negative word codes; ``bounds``: sequence offsets; ``doc``: a
    number per sequence."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, doc: np.ndarray):
        count = len(bounds) - 1
        self.codes, code = np.unique(words, return_inverse=True)
        sizes = np.diff(bounds)
        n = len(words) + count
        owner = np.repeat(np.arange(count), sizes + 1)
        sep = bounds[1:] + np.arange(count)
        text = np.zeros(n, dtype=np.int64)  # 0: separator
        is_word = np.ones(n, dtype=bool)
        is_word[sep] = False
        text[is_word] = code + 1
        rank = np.where(is_word, count + text, owner)  # separators differ, and come first
        step = 1
        longest = int(sizes.max(initial=0)) + 1
        order = np.argsort(rank, kind="stable")
        while step < longest:
            next_ = np.zeros(n, dtype=np.int64)
            next_[: n - step] = rank[step:] + 1
            key = rank * (rank.max() + 2) + next_
            order = np.argsort(key, kind="stable")
            new = np.ones(n, dtype=np.int64)
            new[1:] = key[order][1:] != key[order][:-1]
            rank[order] = np.cumsum(new) - 1
            step *= 2
        last = text[order - 1]
        self.first = np.searchsorted(np.sort(text), np.arange(len(self.codes) + 2))
        self.levels = max(1, int(len(self.codes)).bit_length())
        self.matrix = WaveletMatrix(last, self.levels)
        self.size = n
        self.minima = [doc[owner[order]]]
        while 2 ** len(self.minima) <= n:
            half, low = 2 ** (len(self.minima) - 1), self.minima[-1]
            self.minima.append(np.minimum(low[:-half], low[half:]))

    def encode(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words that are all in the index."""
        return np.searchsorted(self.codes, words) + 1

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front."""
        a, b = self.matrix.rank(symbol, low, high)
        return self.first[symbol] + a, self.first[symbol] + b

    def smallest_doc(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest document number in each non-empty interval."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - 2 ** k])
        return out


def repeated_windows(index: FMIndex, words: np.ndarray, bounds: np.ndarray, doc: np.ndarray,
                     window: int) -> np.ndarray:
    """For every word, whether the ``window`` words from it on (inside its
    sequence) also stand in a sequence of the index with a smaller number.

    Matching statistics from the right: a match is extended to the left while
    some earlier document has it; where it breaks at word ``s``, no match can
    hold that word and end beyond, so the search goes on from the end of the
    window that starts at ``s``.
    """
    symbol = index.encode(words)
    found = np.zeros(len(words) + 1, dtype=np.int64)  # +1 / -1 at the ends of runs of windows
    base = bounds[:-1]
    end = np.diff(bounds) - 1  # last word of the pattern, in its sequence
    live = np.flatnonzero(end >= window - 1)
    at, low, high = end.copy(), np.zeros_like(end), np.full_like(end, index.size)
    while len(live):
        a, b = index.extend(symbol[base[live] + at[live]], low[live], high[live])
        good = b > a
        good[good] = index.smallest_doc(a[good], b[good]) < doc[live[good]]
        low[live], high[live] = a, b
        at[live[good]] -= 1
        over = ~good | (at[live] < 0)
        done = live[over]
        # words at + 1 .. end match
        full = done[end[done] - at[done] >= window]
        np.add.at(found, base[full] + at[full] + 1, 1)
        np.add.at(found, base[full] + end[full] - window + 2, -1)
        end[done] = np.minimum(end[done] - 1, at[done] + window - 1)
        at[done] = end[done]
        low[done], high[done] = 0, index.size
        live = live[end[live] >= window - 1]
    return np.cumsum(found)[:-1] > 0
