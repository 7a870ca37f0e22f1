"""A compressed full-text index of a shard: BWT in a wavelet matrix of packed bits, searched backward for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; ends when all ranks differ."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    step = 1
    while True:
        key = rank * np.int64(max(n, int(rank.max()) + 1) + 2)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = new
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletMatrix:
    """rank(c, i): how often symbol c occurs before position i, for arrays of both."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        now = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.start = np.zeros(size, np.int64)  # where a symbol's run starts after the last level
        every = np.arange(size)
        self.start = self._follow(every, np.zeros(size, np.int64))

    def _follow(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            at = i >> 6
            mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[k][at] + np.bitwise_count(self.words[k][at] & mask)
            i = np.where((c >> (self.levels - 1 - k)) & 1, self.zeros[k] + ones, i - ones).astype(np.int64)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._follow(c, i) - self.start[c]


class FMIndex:
    """Index of the texts of a shard, given as arrays of 64-bit words."""

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(t) for t in texts], np.int64)
        every = np.concatenate(texts)
        alphabet, word = np.unique(every, return_inverse=True)
        # Each text ends with a symbol of its own, below all words: symbol 0 of the wavelet matrix stands for all ends.
        many = len(texts)
        self.at = np.concatenate([[0], np.cumsum(lengths + 1)])
        symbols = np.empty(len(every) + many, np.int64)
        is_end = np.zeros(len(symbols), bool)
        is_end[self.at[1:] - 1] = True
        symbols[is_end] = np.arange(many)
        symbols[~is_end] = word + many
        self.word = np.zeros(len(symbols), np.int64)
        self.word[~is_end] = word + 1
        order = suffix_array(symbols)
        size = len(alphabet) + 1
        counts = np.bincount(self.word, minlength=size)
        self.first = np.concatenate([[0], np.cumsum(counts)])[:size]
        self.n = len(symbols)
        self.last = WaveletMatrix(self.word[order - 1], size)

    def extend(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: from the rows of patterns to those of the patterns with a word put before each."""
        both = self.last.rank(np.concatenate([word, word]), np.concatenate([lo, hi]))
        return self.first[word] + both[: len(word)], self.first[word] + both[len(word) :]

    def repeated_windows(self, asked: np.ndarray, width: int) -> list[np.ndarray]:
        """For the texts numbered ``asked``: the starts whose matching statistic (with another place) is at least ``width``.

        All texts are streamed at once, from the right.  A match is extended to the left while it has another
        place.  Once it has none, no window that holds it is repeated, so the search goes on with the next
        window that does not; most words of text that repeats nowhere are never looked at.
        """
        base, length = self.at[asked], self.at[asked + 1] - self.at[asked] - 1
        out_lane, out_start = [], []
        lane = np.flatnonzero(length >= width)
        end = length[lane] - 1
        at = end + 1
        lo, hi = np.zeros(len(lane), np.int64), np.full(len(lane), self.n)
        while len(lane):
            at = at - 1
            lo, hi = self.extend(self.word[base[lane] + at], lo, hi)
            more = hi - lo >= 2
            hit = more & (end - at + 1 >= width)
            out_lane.append(lane[hit])
            out_start.append(at[hit])
            start = np.minimum(at, end - width)
            end = np.where(more, end, start + width - 1)
            over = np.where(more, at == 0, start < 0)
            lo, hi = np.where(more, lo, 0), np.where(more, hi, self.n)
            at = np.where(more, at, end + 1)
            if over.any():
                left = ~over
                lane, end, at, lo, hi = lane[left], end[left], at[left], lo[left], hi[left]
        lanes = np.concatenate(out_lane) if out_lane else np.empty(0, np.int64)
        starts = np.concatenate(out_start) if out_start else np.empty(0, np.int64)
        order = np.lexsort((starts, lanes))
        return np.split(starts[order], np.searchsorted(lanes[order], np.arange(1, len(asked))))
