"""A compressed FM-index over sequences of words: wavelet matrices, backward search side by side.

Kept of the indexed text are a bit-packed wavelet matrix of its Burrows-Wheeler transform, one of the
owners of its suffixes in their order, and a byte a suffix for the words it shares with the one before.
The suffix array itself is not kept.
"""

from __future__ import annotations

import numpy as np

def _packed(bit: np.ndarray) -> np.ndarray:
    raw = np.packbits(bit.astype(np.uint8), bitorder="little")
    return np.concatenate((raw, np.zeros(8 + -len(raw) % 8, np.uint8))).view(np.uint64)


class Wavelet:
    """Symbols of a sequence, one packed bit vector for each bit of a symbol, with counts every 64 bits."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        rest = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (rest >> level) & 1
            packed = _packed(bit)
            self.words.append(packed)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1])).astype(np.int32))
            self.zeros.append(int(len(rest) - bit.sum()))
            rest = np.concatenate((rest[bit == 0], rest[bit == 1]))
        #: where each symbol's stretch begins after the last level
        self.first = np.full(size, 0, np.int64)
        starts = np.flatnonzero(np.concatenate(([True], rest[1:] != rest[:-1]))) if len(rest) else np.zeros(0, np.int64)
        self.first[rest[starts]] = starts

    def _ones(self, i: int, p: np.ndarray) -> np.ndarray:
        word = p >> 6
        below = (np.uint64(1) << (p & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i][word] + np.bitwise_count(self.words[i][word] & below)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        p = at
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            ones = self._ones(i, p)
            p = np.where((symbols >> level) & 1, self.zeros[i] + ones, p - ones)
        return p - self.first[symbols]

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest symbol in each stretch [low, high), none of them empty."""
        n, out = len(low), np.zeros(len(low), np.int64)
        for i in range(self.levels):
            ones = self._ones(i, np.concatenate((low, high)))
            a, b = ones[:n], ones[n:]
            zero = high - b > low - a
            low, high = np.where(zero, low - a, self.zeros[i] + a), np.where(zero, high - b, self.zeros[i] + b)
            out = 2 * out + ~zero
        return out


class Shared:
    """Words that each suffix shares with the one before it, up to a cap: the borders of the stretches of
    suffixes that share a number of words are looked up."""

    #: Suffixes of a block whose smallest number is kept; borders of up to FEW words are kept as places.
    BLOCK, FEW = 32, 2

    def __init__(self, shared: np.ndarray) -> None:
        self.shared = np.append(shared, 0).astype(np.uint8)
        padded = np.concatenate((self.shared, np.zeros(-len(self.shared) % self.BLOCK, np.uint8)))
        self.low = padded.reshape(-1, self.BLOCK).min(1)
        self.places = [np.flatnonzero(self.shared < d).astype(np.int32) for d in range(1, self.FEW + 1)]

    def _find(self, at: np.ndarray, words: np.ndarray, ahead: bool) -> np.ndarray:
        out = at.copy()
        for d, places in enumerate(self.places, 1):
            if len(few := np.flatnonzero(words == d)):
                out[few] = places[np.searchsorted(places, at[few]) if ahead else np.searchsorted(places, at[few], "right") - 1]
        rest = np.flatnonzero(words > self.FEW)
        while len(rest := rest[self.shared[out[rest]] >= words[rest]]):
            p = out[rest]
            edge = p % self.BLOCK == 0
            whole = edge & (self.low[p // self.BLOCK - (not ahead)] >= words[rest])
            out[rest] = p + np.where(whole, self.BLOCK, 1) * (1 if ahead else -1)
        return out

    def stretch(self, low: np.ndarray, high: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows around [low, high) that share so many words, one or more, with them."""
        return self._find(low, words, False), self._find(high, words, True)

    def shorter(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The most words that rows beyond [low, high) share with them."""
        return np.maximum(self.shared[low], self.shared[high]).astype(np.int64)


class FmIndex:
    """Index of word sequences (symbols from 0), each ended by a separator of its own, with their owners.

    ``depth`` is the length of the windows that count: a match is never longer.
    """

    def __init__(self, flat: np.ndarray, lengths: np.ndarray, owners: np.ndarray, depth: int) -> None:
        m, n = len(lengths), len(flat) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.empty(n, np.int64)
        word = np.ones(n, bool)
        word[ends] = False
        text[ends] = np.arange(m)
        text[word] = flat + m
        self.rows, self.depth, self.size = n, depth, int(flat.max(initial=-1)) + 1
        if not self.size:  # without words nothing matches
            return
        order = self._sort(text)
        previous = text[order - 1]  # row 0 of the text wraps to its last separator
        # all separators are one symbol here: a search never runs across one
        self.tree = Wavelet(np.where(previous < m, 0, previous - m + 1), self.size + 1)
        self.below = m + np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=self.size))))[: self.size]
        self.names, number = np.unique(owners, return_inverse=True)
        self.owner = Wavelet(np.repeat(number, lengths + 1)[order], max(1, len(self.names)))
        self.shared = Shared(self._common(text, order, depth))

    @staticmethod
    def _sort(text: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling."""
        n = len(text)
        order = np.argsort(text, kind="stable")
        sort = text[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], sort[1:] != sort[:-1])))
        k = 1
        while int(rank[order[-1]]) < n - 1:
            after = np.zeros(n, np.int64)
            after[: n - k] = rank[k:] + 1
            key = rank * (n + 1) + after
            order = np.argsort(key, kind="stable")
            sort = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], sort[1:] != sort[:-1])))
            k *= 2
        return order

    @staticmethod
    def _common(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
        """Words that each suffix shares with the one before it, ``most`` at most."""
        out, n = np.zeros(len(order), np.int64), len(order)
        live = np.arange(1, n)
        for k in range(most):
            a, b = order[live] + k, order[live - 1] + k
            inside = (a < n) & (b < n)
            live, a, b = live[inside], a[inside], b[inside]
            live = live[text[a] == text[b]]
            if not len(live):
                break
            out[live] = k + 1
        return out

    def stream(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of sequences (symbols of the index, -1: a word it doesn't have), cut at ``depth``.

        Returns, for each word, the most words from it on that stand in the index, and the smallest owner
        of a match of ``depth`` words (where it is shorter, the length alone counts).  A sequence is left
        once no match of ``depth`` words can begin further on; its words before that have 0.

        Every sequence is searched backward from its end, all of them side by side, a word a step.  Where a
        word can't be put before a match, and beyond ``depth`` words, the match loses its last words: as few
        as make its rows more.  So a sequence takes two steps a word at most.
        """
        matched, owner = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        ends = np.cumsum(lengths)
        live = np.flatnonzero((lengths >= self.depth) & (self.size > 0))
        begin, pos = (ends - lengths)[live], ends[live] - 1
        whole = np.int64(self.rows)
        low, high, held = np.zeros(len(live), np.int64), np.full(len(live), whole), np.zeros(len(live), np.int64)
        while len(pos):
            c = flat[pos]
            known = (c >= 0) & (c < self.size)
            s = np.where(known, c, 0)
            both = self.tree.rank(np.concatenate((s, s)) + 1, np.concatenate((low, high)))
            new_low, new_high = self.below[s] + both[: len(s)], self.below[s] + both[len(s) :]
            ok = known & (new_high > new_low)
            low, high, held = np.where(ok, new_low, low), np.where(ok, new_high, high), held + ok
            matched[pos[ok]] = held[ok]
            full = np.flatnonzero(held == self.depth)
            if len(full):
                owner[pos[full]] = self.names[self.owner.least(low[full], high[full])]
                held[full] -= 1
                low[full], high[full] = self.shared.stretch(low[full], high[full], held[full])
            failed = np.flatnonzero(~ok)
            pos = pos - (ok | (held == 0))
            if len(failed):
                lost = np.where(known[failed] & (held[failed] > 0), self.shared.shorter(low[failed], high[failed]), 0)
                gone = failed[(held[failed] > 0) & (lost == 0)]
                less = failed[lost > 0]
                held[failed] = lost
                low[gone], high[gone] = 0, whole
                low[less], high[less] = self.shared.stretch(low[less], high[less], held[less])
            # a match of ``depth`` words further on ends where the longest one here does, or before
            keep = (pos + 1 + held - begin >= self.depth) & (pos >= begin)
            if not keep.all():
                begin, pos, low, high, held = begin[keep], pos[keep], low[keep], high[keep], held[keep]
        return matched, owner
