"""Compressed FM-index of word sequences, searched many patterns at a time."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_SIX, _LOW = np.uint64(6), np.uint64(63)


class _Bits:
    """Bit vector with constant-time rank: packed words and a count each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits) // 64 + 1
        padded = np.zeros(n * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int64)
        self.zeros = len(bits) - int(bits.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (_ONE << (i & 63).astype(np.uint64)) - _ONE
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletTree:
    """Rank of any symbol in a sequence, one bit vector per symbol bit (the
    tree's levels are stored side by side, zeros first)."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits = []
        s = sequence
        for level in range(self.levels - 1, -1, -1):
            bit = ((s >> level) & 1).astype(np.uint8)
            self.bits.append(_Bits(bit))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        every = np.arange(symbols, dtype=np.int64)
        self.origin = self._walk(every, np.zeros(symbols, np.int64))

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, bits in zip(range(self.levels - 1, -1, -1), self.bits):
            ones = bits.rank1(i)
            i = np.where((symbol >> level) & 1, bits.zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``i``, element by element."""
        return self._walk(symbol, i) - self.origin[symbol]


class FMIndex:
    """Index of a sequence of integer symbols; symbol 0 separates texts.

    Suffixes are sorted by their first ``depth`` symbols, which is enough for
    patterns of up to ``depth``.
    """

    def __init__(self, sequence: np.ndarray, symbols: int, depth: int = 64):
        n = len(sequence)
        order = sequence.astype(np.int64)
        k = 1
        while k < depth and n:
            after = np.zeros(n, np.int64)
            after[:n - k] = order[k:] + 1 if k < n else 0
            both = order * (int(order.max()) + 2) + after
            order = np.unique(both, return_inverse=True)[1]
            k *= 2
        suffixes = np.argsort(order, kind="stable")
        self.tree = WaveletTree(sequence[suffixes - 1].astype(np.int64), symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols))]).astype(np.int64)
        self.size = n

    def extend_left(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: suffix ranges of ``symbol + pattern``."""
        n = len(symbol)
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.first[symbol]
        return base + both[:n], base + both[n:]


def repeated_windows(index: FMIndex, texts: list[np.ndarray], window: int) -> list[np.ndarray]:
    """For each text (part of the index), which of its windows of ``window``
    symbols occur at least twice in the index.

    Each text keeps a range of undecided windows.  A backward search from the
    end of the range's last window finds how far left the text still occurs
    twice (its matching statistic there): a long match decides all windows in
    it at once, a short one the last window.  A search of the first window
    that ends at ``p`` shows that no window over ``p - 1`` is repeated.  The
    two alternate; all texts advance together, one symbol a step.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(texts).astype(np.int64) if texts else np.empty(0, np.int64)
    repeated = np.zeros(len(flat), bool)  # by window start
    lo_w, hi_w = np.zeros(len(texts), np.int64), sizes - window
    lane = np.flatnonzero(hi_w >= 0)
    from_right = np.ones(len(texts), bool)
    pos, stop = hi_w + window, lo_w.copy()
    lo, hi = np.zeros(len(texts), np.int64), np.full(len(texts), index.size, np.int64)
    while len(lane):
        a, b = index.extend_left(flat[base[lane] + pos[lane] - 1], lo[lane], hi[lane])
        ok = b - a >= 2
        good = lane[ok]
        lo[good], hi[good] = a[ok], b[ok]
        pos[good] -= 1
        ended = np.concatenate([lane[~ok], good[pos[good] == stop[good]]])
        if len(ended):
            for i in ended.tolist():
                p, first, last = pos[i], lo_w[i], hi_w[i]
                if from_right[i]:
                    if p <= last:  # the match covers windows p .. last
                        repeated[base[i] + p:base[i] + last + 1] = True
                        hi_w[i] = p - 1
                    else:
                        hi_w[i] = last - 1
                        from_right[i] = False
                else:
                    if p <= first:
                        repeated[base[i] + first] = True
                        lo_w[i] = first + 1
                    else:
                        lo_w[i] = p
                    from_right[i] = True
                stop[i] = lo_w[i]
                pos[i] = (hi_w[i] if from_right[i] else lo_w[i]) + window
            lo[ended], hi[ended] = 0, index.size
            lane = lane[lo_w[lane] <= hi_w[lane]]
    return [repeated[base[i]:base[i] + max(0, sizes[i] - window + 1)] for i in range(len(texts))]
