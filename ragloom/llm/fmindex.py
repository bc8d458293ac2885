"""A small FM-index over word sequences: truncated suffix order, wavelet matrix, backward search.

Symbols are 64-bit word hashes. The order of the suffixes is exact for their first ``DEPTH`` words,
which is enough for patterns of up to ``DEPTH - 1`` words.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


def prefix_ranks(text: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes sorted by their first ``depth`` symbols, and the dense ranks by 1, 2, 4, ... symbols."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    ranks, h = [rank], 1
    while h < depth:
        nxt = np.full(n, -1, dtype=np.int64)
        nxt[:max(n - h, 0)] = rank[h:]
        rank = np.unique(rank * (n + 1) + nxt + 1, return_inverse=True)[1].astype(np.int64)
        h *= 2
        ranks.append(rank)
    return np.argsort(rank, kind="stable"), [r.astype(np.int32) for r in ranks]


def neighbour_lcp(order: np.ndarray, ranks: list[np.ndarray], limit: int) -> np.ndarray:
    """Common prefix length of each suffix and its predecessor in the order, at most ``limit``; first and last + 1: 0."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    out = np.zeros(n + 1, dtype=np.int32)
    for k in range(len(ranks) - 2, -1, -1):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), dtype=bool)
        same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
        step = same.astype(np.int64) << k
        out[1:n] += step.astype(np.int32)
        a += step
        b += step
    return np.minimum(out, limit)


class WaveletMatrix:
    """Bit-packed levels with a running count per 64-bit word."""

    def __init__(self, seq: np.ndarray, levels: int):
        self.levels, self.packed, self.before, self.zeros = levels, [], [], []
        n = len(seq)
        for k in range(levels - 1, -1, -1):
            bit = (seq >> k & 1).astype(np.uint8)
            padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
            padded[:n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.packed.append(words)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(words).astype(np.int64))].astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Position after all levels of ``at`` symbols for ``symbol``; differences are ranks."""
        at = at.astype(np.int64)
        for level in range(self.levels):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            ones = self.before[level][word] + np.bitwise_count(
                self.packed[level][word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            one = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            at = np.where(one, self.zeros[level] + ones, at - ones)
        return at


class FMIndex:
    """Index of segments, each of one owner. ``limit``: the match length that is wanted."""

    def __init__(self, segments: list[np.ndarray], owners: np.ndarray, limit: int):
        self.limit = limit
        lengths = np.array([len(s) for s in segments], dtype=np.int64)
        words = np.concatenate(segments)
        self.vocabulary, code = np.unique(words, return_inverse=True)
        n = int(lengths.sum()) + len(segments)
        text = np.zeros(n, dtype=np.int64)  # 0 ends a segment
        ends = np.cumsum(lengths + 1)
        inside = np.ones(n, dtype=bool)
        inside[ends - 1] = False
        text[inside] = code + 1
        owner = np.repeat(owners, lengths + 1)
        order, ranks = prefix_ranks(text)
        lcp = neighbour_lcp(order, ranks, limit)
        del ranks
        sigma = len(self.vocabulary) + 1
        levels = max(1, int(sigma).bit_length())
        self.tree = WaveletMatrix(text[order - 1], levels)  # the BWT
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=sigma))].astype(np.int64)
        self.zero = self.tree.descend(np.arange(sigma), np.zeros(sigma, dtype=np.int64))
        self.lcp = lcp
        self.lower, self.upper = self._bounds(lcp)
        starts = np.flatnonzero(lcp[:n] < limit)
        group = np.cumsum(lcp[:n] < limit) - 1
        self.group_lo, self.group_hi = starts[group], np.r_[starts[1:], n][group]
        self.group_owner = np.minimum.reduceat(owner[order], starts)[group]
        self.n = n

    @staticmethod
    def _bounds(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per index the last index before, and the first after, with a smaller lcp."""
        size = len(lcp)
        lower, upper = np.zeros(size, dtype=np.int32), np.full(size, size - 1, dtype=np.int32)
        at = np.arange(size, dtype=np.int32)
        for v in np.unique(lcp):
            here = lcp == v
            if v > 0:
                below = lcp < v
                lower[here] = np.maximum.accumulate(np.where(below, at, 0))[here]
                upper[here] = np.minimum.accumulate(np.where(below, at, size - 1)[::-1])[::-1][here]
        return lower, upper

    def encode(self, words: np.ndarray) -> np.ndarray:
        """Codes of word hashes; -1 for a word that the index lacks."""
        at = np.searchsorted(self.vocabulary, words)
        at = np.minimum(at, len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, -1)

    def matching(self, documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the documents, concatenated: per word the length (at most ``limit``) of the
        longest match that starts there, and for full lengths the smallest owner of a segment with it.

        All documents go right to left in step; a mismatch drops to the parent interval by the lcp bounds."""
        lengths = np.array([len(d) for d in documents], dtype=np.int64)
        ends = np.cumsum(lengths)
        code = self.encode(np.concatenate(documents)) if len(documents) else np.zeros(0, dtype=np.int64)
        length = np.zeros(len(code), dtype=np.int32)
        owner = np.zeros(len(code), dtype=np.int64)
        lo, hi, q = (np.zeros(len(documents), dtype=np.int64) for _ in range(3))
        hi[:] = self.n
        for t in range(int(lengths.max(initial=0))):
            live = np.flatnonzero(lengths > t)
            at = ends[live] - 1 - t
            todo = np.arange(len(live))
            while len(todo):
                d, c = live[todo], code[at[todo]]
                known = c > 0
                sym = np.where(known, c, 0)
                both = self.tree.descend(np.r_[sym, sym], np.r_[lo[d], hi[d]])
                base = self.first[sym] - self.zero[sym]
                new_lo, new_hi = both[:len(d)] + base, both[len(d):] + base
                ok = known & (new_hi > new_lo)
                lo[d[ok]], hi[d[ok]] = new_lo[ok], new_hi[ok]
                q[d[ok]] += 1
                out = ~ok & ((q[d] == 0) | ~known)
                lo[d[out]], hi[d[out]], q[d[out]] = 0, self.n, 0
                back = ~ok & ~out
                b = d[back]
                left, right = self.lcp[lo[b]], self.lcp[hi[b]]
                depth = np.maximum(left, right)
                lo[b], hi[b] = (np.where((left == depth) & (depth > 0), self.lower[lo[b]], np.where(depth == 0, 0, lo[b])),
                                np.where((right == depth) & (depth > 0), self.upper[hi[b]], np.where(depth == 0, self.n, hi[b])))
                q[b] = depth
                todo = todo[back]
            full = q[live] > self.limit
            f = live[full]
            hi[f], lo[f] = self.group_hi[lo[f]], self.group_lo[lo[f]]
            q[f] = self.limit
            length[at] = q[live]
            done = q[live] == self.limit
            owner[at[done]] = self.group_owner[lo[live[done]]]
        return length, owner
