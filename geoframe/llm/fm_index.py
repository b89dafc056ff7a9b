"""A bidirectional FM-index over word numbers, for patterns of limited length.

Rows are the places of a sequence, sorted by the ``depth`` words that follow
(which fixes the interval of every pattern of up to ``depth`` words); ``bwt`` is
the word before each row's place.  ``starts`` are the cumulative counts of words
(C) and ``order`` the rows by the word before them, so that ranks inside ``bwt``
(Occ) are places in it and row ``order[j]`` steps back to row j.  A second index of the reversed sequence extends patterns to the right;
an interval of both is kept in step as patterns grow.  Word 0 ends a piece; it
is in no pattern.
"""

from __future__ import annotations

import numpy as np


class FMIndex:
    """Rows of one direction; extends patterns by the word before them."""

    def __init__(self, words: np.ndarray, depth: int):
        """``words``: word numbers, 0 at the end of each piece and at the last place."""
        n, size = len(words), int(words.max()) + 1 if len(words) else 1
        if size ** depth < 1 << 63:
            key, after = np.zeros(n, "int64"), words.astype("int64")
            for _ in range(depth):
                key = key * size + after
                after = np.roll(after, -1)
            rows = np.argsort(key, kind="stable").astype("int32" if n < 1 << 31 else "int64")
            del key, after
        else:
            rows = np.lexsort([np.roll(words, -k) for k in reversed(range(depth))])
        self.first = words[rows]                       # first word of each row
        self.bwt = words[rows - 1]
        del rows
        self.order = np.argsort(self.bwt, kind="stable").astype("int32" if n < 1 << 31 else "int64")
        self.starts = np.searchsorted(self.first, np.arange(size + 1))     # C
        self.inner = np.zeros(n + 1, "int64")
        np.cumsum(self.bwt != 0, out=self.inner[1:])

    def occ(self, word: int, row: int) -> int:
        """How often ``word`` is in ``bwt[:row]``."""
        own = self.order[self.starts[word]:self.starts[word + 1]]
        return int(np.searchsorted(own, row))

    def extend(self, word: int, low: int, high: int) -> tuple[int, int]:
        """Rows of the pattern with ``word`` before it."""
        at = int(self.starts[word])
        return at + self.occ(word, low), at + self.occ(word, high)

    def extended(self, low, high) -> np.ndarray:
        """Per interval, the rows with a word (not an end) before the pattern."""
        return self.inner[high] - self.inner[low]


class Patterns:
    """All patterns of one length that are still followed: words (patterns x
    length) and their intervals in both indexes."""

    def __init__(self, words, low, high, low_r, high_r):
        self.words, self.low, self.high, self.low_r, self.high_r = words, low, high, low_r, high_r

    @property
    def counts(self) -> np.ndarray:
        return self.high - self.low

    def kept(self, keep: np.ndarray) -> "Patterns":
        return Patterns(self.words[keep], self.low[keep], self.high[keep], self.low_r[keep], self.high_r[keep])


class Bidirectional:
    """The index of a sequence and, unless ``one_way``, of its reverse; without it
    patterns grow to the left, and their places in the reverse are not kept."""

    def __init__(self, words: np.ndarray, depth: int, one_way: bool = False):
        self.forward = FMIndex(words, depth)
        self.reverse = None
        if not one_way:
            self.reverse = FMIndex(np.concatenate([words[-2::-1], words[-1:]]) if len(words) else words, depth)

    def single(self) -> Patterns:
        """The patterns of one word."""
        low, high = self.forward.starts[1:-1], self.forward.starts[2:]
        return Patterns(np.arange(1, len(low) + 1)[:, None], low, high, low, high)

    def _grow(self, index: FMIndex, low, high):
        """All extensions of disjoint intervals by the word before: parent, word,
        first row and end of each, ordered by word, then parent's rows.  Rows with
        a word before them keep their order when they step back, so those of an
        extension follow each other."""
        n = len(index.bwt)
        parent = np.full(n, -1, "int32")
        size = high - low
        rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        parent[rows] = np.repeat(np.arange(len(low)), size)
        came = parent[index.order]                      # parent of the row that steps back here
        edge = np.nonzero(np.concatenate([[True], (came[1:] != came[:-1])
                                          | (index.first[1:] != index.first[:-1])]))[0] if n else np.zeros(0, "int64")
        ends = np.concatenate([edge[1:], [n]])[:len(edge)]
        real = (came[edge] >= 0) & (index.first[edge] != 0)
        return came[edge][real], index.first[edge][real], edge[real], ends[real]

    def _step(self, index: FMIndex, low, high, other_low):
        """Extensions, and their first rows in the other index: those of a parent
        lie there in the order of the added word, ends first."""
        parent, word, lo, hi = self._grow(index, low, high)
        if self.reverse is None:
            return parent, word, lo, hi, lo
        ends = (high - low) - index.extended(low, high)
        order = np.lexsort([word, parent])
        n = (hi - lo)[order]
        before = np.cumsum(n) - n
        opens = np.searchsorted(parent[order], np.arange(len(low)))
        base = before[np.minimum(opens, max(len(before) - 1, 0))] if len(before) else np.zeros(len(low), "int64")
        other = np.empty(len(parent), "int64")
        other[order] = before - base[parent[order]] + (other_low + ends)[parent[order]]
        return parent, word, lo, hi, other

    def left(self, p: Patterns) -> Patterns:
        """Every pattern with every word that stands before it."""
        parent, word, lo, hi, other = self._step(self.forward, p.low, p.high, p.low_r)
        return Patterns(np.column_stack([word, p.words[parent]]), lo, hi, other, other + hi - lo)

    def right(self, p: Patterns) -> Patterns:
        """Every pattern with every word that stands after it."""
        parent, word, lo, hi, other = self._step(self.reverse, p.low_r, p.high_r, p.low)
        return Patterns(np.column_stack([p.words[parent], word]), other, other + hi - lo, lo, hi)
