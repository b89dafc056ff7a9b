"""Cover trees over norm-augmented vectors, searched by inner product.

With one more component ``sqrt(R**2 - |x|**2)``, R the largest length of a tree,
all its vectors have length R, and a query with a 0 there is at the squared distance
``|q|**2 + R**2 - 2 q.x``.  A node holds the vectors within its covering radius of
its centre; so distances from the centre bound the inner products of all of them
from above and below.

Each level's centres are farther from each other than the level's radius, which is
``BASE`` times smaller than the one above; a node's own radius is what its vectors
take.  A node with few vectors, or one that the next level would hardly divide, is a
leaf.  Nodes are rows; a part of a tree is a forest, whose roots bound what is below
them as well, so trees can be read back in any split.
"""

from __future__ import annotations

import heapq

import numpy as np

from geoframe.llm.int_vectors import Factor, products

BASE = 1.3
LEAF = 128                # vectors that are not divided
SPREAD = 8                # a level has at most an 8th of the node's vectors as centres
SAFE = 1e-6               # of R: room for rounded distances


def build(ints: np.ndarray):
    """Nodes (parent, centre, radius, members or None), parents first; numbers are
    rows of ``ints``."""
    x = ints.astype("float64")
    squares = (x * x).sum(axis=1)
    most = squares.max(initial=0)
    x = np.column_stack([x, np.sqrt(np.maximum(most - squares, 0))])
    room = SAFE * np.sqrt(most)

    def far(rows, centre):
        # equal lengths: the squared distance is 2 R**2 - 2 x.c
        return np.sqrt(np.maximum(2 * most - 2 * (x[rows] @ x[centre]), 0))

    nodes, todo = [], [(-1, 0, np.arange(len(ints)), None)]
    while todo:
        parent, centre, rows, d = todo.pop()
        d = far(rows, centre) if d is None else d
        radius = float(d.max(initial=0))
        me = len(nodes)
        children = []
        if len(rows) > LEAF and radius > room:
            level = radius / BASE
            left, dist = rows, d
            while len(left) and len(children) <= len(rows) // SPREAD:
                c = centre if not children else int(left[0])
                dist = dist if not children else far(left, c)
                near = dist <= level
                if children or near.any():
                    near |= left == c
                children.append((me, c, left[near], dist[near]))
                left, dist = left[~near], dist[~near]
            if len(left):
                children = []
        nodes.append((parent, centre, radius + room, None if children else rows))
        todo.extend(children)
    return nodes, most


class Tree:
    """Some nodes of one tree, ready to be searched.  ``nodes``: (number, parent,
    radius, centre vector, leaf) with ``leaf`` None or (classes, labels, first ids,
    Factor)."""

    def __init__(self, nodes, most: float):
        self.most = most
        place = {n[0]: i for i, n in enumerate(nodes)}
        below: dict[int, list[int]] = {}
        for i, n in enumerate(nodes):
            below.setdefault(place.get(n[1], -1), []).append(i)
        self.leaf = [n[4] for n in nodes]
        self.below = {i: (np.array(k), np.array([nodes[j][2] for j in k]),
                          np.array([nodes[j][3] for j in k], "float64").reshape(len(k), -1))
                      for i, k in below.items()}

    def _bounds(self, q: np.ndarray, square: float, at: int):
        """Children of a node and the bounds of the inner products below them."""
        kids, radius, centres = self.below[at]
        both = square + self.most
        d = np.sqrt(np.maximum(both - 2 * (centres @ q), 0))
        slack = both * 1e-9 + 1e-6
        room = SAFE * np.sqrt(both)
        high = (both - np.maximum(d - radius - room, 0) ** 2) / 2 + slack
        low = (both - (d + radius + room) ** 2) / 2 - slack
        return kids, high, low

    def search(self, q: Factor, label, same: bool, windows, top: int):
        """Best-first descent for one query: per window (low, high) the first ``top``
        classes of its label (or of others) with a score inside, by score and first id.
        Nodes whose bounds miss every window, or lie below what it holds already,
        are skipped.  ``windows`` holds floats or ints, ends included."""
        vector = q.floats[0]
        square = float(vector @ vector)
        found = [[] for _ in windows]                # of (-score, first id, class)
        floor = np.array([w[0] for w in windows], "float64")
        ceiling = np.array([w[1] for w in windows], "float64")
        heap = []

        def push(at):
            kids, high, low = self._bounds(vector, square, at)
            open_ = ((high[:, None] >= floor - np.abs(floor) * 1e-9)
                     & (low[:, None] <= ceiling + np.abs(ceiling) * 1e-9)).any(axis=1)
            for k, h, lo in zip(kids[open_].tolist(), high[open_].tolist(), low[open_].tolist()):
                heapq.heappush(heap, (-h, k, lo))

        push(-1)
        while heap:
            high, at, low = heapq.heappop(heap)
            if not ((-high >= floor) & (low <= ceiling)).any():
                continue
            if self.leaf[at] is None:
                push(at)
                continue
            classes, labels, first, factor = self.leaf[at]
            scores = products(factor, q)[:, 0]
            fits = (labels == label) == same
            for w, (lo, hi) in enumerate(windows):
                in_ = np.nonzero(fits & (scores >= lo) & (scores <= hi) & (scores >= floor[w]))[0]
                if not len(in_):
                    continue
                if len(in_) > top:                   # with all that tie with the last
                    s = scores[in_]
                    in_ = in_[s >= np.partition(s, len(s) - top)[len(s) - top]]
                held = found[w] + [(-int(scores[i]), int(first[i]), int(classes[i])) for i in in_]
                found[w] = sorted(held)[:top]
                if len(found[w]) == top:
                    floor[w] = max(floor[w], -found[w][-1][0])
        return found
