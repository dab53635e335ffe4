"""Ball trees over sparse integer vectors, for exact maximum inner product search.

The rows of a tree are halved again and again along the direction between two far points of a
node (the one farthest from the centroid, and the one farthest from that), all nodes of a level
at once. Each node has its centroid and its radius; the radius is kept per block of terms, so a
query is bounded by ``q . c + sum over blocks of |q_b| r_b`` (Cauchy and Schwarz in each block),
which is far tighter than one radius where rows and query differ in most terms. Terms that occur
in the same part of the tree share a block, so a block is empty in most other nodes. Bounds are
floating point and rounded up by more than their error; scores are 64-bit integers and exact, so
a subtree is passed over only if none of its rows can enter the result.
"""

from __future__ import annotations

import heapq

import numpy as np

LEAF = 32
"""Least rows of a leaf (a leaf has less than twice as many)."""
HEAD, TERMS_A_BLOCK = 64, 16
"""Term blocks: one for each of the commonest terms, and one for so many of the others."""
SLACK = 1e-9
"""Relative error allowed for: far above that of sums of this length in double precision."""


class BallTree:
    """Tree over rows given as ``indptr, terms, values`` (values integers from 0, terms below
    ``width``); row i has ``ids[i]``."""

    def __init__(self, ids: np.ndarray, indptr: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int):
        rows = len(ids)
        self.width = width
        self.depth = max(0, (rows // LEAF).bit_length() - 1)
        row_of = np.repeat(np.arange(rows), np.diff(indptr))
        label = self._labels(rows, row_of, terms, values.astype(np.float64))
        order = np.argsort(label, kind="stable")
        place = np.empty(rows, np.int64)
        place[order] = np.arange(rows)
        entry = np.argsort(place[row_of], kind="stable")  # entries of a leaf become one slice
        self.ids, self.terms, self.values = ids[order], terms[entry], values[entry].astype(np.int64)
        self.row_of = place[row_of][entry]
        self.indptr = np.searchsorted(self.row_of, np.arange(rows + 1))
        self.first_row = np.searchsorted(label[order], np.arange((1 << self.depth) + 1))
        self._blocks(rows)
        self._bounds(label[order])

    def _blocks(self, rows: int) -> None:
        """``by_block``: the terms in the order of their blocks; ``begins``: where each block begins."""
        often = np.bincount(self.terms, minlength=self.width)
        mean_row = np.bincount(self.terms, self.row_of, self.width) / np.maximum(often, 1)
        head = min(HEAD, self.width)
        common = np.argsort(-often, kind="stable")[:head]
        place = mean_row.copy()
        place[common] = -1
        self.by_block = np.argsort(place, kind="stable")
        self.begins = np.append(np.arange(head), np.arange(head, self.width, TERMS_A_BLOCK))
        self.block_of = np.empty(self.width, np.int64)
        self.block_of[self.by_block] = np.searchsorted(self.begins, np.arange(self.width), "right") - 1

    def _labels(self, rows: int, row_of: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        label = np.zeros(rows, np.int64)
        square = np.bincount(row_of, values * values, rows)

        def farthest(score: np.ndarray, nodes: int) -> np.ndarray:
            order = np.lexsort((score, label))
            return order[np.searchsorted(label[order], np.arange(nodes), "right") - 1]

        def dense(chosen: np.ndarray) -> np.ndarray:
            node = np.full(rows, -1)
            node[chosen] = np.arange(len(chosen))
            own = node[row_of] >= 0
            out = np.zeros((len(chosen), self.width))
            out[node[row_of[own]], terms[own]] = values[own]
            return out

        def products(vectors: np.ndarray) -> np.ndarray:
            return np.bincount(row_of, values * vectors[label[row_of], terms], rows)

        for level in range(self.depth):
            nodes = 1 << level
            centre = self._centres(label, row_of, terms, values, nodes)
            one = farthest(square - 2 * products(centre), nodes)
            to_one = products(dense(one))
            other = farthest(square - 2 * to_one, nodes)
            order = np.lexsort((to_one - products(dense(other)), label))
            size = np.bincount(label, minlength=nodes)
            begin = np.cumsum(size) - size
            inside = np.arange(rows) - begin[label[order]]
            label[order] = 2 * label[order] + (2 * inside >= size[label[order]])
        return label

    def _centres(self, label, row_of, terms, values, nodes: int) -> np.ndarray:
        sums = np.bincount(label[row_of] * self.width + terms, values, nodes * self.width).reshape(nodes, self.width)
        return sums / np.maximum(np.bincount(label, minlength=nodes), 1)[:, None]

    def _bounds(self, label: np.ndarray) -> None:
        """Centroids and radii per block of all nodes, level by level (node k of a level has the
        children 2k and 2k + 1 of the next)."""
        rows, values, count = len(self.ids), self.values.astype(np.float64), len(self.begins)
        cell = self.row_of * count + self.block_of[self.terms]
        square = np.bincount(cell, values * values, rows * count).reshape(rows, count)
        self.centres, self.radii = [], []
        for level in range(self.depth + 1):
            node = label >> (self.depth - level)
            centre = self._centres(node, self.row_of, self.terms, values, 1 << level)
            own = np.add.reduceat(np.square(centre[:, self.by_block]), self.begins, axis=1)
            across = np.bincount(cell, values * centre[node[self.row_of], self.terms], rows * count).reshape(rows, count)
            apart = square - 2 * across + own[node] + SLACK * (square + own[node])
            begin = np.searchsorted(node, np.arange(1 << level))
            self.centres.append(centre)
            self.radii.append(np.sqrt(np.maximum(np.maximum.reduceat(apart, begin, axis=0), 0)))

    def bounds(self, queries: np.ndarray) -> list[np.ndarray]:
        """Per level, what no row of a node can exceed for each of ``queries`` (term by query, floating
        point)."""
        norms = np.sqrt(np.add.reduceat(np.square(queries[self.by_block]), self.begins, axis=0))
        return [(c @ queries + r @ norms) * (1 + SLACK) + 1 for c, r in zip(self.centres, self.radii)]

    def search(self, weights: np.ndarray, bounds: list[np.ndarray], query: int, k: int, best: list) -> int:
        """Best-first search for one query; ``best`` is a heap of the k best (score, -id, id) so far
        and is added to. Gives the number of leaves scored."""
        waiting, scored = [(-bounds[0][0, query], 0, 0)], 0
        while waiting:
            bound, level, node = heapq.heappop(waiting)
            if len(best) == k and -bound < best[0][0]:
                break  # an equal score could still win by its id
            if level < self.depth:
                for child in (2 * node, 2 * node + 1):
                    heapq.heappush(waiting, (-min(-bound, bounds[level + 1][child, query]), level + 1, child))
                continue
            scored += 1
            lo, hi = self.first_row[node], self.first_row[node + 1]
            a, b = self.indptr[lo], self.indptr[hi]
            if a == b:
                continue
            each = np.append(self.values[a:b] * weights[self.terms[a:b]], 0)
            scores = np.add.reduceat(each, self.indptr[lo:hi] - a)
            scores[self.indptr[lo:hi] == self.indptr[lo + 1:hi + 1]] = 0
            least = best[0][0] if len(best) == k else 1
            for row in np.flatnonzero(scores >= max(least, 1)).tolist():
                entry = (int(scores[row]), -int(self.ids[lo + row]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return scored
