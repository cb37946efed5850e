"""Exact inner-product search in a ball tree over sparse integer vectors.

A tree holds one block of vectors. A node's ball has an integer centroid and a radius; for a
query q and any vector x in it

    q.x  <=  q.centroid + |q| radius      and      q.x  <=  q.caps

where ``caps`` has each term's largest value in the node: the ball of every single term. The
smaller one is the node's bound. Sums of floats are rounded up by more than they can be wrong
(``UP``), so a bound is never below a score. Nodes are visited best bound first, until no bound
reaches the k-th score; vectors in leaves are scored in 64-bit integers.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Vectors of a leaf at most.
LEAF = 32
#: Entries of queries whose bounds are worked out together.
ENTRIES = 10_000
#: Relative room for rounding: above the error of any sum of fewer than a million terms.
UP = 1 + 1e-9

Found = tuple[int, bool, int]  # minus the score, whether the id is null, the id: sorts best first


@dataclass
class Queries:
    """Sparse queries: terms and weights of query i are at ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1


@dataclass
class Vectors:
    """Sparse rows of values above zero, none of them empty; ``ids`` may hold None."""

    ids: list[int | None]
    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def take(self, rows: np.ndarray) -> Vectors:
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Vectors([self.ids[r] for r in rows], starts, self.terms[at], self.values[at])


def _dots(v: Vectors, first: int, last: int, dense: np.ndarray) -> np.ndarray:
    """Inner products of the rows first to last with a dense vector."""
    a, b = v.starts[first], v.starts[last]
    return np.add.reduceat(v.values[a:b] * dense[v.terms[a:b]], v.starts[first:last] - a)


class BallTree:
    """A tree over the rows of ``vectors``, of ``width`` terms; equal rows may stay in one leaf."""

    def __init__(self, vectors: Vectors, width: int, leaf: int = LEAF):
        order = np.arange(len(vectors.ids))
        self.width = width
        self.nodes: list[tuple[int, int]] = []  # rows from, to
        self.children: list[tuple[int, int] | None] = []
        self.leaf = leaf
        self.vectors = vectors
        self._split(order, 0, len(order))
        self.vectors = vectors.take(order)

    def _dense(self, row: int) -> np.ndarray:
        v, out = self.vectors, np.zeros(self.width)
        a, b = v.starts[row], v.starts[row + 1]
        out[v.terms[a:b]] = v.values[a:b]
        return out

    def _split(self, order: np.ndarray, first: int, last: int) -> int:
        """Halves the rows by which of two far vectors they lie nearer to; sorts ``order``."""
        node = len(self.nodes)
        self.nodes.append((first, last))
        self.children.append(None)
        if last - first > self.leaf:
            own = self.vectors.take(order[first:last])
            rows = np.arange(last - first)
            squares = np.add.reduceat(own.values.astype(float) ** 2, own.starts[:-1])
            start = self._dense(order[first])
            a = self._dense(order[first + int(np.argmax(squares - 2 * _dots(own, 0, len(rows), start)))])
            b = self._dense(order[first + int(np.argmax(squares - 2 * _dots(own, 0, len(rows), a)))])
            side = _dots(own, 0, len(rows), a - b) - (a @ a - b @ b) / 2
            order[first:last] = order[first:last][np.argsort(side, kind="stable")]
            middle = (first + last) // 2
            self.children[node] = self._split(order, first, middle), self._split(order, middle, last)
        return node

    def bounds(self, queries: Queries) -> np.ndarray:
        """An upper bound of the scores for each query and node."""
        v, n = self.vectors, len(self.nodes)
        terms, columns = np.unique(queries.terms, return_inverse=True)
        place = np.full(self.width, -1)
        place[terms] = np.arange(len(terms))
        sums, caps, radii = np.zeros((n, len(terms))), np.zeros((n, len(terms))), np.zeros(n)
        sizes = np.diff(v.starts)
        kept = place[v.terms] >= 0
        row_of, column, value = np.repeat(np.arange(len(v.ids)), sizes)[kept], place[v.terms[kept]], v.values[kept].astype(float)
        from_ = np.searchsorted(row_of, np.arange(len(v.ids) + 1))
        squares = np.bincount(row_of, value * value, len(v.ids))
        for node in range(n - 1, -1, -1):  # children have larger numbers
            first, last = self.nodes[node]
            a, b = from_[first], from_[last]
            if self.children[node] is None:
                np.add.at(sums[node], column[a:b], value[a:b])
                np.maximum.at(caps[node], column[a:b], value[a:b])
            else:
                left, right = self.children[node]
                sums[node] = sums[left] + sums[right]
                caps[node] = np.maximum(caps[left], caps[right])
            centre = np.floor(sums[node] / (last - first))
            dots = np.bincount(row_of[a:b] - first, value[a:b] * centre[column[a:b]], last - first)
            room = squares[first:last] + centre @ centre
            radii[node] = np.sqrt(np.max(room - 2 * dots + room * (UP - 1) + 1))
        centres = np.floor(sums / np.array([[b - a] for a, b in self.nodes]))
        out = np.zeros((len(queries), n))
        for i in range(len(queries)):
            own = slice(queries.starts[i], queries.starts[i + 1])
            if own.start == own.stop:
                continue
            weights, at = queries.weights[own].astype(float), columns[own]
            length = np.sqrt(weights @ weights) * UP
            balls = centres[:, at] @ weights + length * radii
            out[i] = np.minimum(balls, caps[:, at] @ weights) * UP + 1e-6
        return out

    def search(self, queries: Queries, best: list[list[Found]], k: int) -> int:
        """Puts into ``best[i]`` the k best of it and of the tree's vectors with a score above
        0 for query i; equal scores by ascending id, null last. Returns how many leaves were read.
        """
        v, read = self.vectors, 0
        weights = np.zeros(self.width, np.int64)
        for i, bounds in enumerate(self.bounds(queries)):
            own = slice(queries.starts[i], queries.starts[i + 1])
            weights[queries.terms[own]] = queries.weights[own]
            found = best[i]
            least = -found[-1][0] if len(found) >= k else 1
            heap = [(-bounds[0], 0)]
            while heap and -heap[0][0] >= least:
                node = heapq.heappop(heap)[1]
                if self.children[node] is not None:
                    for child in self.children[node]:
                        if bounds[child] >= least:
                            heapq.heappush(heap, (-bounds[child], child))
                    continue
                read += 1
                first, last = self.nodes[node]
                scores = _dots(v, first, last, weights)
                good = np.flatnonzero(scores >= least)
                if len(good):
                    found += [(-int(scores[g]), v.ids[first + g] is None, v.ids[first + g] or 0) for g in good]
                    found.sort()
                    del found[k:]
                    least = -found[-1][0] if len(found) >= k else 1
            weights[queries.terms[own]] = 0
        return read


def in_parts(queries: Queries, entries: int = ENTRIES):
    """(first query, queries): consecutive parts of about ``entries`` entries."""
    first = 0
    while first < len(queries):
        last = max(int(np.searchsorted(queries.starts, queries.starts[first] + entries, "right")) - 1, first + 1)
        a, b = queries.starts[first], queries.starts[last]
        yield first, Queries(queries.starts[first : last + 1] - a, queries.terms[a:b], queries.weights[a:b])
        first = last
