"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are projected to DIMS dimensions with a fixed Gaussian (2-stable) matrix:
the squared projected distance of two vectors over their squared distance follows
the chi-square law with DIMS degrees of freedom. Each block holds a kd-tree over its
projected rows. A query takes projected neighbours in order of distance from the
tree, verifies them on the original vectors, and stops when a row as near as its
kth best would have come up by now with probability CONFIDENCE.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm import vectors

DIMS = 8            # even, for the closed form of the chi-square law
CONFIDENCE = 0.95
LEAF = 64
PORTION = 512       # projected neighbours before the first test; twice as many before each next
SEED = 7


def projection(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, DIMS))


def chi_square_cdf(x: float) -> float:
    """P(chi-square with DIMS degrees <= x)."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, DIMS // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi_square_quantile(p: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid) < p else (low, mid)
    return high


def kd_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows, nodes): nodes are rows (first, last, left, right, box
    low..., box high...), children 0 at a leaf; the root is node 0."""
    order = np.arange(len(points))
    nodes: list[list] = []

    def build(a: int, b: int) -> int:
        box = points[order[a:b]]
        low, high = box.min(0), box.max(0)
        me = len(nodes)
        nodes.append([a, b, 0, 0, *low, *high])
        if b - a > LEAF:
            axis = int((high - low).argmax())
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(box[:, axis], mid)]
            nodes[me][2] = build(a, a + mid)
            nodes[me][3] = build(a + mid, b)
        return me

    build(0, len(points))
    return order, np.array(nodes, float)


class Tree:
    """A block's kd-tree with what a search needs of it as lists."""

    def __init__(self, data: np.ndarray, ids: np.ndarray, order: np.ndarray, nodes: np.ndarray):
        self.data, self.ids = data, ids
        self.matrix = projection(data.shape[1])
        self.order, self.points = order, (data @ self.matrix)[order]
        self.first, self.last, self.left, self.right = nodes[:, :4].astype(int).T.tolist()
        self.low, self.high = nodes[:, 4:4 + DIMS], nodes[:, 4 + DIMS:]

    def nearest(self, query: np.ndarray, own: int, k: int, stop: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k nearest found. ``stop``: quantile of the test.

        Projected neighbours come in portions, nearest first and each complete up
        to the nearest unopened box; the test follows every portion."""
        at = query @ self.matrix
        gap = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        bound = (gap * gap).sum(1).tolist()  # of every node's box
        heap = [(bound[0], 0)]
        pool_d, pool_r = np.zeros(0), np.zeros(0, np.int64)  # opened, not yet due
        best_d, best_r = np.zeros(0), np.zeros(0, np.int64)
        portion = PORTION
        while True:
            opened, many = [], 0
            while heap and many < portion:
                _, node = heapq.heappop(heap)
                if self.left[node]:
                    heapq.heappush(heap, (bound[self.left[node]], self.left[node]))
                    heapq.heappush(heap, (bound[self.right[node]], self.right[node]))
                else:
                    opened.append((self.first[node], self.last[node]))
                    many += opened[-1][1] - opened[-1][0]
            if opened:
                diff = np.concatenate([self.points[a:b] for a, b in opened]) - at
                pool_d = np.r_[pool_d, (diff * diff).sum(1)]
                pool_r = np.concatenate([pool_r, *(self.order[a:b] for a, b in opened)])
            due = heap[0][0] if heap else math.inf
            ready = pool_d <= due
            reach = stop * best_d[-1] ** 2 if len(best_d) == k else math.inf
            r = pool_r[ready & (pool_d < reach)]
            r = r[self.ids[r] != own]
            pool_d, pool_r = pool_d[~ready], pool_r[~ready]
            if len(r):
                diff = self.data[r] - query
                best_d, best_r = np.r_[best_d, np.sqrt((diff * diff).sum(1))], np.r_[best_r, r]
                pick = np.lexsort((self.ids[best_r], best_d))[:k]
                best_d, best_r = best_d[pick], best_r[pick]
            # rows left lie at `due` or beyond: would one as near as the kth have come up?
            if not heap and not len(pool_d) or len(best_d) == k and due >= stop * best_d[-1] ** 2:
                return best_r, best_d
            portion *= 2


def nearest_neighbours(df: DataFrame, queries: Column, k: int, confidence: float = CONFIDENCE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance): the k nearest found for
    each row where ``queries`` holds, among all other rows of its dimension; ties
    go to the smaller id. Every row is indexed.

    Rows with a null id, or a vector that is null, empty, zero or holds a null or
    non-finite component, take no part. Every row is a candidate, repeated ones each
    for itself, but for rows of the query's id; each of several query rows of an id gets
    its own k. Fewer rows than k give all; an empty table gives an empty result; more
    columns are not read."""
    rows = vectors.usable(df, queries, id_col, vector_col, nonzero=True)

    def build(ids: np.ndarray, data: np.ndarray) -> bytes:
        order, nodes = kd_tree(data @ projection(data.shape[1]))
        return order.astype(np.int64).tobytes() + nodes.tobytes()

    index = vectors.grouped(rows, vectors.BLOCK_ROWS, build, "trees")
    asked = vectors.grouped(rows.filter("asked"), vectors.QUERY_ROWS, None, "queries")
    stop = chi_square_quantile(confidence)

    def search(block: dict, ask: dict) -> pa.RecordBatch:
        ids, data = block["ids"], block["data"]
        n = len(ids)
        order = np.frombuffer(block["extra"], np.int64, n)
        nodes = np.frombuffer(block["extra"], np.float64, offset=8 * n).reshape(-1, 4 + 2 * DIMS)
        tree = Tree(data, ids, order, nodes)
        found = [tree.nearest(q, own, k, stop) for q, own in zip(ask["data"], ask["ids"].tolist())]
        many = [len(r) for r, _ in found]
        rows_ = np.concatenate([np.zeros(0, np.int64), *(r for r, _ in found)])
        score = np.concatenate([np.zeros(0), *(d for _, d in found)])
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(many)), many)), pa.array(np.repeat(ask["ids"], many)), pa.array(ids[rows_]), pa.array(score)], names=["asker", "query_id", "vec_id", "score"])

    return vectors.best(vectors.meet(index, asked, search, "query_id long, vec_id long, score double"), k, F.asc("score"))
