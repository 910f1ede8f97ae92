"""Exact top-k by inner product with Fagin's threshold algorithm.

Each block holds, for every dimension, its rows sorted by that component. A
query reads the lists from the end that its own component favours; rows that
come up are scored in full; the sum of its components times the values reached in
the lists bounds all rows not yet seen, and a query stops once that bound is below
its kth score. The lists of a block are read in steps for many queries together,
so that the full scores are matrix products over whole numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm import vectors

FIRST_DEPTH = 16
TOGETHER = 256  # queries that read the lists together


def sorted_lists(ids: np.ndarray, data: np.ndarray) -> bytes:
    """Row numbers by descending component, one list for each dimension."""
    return np.argsort(-data, axis=0, kind="stable").astype(np.int32).T.tobytes()


def products(queries: np.ndarray, rows: np.ndarray, whole: np.dtype) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles, as ``whole`` (:func:`range_of`)."""
    if whole == np.float64:
        return queries @ rows.T
    if whole == np.int64:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    # only pairs with a wide vector are multiplied as Python integers
    narrow_q, narrow_r = (np.abs(v).max(1, initial=0) <= math.isqrt(2**62 // v.shape[1]) for v in (queries, rows))
    out = np.empty((len(queries), len(rows)), object)
    out[np.ix_(narrow_q, narrow_r)] = (queries[narrow_q].astype(np.int64) @ rows[narrow_r].astype(np.int64).T).astype(object)
    for q, r in ((~narrow_q, narrow_r | ~narrow_r), (narrow_q, ~narrow_r)):
        if q.any() and r.any():
            out[np.ix_(q, r)] = _integers(queries[q]) @ _integers(rows[r]).T
    return out


def _integers(values: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(values)


def range_of(queries: np.ndarray, rows: np.ndarray) -> np.dtype:
    """The numbers that hold every inner product exactly: doubles, 64-bit or Python integers."""
    most = queries.shape[1] * int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0))
    return np.dtype(np.float64 if most < 2**53 else np.int64 if most < 2**62 else object)


def first_k(scores: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each line, ties to the smaller row; both (lines, k), in no order.
    A row of -1 marks no candidate; fewer than k candidates leave such marks."""
    if scores.shape[1] <= k:
        return scores, rows
    kth = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    line, col = np.nonzero(scores >= kth)
    if len(line) > k * len(scores):  # ties at the kth
        order = np.lexsort((rows[line, col], _descending(scores[line, col]), line))
        line, col = line[order], col[order]
        start = np.searchsorted(line, np.arange(len(scores)))
        keep = np.arange(len(line)) - start[line] < k
        line, col = line[keep], col[keep]
    return scores[line, col].reshape(-1, k), rows[line, col].reshape(-1, k)


def _descending(scores: np.ndarray) -> np.ndarray:
    if scores.dtype != object:
        return -scores
    return -np.unique(scores, return_inverse=True)[1]


def threshold_search(ids: np.ndarray, data: np.ndarray, lists: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query place, row, score) of each query's k best rows in the block, and how
    many rows were scored. ``data`` and ``queries`` hold whole numbers; rows are
    sorted by id; rows of a query's own id are no candidates. Scores are exact
    integers of numpy, or of Python where 64 bits may not hold them."""
    n, dim = data.shape
    top_values = np.take_along_axis(data.T, lists.astype(np.int64), 1)
    whole = range_of(queries, data)
    none = -np.inf if whole != np.int64 else -np.iinfo(np.int64).max  # below every score
    scored = 0
    out_q, out_r, out_s = [], [], []
    for start in range(0, len(queries), TOGETHER):
        q = queries[start:start + TOGETHER]
        own = q_ids[start:start + TOGETHER]
        place = np.arange(start, start + len(q))
        seen = np.zeros(n, bool)
        scores, rows = np.full((len(q), k), none, whole), np.full((len(q), k), -1)
        depth, before = min(FIRST_DEPTH, n), 0
        while len(q):
            new = np.unique(np.concatenate([lists[:, before:depth].ravel(), lists[:, n - depth:n - before].ravel()]))
            new = new[~seen[new]]
            seen[new] = True
            scored += len(new) * len(q)
            if len(new):
                score = products(q, data[new], whole)
                row = np.broadcast_to(new, score.shape)
                mine = ids[new][None, :] == own[:, None]
                if mine.any():
                    score, row = np.where(mine, none, score), np.where(mine, -1, row)
                scores, rows = first_k(np.concatenate([scores, score.astype(whole)], axis=1), np.concatenate([rows, row], axis=1), k)
            done = np.full(len(q), seen.all())
            if not done.all() and whole != object:
                # what the lists have reached bounds every unseen row; from 2**53 on, with more than doubles round off
                high, low = top_values[:, depth - 1], top_values[:, n - depth]
                reach = np.maximum(q * high, q * low)
                slack = 0 if whole == np.float64 else 1e-12 * np.abs(reach).sum(1)
                done = (rows >= 0).all(1) & (scores.min(1) > reach.sum(1) + slack)
            if done.any():
                line, col = np.nonzero(rows[done] >= 0)
                out_q.append(place[done][line])
                out_s.append(scores[done][line, col])
                out_r.append(rows[done][line, col])
                q, own, place, scores, rows = q[~done], own[~done], place[~done], scores[~done], rows[~done]
            before, depth = depth, min(n, depth * 4)
    empty = np.zeros(0, np.int64)
    score = np.concatenate([empty.astype(object if whole == object else np.int64), *(s if whole == object else s.astype(np.int64) for s in out_s)])
    return np.concatenate([empty, *out_q]), np.concatenate([empty, *out_r]), score, scored


def as_long(scores: np.ndarray) -> tuple[np.ndarray, list[bytes | None]]:
    """(longs, keys): a score outside the range of a long becomes its nearest end, and has a
    key; keys of one end ascend with the scores."""
    if scores.dtype != object:
        return scores, [None] * len(scores)
    top = 2**63 - 1

    def key(s: int) -> bytes | None:
        if abs(s) <= top:
            return None
        size = -(-abs(s).bit_length() // 8)
        key = size.to_bytes(2, "big") + abs(s).to_bytes(size, "big")
        return key if s > 0 else bytes(255 - b for b in key)

    return np.array([max(-top - 1, min(top, s)) for s in scores], np.int64), [key(s) for s in scores]


def top_inner_products(df: DataFrame, queries: Column, k: int, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of
    floor(scale * component) for each row where ``queries`` holds, against all
    other rows of its dimension; ties go to the smaller id.

    Products and ranks are exact for all finite components. A score outside the range of a
    long is shown as that range's nearest end, and ranked by its exact value; blocks with such vectors
    read all rows. Rows with a null id, a null or empty vector, or a component that is null or not finite
    (or so large that scale times it isn't) take no part. Every row is a candidate, repeated ones each for
    itself, but for rows of the query's id; each of several query rows of an id gets its own k. An empty
    table gives an empty result; more columns are not read."""
    finite = F.forall(F.col(vector_col).cast("array<double>"), lambda x: F.abs(x * scale) < F.lit(float("inf")))
    rows = vectors.usable(df.filter(finite), queries, id_col, vector_col, nonzero=False)
    whole = lambda data: np.floor(data * scale)
    index = vectors.grouped(rows, vectors.BLOCK_ROWS, sorted_lists, "lists", whole)
    asked = vectors.grouped(rows.filter("asked"), vectors.QUERY_ROWS, None, "queries", whole)

    def search(block: dict, ask: dict) -> pa.RecordBatch:
        n, dim = block["data"].shape
        lists = np.frombuffer(block["extra"], np.int32).reshape(dim, n)
        place, row, score, _ = threshold_search(block["ids"], block["data"], lists, ask["ids"], ask["data"], k)
        score, wide = as_long(score)
        return pa.RecordBatch.from_arrays([pa.array(place), pa.array(ask["ids"][place]), pa.array(block["ids"][row]), pa.array(score), pa.array(wide, pa.binary())],
                                          names=["asker", "query_id", "vec_id", "score", "wide"])

    found = vectors.meet(index, asked, search, "query_id long, vec_id long, score long, wide binary")
    # keys of the upper end are above its own score, which has none; those of the lower end below theirs
    wide = F.when(F.col("score") < 0, F.coalesce("wide", F.lit(b"\xff\xff\xff"))).otherwise(F.coalesce("wide", F.lit(b"")))
    return vectors.best(found, k, F.desc("score"), wide.desc())
