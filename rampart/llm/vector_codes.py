"""Product codes of integer vectors; nearest entries are found by a GNAT over each codebook.

A vector's components become integers, the vector is cut into parts, and a part's code is the number of
the nearest entry of its codebook. Every round assigns all parts and moves each entry to the floor of its
parts' mean; tasks send sums, never vectors.

A GNAT (geometric near-neighbour access tree) holds entries: some of a node's are *split points*, each
further one belongs to the nearest split point's child, and for every split point and child
the range of distances between them is kept. A query measures its distance to the split points; where
that distance and the range say that all of a child is farther than the best entry so far,
the child is left out. Distances are rounded so that only what is strictly farther goes, and
entries are compared by their integer squared distances, ties by number.

Integers are exact at every size: while squared distances stay below 2**53 they are held in
doubles, beyond that in Python's integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rampart.llm.common import fresh, materialize

ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
SPLITS = 16       # split points of a node
LEAF = 48         # entries of a node that has no children
PORTION = 8_192   # vectors that are searched side by side
FAN_IN = 512      # sums that are added up in one group
SLACK = 1e-9      # relative, far above the rounding of a square root and two differences


# ---- integers ------------------------------------------------------------------------


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles, exactly: doubles if all fit, else Python's integers.
    ``scale`` is a power of two, so that the product is exact while it is finite."""
    with np.errstate(over="ignore"):
        out = np.floor(x * scale)
    if np.abs(out).max(initial=0) < 2.0**53:
        return out
    return np.array([math.floor(v * scale) if abs(v) < 2.0**900 else int(v) * scale for v in x.ravel().tolist()], object).reshape(x.shape)


def _fits(dim: int, *arrays: np.ndarray) -> bool:
    """Whether squared distances between rows of the arrays are exact in doubles."""
    most = max((int(np.abs(a).max(initial=0)) for a in arrays), default=0)
    return (2 * most) ** 2 * max(dim, 1) < 2**53


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact ones of all rows of x to all rows of y, doubles or Python's integers."""
    if x.dtype != object and y.dtype != object and _fits(x.shape[1], x, y):
        return (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)
    x, y = x.astype(object), y.astype(object)
    if x.dtype == object and not x.shape[1]:
        return np.zeros((len(x), len(y)), object)
    as_int = np.frompyfunc(int, 1, 1)
    x, y = as_int(x), as_int(y)
    return ((x[:, None, :] - y[None, :, :]) ** 2).sum(2)


def _below(sq: np.ndarray) -> np.ndarray:
    """No more than the square root."""
    return np.sqrt(sq) * (1 - SLACK) if sq.dtype != object else np.frompyfunc(math.isqrt, 1, 1)(sq)


def _above(sq: np.ndarray) -> np.ndarray:
    """No less than the square root."""
    return np.sqrt(sq) * (1 + SLACK) if sq.dtype != object else np.frompyfunc(lambda v: math.isqrt(v) + 1, 1, 1)(sq)


# ---- the tree ------------------------------------------------------------------------


class Gnat:
    """A node over ``entries``, different integer rows with ``numbers`` of their own."""

    def __init__(self, entries: np.ndarray, numbers: np.ndarray):
        chosen = self._split_points(entries)
        self.points, self.numbers = entries[chosen], numbers[chosen]
        rest = np.setdiff1d(np.arange(len(entries)), chosen)
        self.children: list[Gnat | None] = [None] * len(chosen)
        if not len(rest):
            return
        sq = squared_distances(self.points, entries)
        owner = np.argmin(sq[:, rest], 0)
        k = len(chosen)
        self.low, self.high = np.zeros((k, k), sq.dtype), np.zeros((k, k), sq.dtype)
        for j in range(k):
            own = rest[owner == j]
            if len(own):
                self.children[j] = Gnat(entries[own], numbers[own])
                d = sq[:, own]
                self.low[:, j], self.high[:, j] = _below(d.min(1)), _above(d.max(1))

    @staticmethod
    def _split_points(entries: np.ndarray) -> np.ndarray:
        """Entries far from each other: each the farthest from those before it."""
        if len(entries) <= LEAF:
            return np.arange(len(entries))
        chosen = [0]
        least = squared_distances(entries, entries[:1])[:, 0]
        while len(chosen) < SPLITS:
            chosen.append(int(np.argmax(least)))
            least = np.minimum(least, squared_distances(entries, entries[chosen[-1:]])[:, 0])
        return np.sort(chosen)

    def search(self, x: np.ndarray, best: np.ndarray, number: np.ndarray, rows: np.ndarray) -> int:
        """Lower ``best`` (squared) and ``number`` of the given rows of x where an entry here is nearer, or
        as near with a lower number. Returns how many distances were measured."""
        sq = squared_distances(x[rows], self.points)
        nearest = np.argmin(sq, 1)  # the first of equal ones has the lowest number
        least, first = sq[np.arange(len(rows)), nearest], self.numbers[nearest]
        better = (least < best[rows]) | (least == best[rows]) & (first < number[rows])
        best[rows[better]], number[rows[better]] = least[better], first[better]
        measured = sq.size
        if not any(self.children):
            return measured
        below, above = _below(sq), _above(sq)
        for own in (True, False):  # the nearest split point's child first: it lowers the best soonest
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                at = np.flatnonzero((nearest == j) == own)
                # any entry of the child is at least so far, by the triangle inequality
                bound = np.maximum((self.low[:, j] - above[at]).max(1), (below[at] - self.high[:, j]).max(1))
                near = rows[at][np.asarray(bound <= _above(best[rows[at]]), bool)]  # only what is strictly farther goes
                if len(near):
                    measured += child.search(x, best, number, near)
        return measured


class Codebook:
    """Entries of one part; of equal ones the lowest number stands for all."""

    def __init__(self, entries: np.ndarray):
        lowest: dict[tuple, int] = {}
        for k, row in enumerate(entries.tolist()):
            lowest.setdefault(tuple(map(int, row)), k)
        kept = np.array(sorted(lowest.values()))
        self.tree = Gnat(entries[kept], kept)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of each row's nearest entry, squared distance, measured distances)."""
        wide = x.dtype == object or not _fits(x.shape[1], x, *self._all(self.tree))
        best = np.full(len(x), np.inf)
        if wide:
            x, best = x.astype(object), best.astype(object)
        number = np.full(len(x), np.iinfo(np.int64).max)
        return number, best, self.tree.search(x, best, number, np.arange(len(x)))

    def _all(self, node: Gnat) -> list[np.ndarray]:
        return [node.points, *(a for c in node.children if c is not None for a in self._all(c))]


def cuts(dim: int) -> list[int]:
    """Bounds of PARTS consecutive parts of equal size; the first ones are longer where the
    dimension can't be divided."""
    return np.cumsum([0, *(dim // PARTS + (k < dim % PARTS) for k in range(PARTS))]).tolist()


# ---- over partitions -----------------------------------------------------------------


def usable(df: DataFrame, id_col: str, vector_col: str, group_col: str) -> DataFrame:
    """(vec_id, v, dim, group): rows whose vector is neither null nor holds null or non-finite components."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return df.select(F.col(id_col).alias("vec_id"), v.alias("v"), F.size(v).alias("dim"), F.col(group_col).alias("group")).filter(v.isNotNull() & ~bad)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """(rows, dimension, integer vectors) of up to PORTION rows of one dimension."""
    dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
    for dim in np.unique(dims).tolist():
        rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
        for a in range(0, rows.num_rows, PORTION):
            part = rows.slice(a, PORTION)
            flat = part.column(part.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
            yield part, dim, integers(flat.reshape(part.num_rows, dim))


Books = dict[int, list[np.ndarray]]  # by dimension: each part's entries, Python integers


def _trees(books: Books) -> dict[int, list[Codebook]]:
    def held(entries: np.ndarray) -> np.ndarray:
        return entries.astype(float) if _fits(entries.shape[1], entries) else entries

    return {dim: [Codebook(held(e)) for e in parts] for dim, parts in books.items()}


def _sums(vectors: DataFrame, books: Books) -> Iterator[tuple[int, int, int, int, list[int]]]:
    """(dimension, part, entry, count, sums by component) of all entries that are some part's
    nearest. A task gives one row a dimension; FAN_IN rows are added up at a time."""
    schema = "dim int, slot int, sums binary"

    def to_row(dim: int, slot: int, total: dict) -> pa.RecordBatch:
        text = "\n".join(f"{p} {e} {n} " + " ".join(map(str, s)) for (p, e), (n, s) in sorted(total.items()))
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([slot], pa.int32()), pa.array([text.encode()], pa.binary())], names=["dim", "slot", "sums"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trees = _trees(books)
        totals: dict[int, dict] = {}
        for b in batches:
            for _, dim, x in _portions(b):
                at = cuts(dim)
                for p, book in enumerate(trees[dim]):
                    part = x[:, at[p]:at[p + 1]]
                    number, _, _ = book.nearest(part)
                    order = np.argsort(number, kind="stable")
                    head = np.flatnonzero(np.r_[True, np.diff(number[order]) > 0])
                    count = np.diff(np.r_[head, len(order)])
                    # sums of doubles are exact: PORTION components below 2**26
                    small = part if part.dtype != object and np.abs(part).max(initial=0) < 2.0**26 else np.frompyfunc(int, 1, 1)(part.astype(object))
                    added = np.add.reduceat(small[order], head, axis=0) if part.shape[1] else np.zeros((len(head), 0))
                    for e, n, s in zip(number[order][head].tolist(), count.tolist(), added.tolist()):
                        _add(totals.setdefault(dim, {}), p, e, n, list(map(int, s)))
        for dim, total in totals.items():
            yield to_row(dim, TaskContext.get().partitionId() // FAN_IN, total)

    def add(table: pa.Table) -> pa.Table:
        total: dict = {}
        for blob in table.column("sums").to_pylist():
            for line in blob.decode().splitlines():
                p, e, n, *s = map(int, line.split())
                _add(total, p, e, n, s)
        return pa.Table.from_batches([to_row(table.column("dim")[0].as_py(), table.column("slot")[0].as_py() // FAN_IN, total)])

    rows = vectors.mapInArrow(run, schema)
    parts = vectors.rdd.getNumPartitions()
    while True:  # once for up to FAN_IN tasks, twice for up to its square, ...
        rows = rows.groupBy("dim", "slot").applyInArrow(add, schema)
        if parts <= FAN_IN:
            break
        parts = -(-parts // FAN_IN)
    for r in rows.collect():  # a row for each dimension: at most ENTRIES sums of PARTS parts
        for line in bytes(r["sums"]).decode().splitlines():
            p, e, n, *s = map(int, line.split())
            yield r["dim"], p, e, n, s


def _add(total: dict, p: int, e: int, n: int, s: list[int]) -> None:
    was = total.get((p, e))
    total[p, e] = (n, s) if was is None else (was[0] + n, [a + b for a, b in zip(was[1], s)])


def first_books(vectors: DataFrame) -> Books:
    """The parts of the ENTRIES first vectors of each dimension, by id (nulls last), then components."""
    order = Window.partitionBy("dim").orderBy(F.asc_nulls_last("vec_id"), "v")
    first = vectors.select("dim", "vec_id", "v").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ENTRIES)
    rows = sorted(first.collect(), key=lambda r: (r["dim"], r["rank"]))  # ENTRIES rows a dimension
    books: Books = {}
    for dim in sorted({r["dim"] for r in rows}):
        own = [r["v"] for r in rows if r["dim"] == dim]
        x = integers(np.array(own, float).reshape(len(own), dim))
        x = np.frompyfunc(int, 1, 1)(x.astype(object)) if x.size else x.astype(object)
        at = cuts(dim)
        books[dim] = [x[:, at[p]:at[p + 1]] for p in range(PARTS)]
    return books


def train(vectors: DataFrame, rounds: int = ROUNDS) -> Books:
    books = first_books(vectors)
    for _ in range(rounds if books else 0):
        moved = {dim: [p.copy() for p in parts] for dim, parts in books.items()}
        for dim, p, e, n, s in _sums(vectors, books):
            for i, total in enumerate(s):
                moved[dim][p][e, i] = total // n
        books = moved
    return books


def book_text(parts: list[np.ndarray]) -> str:
    """All entries' components by part, entry and place, joined by commas."""
    return ",".join(str(v) for p in parts for row in p.tolist() for v in row)


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """vec_id, group, dim, code, error, group_error and codebooks_sha256 of every usable row.

    Codebooks are learnt and used for each dimension on its own (vectors of several dimensions can't share one; their
    number is taken to be small). ``code`` has two hexadecimal digits a part, ``error`` the sum of squared distances
    and ``group_error`` its sum over equal groups of the dimension (nulls are equal); both are null where a long can't hold
    them. Repeated rows count as often as they stand there; rows with a null id are coded too, after all others
    among the first entries. A dimension that can't be divided by four has longer first parts, an empty vector
    the code of four entries 0. An empty table gives an empty one."""
    vectors = materialize(usable(df, id_col, vector_col, group_col), "vectors")
    books = train(vectors, rounds)
    digests = {dim: hashlib.sha256(book_text(parts).encode()).hexdigest() for dim, parts in books.items()}
    kept = ["vec_id", "group", "dim"]
    types = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in kept)
    fields = [*kept, "code", "error", "codebooks_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(books)
        for b in batches:
            for rows, dim, x in _portions(b):
                at = cuts(dim)
                found = [book.nearest(x[:, at[p]:at[p + 1]]) for p, book in enumerate(trees[dim])]
                codes = np.stack([f[0] for f in found], 1).astype(np.uint8)
                error = np.sum([f[1].astype(object) for f in found], 0)
                long = [int(e) if e < 2**63 else None for e in error.tolist()]
                yield pa.RecordBatch.from_arrays([
                    *(rows.column(rows.schema.get_field_index(c)) for c in kept), pa.array([row.tobytes().hex() for row in codes], pa.string()),
                    pa.array(long, pa.int64()), pa.array([digests[dim]] * rows.num_rows, pa.string())], names=fields)

    coded = materialize(vectors.mapInArrow(run, f"{types}, code string, error long, codebooks_sha256 string"), "vector-codes")
    # a row for each group; null where an error is, or where a long can't hold the sum
    total = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)"))).try_cast("long")
    g, d = fresh(coded, "_group", "_dim")
    sums = coded.groupBy(F.col("group").alias(g), F.col("dim").alias(d)).agg(total.alias("group_error"))
    out = coded.join(materialize(sums, "group-errors"), F.col("group").eqNullSafe(F.col(g)) & (F.col("dim") == F.col(d)))
    return out.select("vec_id", "group", "dim", "code", "error", "group_error", "codebooks_sha256")
