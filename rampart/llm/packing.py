"""Best-fit packing by linear grouping.

Only the histogram of lengths (at most ``capacity`` rows) reaches the driver.
There the large lengths are rounded up within groups of equal cardinality, a
configuration program over the few rounded sizes is optimised by column
generation, its slots are filled with the actual lengths, and what is left goes
in by best fit, longest first. Sequences of one composition are handled as one
class with a multiplicity, so the work and the plan depend on the capacity, not
on the number of documents. Items find their place by their rank within their
length, counted in salted groups, so that a common length splits over tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.llm.bpe import bpe_encode
from rampart.llm.common import materialize

GROUPS = 64
ROWS_A_GROUP = 20_000  # aimed at, in a (length, salt) group


def _best_column(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity (knapsack, by number of items)."""
    best = np.zeros(capacity + 1)
    picks: list[np.ndarray] = []
    for _ in range(capacity // int(sizes.min())):
        new, pick = best.copy(), np.full(capacity + 1, -1)
        for g, s in enumerate(sizes):
            if values[g] > 0:
                with_g = np.full(capacity + 1, -1.0)
                with_g[s:] = best[: capacity + 1 - s] + values[g]
                better = with_g > new + 1e-12
                new[better], pick[better] = with_g[better], g
        if (pick < 0).all():
            break
        best = new
        picks.append(pick)
    column, room = np.zeros(len(sizes)), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            column[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(values @ column), column


def configurations(sizes: np.ndarray, need: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations with whole multiplicities: the linear program's optimum, rounded down."""
    k = len(sizes)
    columns = np.diag((capacity // sizes).astype(float))
    for _ in range(rounds):
        inverse = np.linalg.inv(columns)
        x = inverse @ need
        value, column = _best_column(inverse.sum(0), sizes, capacity)  # dual values price the columns
        if value <= 1 + 1e-7:
            break
        step = inverse @ column
        ratio = np.where(step > 1e-9, np.maximum(x, 0) / np.where(step > 1e-9, step, 1), np.inf)
        columns[:, int(ratio.argmin())] = column
    x = np.linalg.solve(columns, need)
    return [(columns[:, j].astype(int), int(np.floor(max(0.0, x[j]) + 1e-9))) for j in range(k)]


def plan_packing(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> pd.DataFrame:
    """Rows (length, first_rank, per, first_sequence, offset): the items of that
    length from ``first_rank`` on go, ``per`` to each sequence, to the sequences
    from ``first_sequence`` on, from ``offset`` on. A row holds until the next
    row's rank of the same length."""
    if any(not 0 < n <= capacity for n in histogram):
        raise ValueError("lengths must lie between 1 and the capacity")
    left = {n: c for n, c in histogram.items() if c}
    open_: list[list] = [[] for _ in range(capacity + 1)]  # by room left: (multiplicity, composition)
    mask = 0  # bit r: open_[r] has a class

    def put(room: int, many: int, parts) -> None:
        nonlocal mask
        if many:
            open_[room].append((many, parts))
            mask |= 1 << room

    large = sorted((n for n in left if capacity // 8 <= n < capacity), reverse=True)
    total = sum(left[n] for n in large)
    if total:
        # groups of equal cardinality, each a queue of (length, count) from its largest
        queues: list[list[list[int]]] = [[]]
        size, room = -(-total // groups), -(-total // groups)
        for n in large:
            c = left.pop(n)
            while c:
                if not room:
                    queues.append([])
                    room = size
                t = min(c, room)
                queues[-1].append([n, t])
                c, room = c - t, room - t
        merged: list[list[list[int]]] = []  # groups that round up to one size are one
        for q in queues:
            if merged and merged[-1][0][0] == q[0][0]:
                merged[-1] += q
            else:
                merged.append(q)
        sizes = np.array([q[0][0] for q in merged])
        need = np.array([sum(c for _, c in q) for q in merged], float)
        for config, many in sorted(configurations(sizes, need, capacity), key=lambda x: -x[1]):
            # substitute the actual lengths for the rounded ones, slot by slot
            classes = [(many, capacity, None)] if many else []
            for g, times in enumerate(config):
                for _ in range(times):
                    filled = []
                    for m, room_left, parts in classes:
                        while m and merged[g]:
                            n, c = merged[g][0]
                            t = min(m, c)
                            filled.append((t, room_left - n, (parts, n, 1)))
                            m -= t
                            merged[g][0][1] -= t
                            if not merged[g][0][1]:
                                merged[g].pop(0)
                        if m:
                            filled.append((m, room_left, parts))
                    classes = filled
            for m, room_left, parts in classes:
                put(room_left, m, parts)
        for q in merged:
            for n, c in q:
                left[n] = left.get(n, 0) + c
    for n in sorted(left, reverse=True):
        c = left[n]
        while c:
            fit = mask >> n
            if not fit:  # new sequences of this length alone
                per = capacity // n
                put(capacity - per * n, c // per, (None, n, per))
                if c % per:
                    put(capacity - c % per * n, 1, (None, n, c % per))
                break
            room = n + (fit & -fit).bit_length() - 1
            m, parts = open_[room].pop()
            per = room // n
            full, rest = (m, 0) if c >= m * per else divmod(c, per)
            c -= full * per + rest
            back = m - full - (rest > 0)
            if not open_[room]:
                mask &= ~(1 << room)
            put(room - per * n, full, (parts, n, per))
            if rest:
                put(room - rest * n, 1, (parts, n, rest))
            put(room, back, parts)
    out, sequence, ranks = [], 0, dict.fromkeys(histogram, 0)
    for classes in open_:
        for many, parts in classes:
            offset = 0
            while parts:
                parts, n, per = parts
                out.append((n, ranks[n], per, sequence, offset))
                ranks[n] += many * per
                offset += n * per
            sequence += many
    plan = pd.DataFrame(out, columns=["length", "first_rank", "per", "first_sequence", "offset"], dtype="int64")
    return plan.sort_values(["length", "first_rank"], ignore_index=True)


def best_fit_pack(items: DataFrame, capacity: int, length_col: str = "length", order: tuple[str, ...] = ("doc_id", "piece"),
                  groups: int = GROUPS) -> DataFrame:
    """Add sequence_id and offset to every row of ``items`` (a written table).

    Lengths must lie between 1 and ``capacity``. Equal rows, null keys among
    them, each get a place of their own; an empty table gives an empty one;
    columns named sequence_id or offset raise ValueError. Which of several
    items of one length takes which of their places follows ``order``."""
    if {"sequence_id", "offset"} & set(items.columns):
        raise ValueError("items already have a column sequence_id or offset")
    histogram = {r["n"]: r["c"] for r in items.groupBy(F.col(length_col).alias("n")).agg(F.count("*").alias("c")).collect()}
    salts = max(1, -(-max(histogram.values(), default=1) // ROWS_A_GROUP))
    plan = plan_packing(histogram, capacity, groups)
    keys = plan["length"].to_numpy() * (1 << 44) + plan["first_rank"].to_numpy()
    per, seq, off, first = (plan[c].to_numpy() for c in ("per", "first_sequence", "offset", "first_rank"))
    salted = items.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    before = Window.partitionBy("_n").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    counts = (salted.groupBy(F.col(length_col).alias("_n"), F.col("_salt").alias("_s")).agg(F.count("*").alias("_c"))
              .select("_n", "_s", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before")))
    ranked = (salted.join(counts, (F.col(length_col) == F.col("_n")) & (F.col("_salt") == F.col("_s")))
              .withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy("_n", "_s").orderBy(*order)) - 1)
              .drop("_n", "_s", "_before", "_salt"))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, r = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in (length_col, "_rank"))
            at = np.searchsorted(keys, n * (1 << 44) + r, side="right") - 1
            k, within = np.divmod(r - first[at], per[at]) if len(at) else (r, r)
            cols = [c for name, c in zip(b.schema.names, b.columns) if name != "_rank"]
            fields = [f for f in b.schema if f.name != "_rank"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq[at] + k, pa.int64()), pa.array(off[at] + within * n, pa.int64())],
                                             schema=pa.schema([*fields, ("sequence_id", pa.int64()), ("offset", pa.int64())]))

    return ranked.mapInArrow(place, T.StructType(list(items.schema.fields)).add("sequence_id", "long").add("offset", "long"))


def cut_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids (binary) of every document's pieces.

    A document is its ids (none for a null text), then ``end_id``; only longer
    ones than ``capacity`` are cut."""
    src = bpe_encode(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), path).select("doc_id", "ids")
    ids = F.concat("ids", F.lit(int(end_id).to_bytes(4, "little")))
    cut = src.select("doc_id", ids.alias("ids"), (F.length("ids") / 4 + 1).cast("int").alias("n"))
    cut = cut.select("doc_id", "ids", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity).cast("int"))).alias("piece"))
    part = F.substring(F.col("ids"), F.col("piece") * (4 * capacity) + 1, F.lit(4 * capacity))
    return cut.select("doc_id", "piece", (F.col("piece") * F.lit(capacity)).cast("long").alias("start"), part.alias("ids")) \
        .select("doc_id", "piece", "start", (F.length("ids") / 4).cast("long").alias("length"), "ids")


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut and pack all documents: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset, one row for each piece."""
    pieces = cut_pieces(docs, path, capacity, end_id, id_col, text_col)
    pieces = materialize(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return best_fit_pack(pieces, capacity)
