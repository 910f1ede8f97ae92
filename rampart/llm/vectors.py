"""Blocks of vectors for searches of a stated query set against all rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rampart.llm.common import materialize

BLOCK_ROWS = 16_384    # index rows in a block
QUERY_ROWS = 2_048     # queries that meet a block together
TASKS = 4_096          # at most, in which blocks meet


def usable(df: DataFrame, queries: Column, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """A written table (vec_id, v, asked) of the rows with an id and a vector of finite
    numbers; ``asked`` marks the queries."""
    v = F.col(vector_col).cast("array<double>")
    out = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    out = out.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~_bad(F.col("v")))
    if nonzero:
        out = out.filter(F.exists("v", lambda x: x != 0))
    return materialize(out, "vectors")


def _bad(v: Column) -> Column:
    return F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def grouped(vectors: DataFrame, rows: int, build: Callable[[np.ndarray, np.ndarray], bytes] | None, name: str,
            change: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """A written table of blocks of about ``rows`` vectors of one dimension:
    dim, block, ids and data (binary, float64 by rows, after ``change``), sorted by id, and what
    ``build(ids, data)`` adds (binary).

    Rows are dealt by their place in the written table, so that rows of one id
    or one vector, however many, spread over all blocks."""
    many = max(1, -(-vectors.count() // rows))
    extra = [] if build is None else ["extra"]
    schema = "dim int, block int, ids binary, data binary" + (", extra binary" if extra else "")

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        dim = table.column("dim")[0].as_py()
        data = table.column("v").combine_chunks().values.to_numpy().reshape(-1, dim)[order]
        if change is not None:
            data = change(data)
        row = {"dim": dim, "block": table.column("block")[0].as_py(), "ids": ids[order].tobytes(), "data": data.tobytes()}
        if build is not None:
            row["extra"] = build(ids[order], data)
        return pa.Table.from_pylist([row], pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("data", pa.binary())] + [(e, pa.binary()) for e in extra]))

    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    tagged = vectors.select(F.size("v").alias("dim"), F.pmod(place, F.lit(many)).cast("int").alias("block"), "vec_id", "v")
    return materialize(_dealt(tagged, many).groupBy("dim", "block").applyInArrow(pack, schema), name)


def _dealt(blocks: DataFrame, many: int) -> DataFrame:
    """Dealt by (dim, block) to a stated number of tasks, which are not put together again: blocks are work, not bytes."""
    return blocks.repartition(min(TASKS, 2 * max(many, blocks.sparkSession.sparkContext.defaultParallelism)), "dim", "block")


def meet(index: DataFrame, queries: DataFrame, search: Callable[[dict, dict], pa.RecordBatch], schema: str) -> DataFrame:
    """Run ``search`` on each index block with each query block of its dimension.

    The stated query set meets all rows, block by block: query blocks are copied, one to each
    index block of their dimension, and joined on the index block's number, so an index block is
    moved once at most and its meetings are spread over as many tasks as there are index blocks.
    ``search`` returns rows that begin with asker (long): the query's place in its block; the
    result has its block's number above that, which tells all queries of a dimension apart."""
    q = queries.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    numbers = index.groupBy("dim").agg(F.max("block").alias("last"))  # a row for each dimension
    copies = q.join(numbers, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    many = index.agg(F.max("block")).first()[0]  # None: no rows
    many = 0 if many is None else many + 1
    pairs = _dealt(index, many).join(_dealt(copies, many), ["dim", "block"])

    def run(batches):
        for b in batches:
            at = {c: b.column(c) for c in b.schema.names}
            for k in range(b.num_rows):
                dim = at["dim"][k].as_py()
                get = lambda c, t: np.frombuffer(at[c][k].as_buffer(), t)  # noqa: B023, E731
                found = search({"ids": get("ids", np.int64), "data": get("data", np.float64).reshape(-1, dim), "extra": at["extra"][k].as_buffer()},
                               {"ids": get("q_ids", np.int64), "data": get("q_data", np.float64).reshape(-1, dim)})
                asker = pa.array(found.column(0).to_numpy(zero_copy_only=False) + (at["q_block"][k].as_py() << 32))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(found.num_rows, dim, np.int32)), asker, *found.columns[1:]], names=["dim", *found.schema.names])

    return pairs.mapInArrow(run, f"dim int, asker long, {schema}")


def best(found: DataFrame, k: int, *order: Column) -> DataFrame:
    """query_id, rank, vec_id, score of each query row's first k, ties to smaller ids."""
    rank = F.row_number().over(Window.partitionBy("dim", "asker").orderBy(*order, F.asc("vec_id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
