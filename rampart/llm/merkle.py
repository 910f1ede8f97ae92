"""Merkle manifest of a dataset: trees of arity 16 over ordered leaves, with a witness a leaf.

Every tree's leaves are put in order over all partitions and dealt out as aligned blocks, complete
subtrees but for a tree's last one. A block is a stream of appends: a new node gets as partial witness its
run's earlier nodes, and extends the witnesses of these; a full run becomes a node that is appended a
level higher, so that all open subtrees grow together and share what stands above them. The
roots of blocks are further appends, to trees of blocks, and so on until each tree has one node. The trees'
roots, in order, are appended to one tree more. Then the witnesses go down again: those of a
level's nodes complete the ones of the blocks below.

A task holds one block (16**levels leaves) or, for the offsets, a row for each partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.llm.common import fresh, in_parts, materialize, rows_of
from rampart.session import plan_bytes

ARITY = 16
LEVELS = 3  # of a block: 4096 leaves
PART_BYTES = 4 << 20  # of what a task reads, at least, to write a part file

PROOF_TYPE = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))
PROOF_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf_digest(*fields: str | Column) -> Column:
    """H of the fields, each as its UTF-8 byte count, ``:`` and itself as text, or ``-`` if null."""

    def part(field: str | Column) -> Column:
        text = (F.col(field) if isinstance(field, str) else field).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of a proof give."""
    return F.aggregate(proof, leaf, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """H of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda level: F.concat(level["left"], level["right"])), ""), 256)


# ---- appending ---------------------------------------------------------------------


class Node:
    """A subtree with its witness so far: siblings before and after it in its run."""

    __slots__ = ("digest", "before", "after", "up")

    def __init__(self, digest: str):
        self.digest, self.after = digest, []
        self.before: list[str] = []
        self.up: Node | None = None


class Appender:
    """Open subtrees of a tree of ``height`` levels; nodes are appended left to right."""

    def __init__(self, height: int):
        self.height = height
        self.runs: list[list[Node]] = [[] for _ in range(height + 1)]

    def append(self, digest: str, level: int = 0) -> Node:
        node, run = Node(digest), self.runs[level]
        node.before = [n.digest for n in run]
        for n in run:
            n.after.append(digest)
        run.append(node)
        if len(run) == ARITY and level < self.height:
            self._complete(level)
        return node

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        digest = hashlib.sha256("".join(n.digest for n in run).encode()).hexdigest()
        up = self.append(digest, level + 1)
        for n in run:
            n.up = up

    def root(self) -> str:
        """Completes the open runs, lowest first."""
        for level in range(self.height):
            if self.runs[level]:
                self._complete(level)
        return self.runs[self.height][0].digest


def height_of(n: int, levels: int) -> int:
    """Levels of a block in a tree of ``n`` leaves: a tree ends where one node remains."""
    if n > ARITY ** levels:
        return levels
    h = 0
    while ARITY ** h < n:
        h += 1
    return h


def _grown(digests: list[str], n: int, levels: int) -> tuple[list[Node], str]:
    tree = Appender(height_of(n, levels))
    nodes = [tree.append(d) for d in digests]
    return nodes, tree.root()


# ---- over partitions ---------------------------------------------------------------


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def _placed(df: DataFrame, tree: list[str], order: list[Column], pos: str, n: str) -> DataFrame:
    """``df`` + the place of each row in its tree, from 0, and the tree's number of rows. Equal rows
    follow in any order."""
    spark = df.sparkSession
    mid, pid, first, tie = fresh(df, "_mid", "_pid", "_first", "_tie")
    parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [*(F.col(c).asc_nulls_first() for c in tree), *order, F.col(tie)]
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop(tie)
    # written with ids by partition and row, which every reader then sees alike; small partitions share a file, their ids stay
    ranged = in_parts(ranged.withColumn(mid, F.monotonically_increasing_id()), plan_bytes(df), PART_BYTES)
    ranged = materialize(ranged, "merkle-order").withColumn(pid, F.shiftright(mid, 33))
    units = ranged.groupBy(*tree, pid).agg(F.min(mid).alias(first), F.count(F.lit(1)).alias(n))  # a row for each partition and tree in it
    whole = Window.partitionBy(*tree)
    before = F.coalesce(F.sum(n).over(whole.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    units = units.select(*[F.col(c).alias(f"_u{i}") for i, c in enumerate([*tree, pid])], (before - F.col(first)).alias(first), F.sum(n).over(whole).alias(n))
    keys_of_unit = [f"_u{i}" for i in range(len(tree) + 1)]
    out = ranged.join(units, _same([*tree, pid], keys_of_unit)).withColumn(pos, F.col(first) + F.col(mid))
    return out.drop(*keys_of_unit, mid, pid, first)


def _blocks(nodes: DataFrame, tree: list[str], digest: str, pos: str, n: str, levels: int, name: str) -> DataFrame:
    """Written blocks of placed nodes: tree columns, block, n, root, and all rows in order (Arrow)."""
    kept = [c for c in nodes.columns if c not in (*tree, n)]
    schema = T.StructType([*(nodes.schema[c] for c in tree), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("root", T.StringType()), T.StructField("rows", T.BinaryType())])

    def close(table: pa.Table) -> pa.Table:
        table = table.sort_by(pos)
        total = table.column(n)[0].as_py()
        _, root = _grown(table.column(digest).to_pylist(), total, levels)
        rows = table.select(kept)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows)
        block = table.column(pos)[0].as_py() // ARITY ** levels
        return pa.Table.from_arrays([*(table.column(c).slice(0, 1) for c in tree), pa.array([block]), pa.array([total]), pa.array([root]), pa.array([sink.getvalue().to_pybytes()])], names=schema.names)

    (block,) = fresh(nodes, "_block")
    grouped = nodes.withColumn(block, F.expr(f"`{pos}` div {ARITY ** levels}")).groupBy(*tree, block)

    def strip(table: pa.Table) -> pa.Table:
        return close(table.drop_columns([block]))

    return materialize(grouped.applyInArrow(strip, schema), name)


def _witnessed(blocks: DataFrame, tree: list[str], rows: T.StructType, digest: str, levels: int, proof: str) -> DataFrame:
    """The rows of blocks (whose column ``upper`` is the block's own proof) with their proofs, after
    the tree's columns and ``carried`` ones."""
    carried = [c for c in blocks.columns if c not in ("block", "n", "rows", "upper")]
    schema = T.StructType([*(blocks.schema[c] for c in carried), *rows.fields, T.StructField(proof, PROOF_TYPE)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                row = next(rows_of([b.slice(k, 1).select(["n", "rows", "upper"])]))
                table = pa.ipc.open_stream(row["rows"]).read_all().combine_chunks()
                nodes, _ = _grown(table.column(digest).to_pylist(), row["n"], levels)
                proofs = _proofs(nodes, row["upper"] or [])
                own = [pa.concat_arrays([b.column(c).slice(k, 1)]).take(pa.array([0] * len(nodes))) for c in carried]
                yield from pa.Table.from_arrays([*own, *table.columns, proofs], names=schema.names).to_batches()

    return blocks.mapInArrow(run, schema)


def _proofs(nodes: list[Node], upper: list[dict]) -> pa.Array:
    """The witnesses of leaves up to the block's root, then ``upper``."""
    joined: dict[int, tuple[str, str]] = {}
    left: list[str] = []
    right: list[str] = []
    ends = [0]
    for leaf in nodes:
        node: Node | None = leaf
        while node is not None and node.up is not None:
            pair = joined.get(id(node))
            if pair is None:
                pair = joined[id(node)] = ("".join(node.before), "".join(node.after))
            left.append(pair[0])
            right.append(pair[1])
            node = node.up
        for level in upper:
            left.append(level["left"])
            right.append(level["right"])
        ends.append(len(left))
    levels = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), levels)


def _trees(placed: DataFrame, tree: list[str], digest: str, pos: str, n: str, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """(blocks of leaves, blocks of their roots, ...; the root of every tree)."""
    stages, roots = [], []
    nodes = placed
    while True:
        blocks = _blocks(nodes, tree, digest, pos, n, levels, f"merkle-blocks-{len(stages)}")
        stages.append(blocks)
        span = ARITY ** levels
        roots.append(blocks.filter(F.col("n") <= span).select(*tree, "root"))
        open_trees = blocks.filter(F.col("n") > span)
        if open_trees.isEmpty():
            return stages, reduce(DataFrame.unionByName, roots)
        nodes = open_trees.select(*tree, F.col("block").alias(pos), F.expr(f"(n + {span - 1}) div {span}").alias(n), F.col("root").alias(digest))


def _descend(stages: list[DataFrame], tops: DataFrame, tree: list[str], rows: T.StructType, digest: str, pos: str, levels: int, proof: str) -> DataFrame:
    """The leaves with proofs: ``tops`` (tree columns, further ones, ``upper``) are the trees' own proofs."""
    carried = [c for c in tops.columns if c not in (*tree, "upper")]
    t = [f"_t{i}" for i in range(len(tree))]
    span = ARITY ** levels
    upper: DataFrame | None = None  # of the nodes of the stage above: tree, place, proof
    tops = tops.select(*[F.col(c).alias(a) for c, a in zip(tree, t)], *carried, "upper")
    for k in reversed(range(len(stages))):
        blocks = stages[k].drop("root")
        whole = blocks.filter(F.col("n") <= span).join(tops, _same(tree, t)).drop(*t)
        if upper is None:
            ready = whole
        else:
            u = upper.select(*[F.col(c).alias(a) for c, a in zip(tree, t)], F.col(pos).alias("_pos"), *carried, F.col(proof).alias("upper"))
            parts = blocks.filter(F.col("n") > span).join(u, _same([*tree, "block"], [*t, "_pos"])).drop(*t, "_pos")
            ready = whole.unionByName(parts)
        fields = rows if k == 0 else T.StructType([T.StructField(pos, T.LongType()), T.StructField(digest, T.StringType())])
        upper = _witnessed(ready, tree, fields, digest, levels, proof)
    return upper


def manifest(df: DataFrame, tree_cols: list[str], order_cols: list[str], leaf_col: str = "leaf", levels: int = LEVELS) -> DataFrame:
    """``df`` + subroot, root and proof of every row.

    Rows with equal ``tree_cols`` (nulls are equal) form a tree, its leaves ``leaf_col``, hexadecimal text, in
    ascending order of ``order_cols`` (nulls first) and leaf. While a level has two nodes or more, every 16
    consecutive ones become H of their digests; what remains is ``subroot``. The subroots, in the order of
    ``tree_cols`` (nulls first, bytewise), likewise give ``root``. ``proof`` has a (left, right) of joined siblings
    for each level from leaf to root.

    Repeated rows are leaves of their own; a null leaf counts as empty text. A column that has the name of a new one is
    replaced. An empty table gives an empty one."""
    src = df.drop("subroot", "root", "proof")
    pos, n, digest = "_pos", "_n", "_digest"
    tree = [f"_tree{i}" for i in range(len(tree_cols))] or ["_tree0"]
    trees = {t: F.col(c) for t, c in zip(tree, tree_cols)} or {"_tree0": F.lit(0)}
    names = {c: f"c{i}" for i, c in enumerate(src.columns)}  # of the carried columns: none clashes
    leaves = src.select(*[e.alias(t) for t, e in trees.items()], F.coalesce(leaf_col, F.lit("")).alias(digest), *[F.col(c).alias(a) for c, a in names.items()])
    leaves = materialize(in_parts(leaves, plan_bytes(src), PART_BYTES), "merkle-leaves")
    order = [*(F.col(names[c]).asc_nulls_first() for c in order_cols), F.col(digest)]
    placed = _placed(leaves, tree, order, pos, n)
    stages, subroots = _trees(placed, tree, digest, pos, n, levels)
    # the tree of trees, whose order is theirs
    subroots = subroots.select(F.lit(0).alias("_all"), *tree, F.col("root").alias(digest), F.col("root").alias("subroot"))
    top_placed = _placed(subroots, ["_all"], [F.col(t).asc_nulls_first() for t in tree], pos, n)
    top_stages, top = _trees(top_placed, ["_all"], digest, pos, n, levels)
    tops = _descend(top_stages, top.withColumn("upper", F.array().cast(PROOF_TYPE)), ["_all"], _rows(top_placed, ["_all"], n), digest, pos, levels, "upper")
    tops = materialize(tops.select(*tree, "subroot", "root", "upper"), "merkle-tops")
    out = _descend(stages, tops, tree, _rows(placed, tree, n), digest, pos, levels, "proof")
    return out.select(*[F.col(a).alias(c) for c, a in names.items()], "subroot", "root", "proof")


def _rows(placed: DataFrame, tree: list[str], n: str) -> T.StructType:
    return T.StructType([f for f in placed.schema.fields if f.name not in (*tree, n)])
