import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rampart.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """(root, proof of every leaf as (left, right) a level), straight from the definition."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + 16] for k in range(0, len(nodes), 16)]
        for i, p in enumerate(at):
            run, place = runs[p // 16], p % 16
            proofs[i].append(("".join(run[:place]), "".join(run[place + 1:])))
        at = [p // 16 for p in at]
        nodes = [H(*run) for run in runs]
    return nodes[0], proofs


def brute(rows):
    """rows: (source, doc_id, leaf) -> for each (in order) subroot, root, proof."""
    first = lambda v: (v is not None, v if v is not None else 0)
    by = {}
    for s, d, leaf in rows:
        by.setdefault(s, []).append((first(d), leaf, d))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for _, leaf, _ in sorted(by[s], key=lambda x: x[:2])]) for s in sources}
    root, tops = tree([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops):
        for (_, leaf, d), proof in zip(sorted(by[s], key=lambda x: x[:2]), trees[s][1]):
            out.append((s, d, leaf, trees[s][0], root, proof + top))
    return out


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_is_the_definition(spark, levels):
    rng = random.Random(1)
    sizes = {None: 1, "a": 1, "b": 16, "é": 17, "Z": 300, "c": 256, "d": 257, "": 2} | {f"s{i}": rng.randint(1, 40) for i in range(25)}
    rows = [(s, rng.randrange(10_000) if rng.random() < 0.95 else None, H(str(rng.random()))) for s, n in sizes.items() for _ in range(n)]
    rows += [rows[5], rows[5], (rows[5][0], rows[5][1], H("other"))]  # repeated rows and ids
    df = spark.createDataFrame([(d, s, leaf, "x", 1) for s, d, leaf in rows], "doc_id long, source string, leaf string, root string, block int").repartition(7)
    got = merkle.manifest(df, ["source"], ["doc_id"], levels=levels)
    assert got.columns == ["doc_id", "source", "leaf", "block", "subroot", "root", "proof"]  # a clashing column is replaced
    found = [(r["source"], r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["proof"]]) for r in got.collect()]
    assert sorted(found, key=str) == sorted(brute(rows), key=str)
    ok = got.select(merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root"), merkle.folded(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).collect()
    assert {tuple(r) for r in ok} == {(True, False)}


def test_one_hot_tree_over_many_blocks(spark):
    n = 5000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    got = merkle.manifest(df, [], ["doc_id"], levels=2).collect()
    root, proofs = tree([H(str(i)) for i in range(n)])
    assert {r["root"] for r in got} == {root} == {r["subroot"] for r in got}
    assert {r["doc_id"]: [tuple(p) for p in r["proof"]] for r in got} == dict(enumerate(proofs))


def test_many_small_partitions_are_written_as_few_files(spark, monkeypatch):
    files, write = {}, merkle.materialize

    def counted(df, name, *rest):
        out = write(df, name, *rest)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(merkle, "materialize", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        df = spark.range(0, 2000, 1, 64).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
        got = merkle.manifest(df, ["source"], ["doc_id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(files["merkle-leaves"], files["merkle-order"]) <= 12
    proofs = [p for s in range(3) for p in tree([H(str(i)) for i in range(s, 2000, 3)])[1]]
    found = sorted(got, key=lambda r: (r["source"], r["doc_id"]))
    assert [[tuple(x) for x in r["proof"]][:3] for r in found] == proofs


def test_appended_nodes_extend_open_witnesses():
    t = merkle.Appender(2)
    first = t.append("a")
    assert (first.before, first.after, first.up) == ([], [], None)
    second = t.append("b")
    assert (first.after, second.before) == (["b"], ["a"])
    for i in range(14):
        t.append(str(i))
    assert first.up is second.up and first.up.digest == H("a", "b", *map(str, range(14))) and first.up.after == []
    for i in range(16):
        t.append(str(i))
    assert first.up.after == [H(*map(str, range(16)))]


def test_leaf_digests_and_odd_documents(spark, odd_docs, no_docs):
    fields = ["doc_id", "source", "lang", "text"]
    leaves = odd_docs.withColumn("leaf", merkle.leaf_digest(*fields)).drop("text")
    rows = odd_docs.collect()
    want = [(r["source"], r["doc_id"], H(*(field(r[c]) for c in fields))) for r in rows]
    got = merkle.manifest(leaves, ["source"], ["doc_id"]).collect()
    assert sorted(((r["source"], r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["proof"]]) for r in got), key=str) == sorted(brute(want), key=str)
    empty = merkle.manifest(no_docs.withColumn("leaf", F.lit("x")), ["source"], ["doc_id"])
    assert empty.collect() == [] and empty.columns[-3:] == ["subroot", "root", "proof"]


def test_null_leaf_is_empty_text(spark):
    got = merkle.manifest(spark.createDataFrame([(1, None)], "doc_id long, leaf string"), [], ["doc_id"]).collect()
    assert [tuple(r) for r in got] == [(1, None, "", "", [])]
