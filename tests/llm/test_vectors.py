import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rampart.llm import ann, topk, vectors


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score double, rank int")


@pytest.fixture
def odd_vectors(spark):
    r = np.random.default_rng(0)
    rows = [(i, [float(x) for x in np.round(r.standard_normal(6), 1)], 1, None, None) for i in range(240)]
    rows += [(400 + i, rows[i][1], None, 1.0, 1) for i in range(0, 100, 5)]      # ties
    rows += [rows[0], rows[20]]                                                 # repeated rows
    rows += [(500, None, 1, None, None), (520, [], 1, None, None), (540, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, None, None), (None, rows[3][1], 1, None, None),
             (560, [math.nan] * 6, 1, None, None), (580, [math.inf] + [0.0] * 5, 1, None, None), (600, [0.0] * 6, 1, None, None), (620, [1.0, 2.0], 1, None, None)]
    return table(spark, rows).repartition(3)


def usable(rows, zero):
    """(id, vector) of each row that takes part, repeated ones too."""
    out = []
    for r in rows:
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            out.append((r["vec_id"], np.array(v, float)))
    return out


def brute_products(rows, scale, every, k):
    """Each query row's k best by Python's integers."""
    v = [(i, [math.floor(scale * c) for c in x.tolist()]) for i, x in usable(rows, True)]
    want = []
    for q, x in v:
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in v if i != q and len(x) == len(y))[:k]
            want += [(q, n, i, max(-2**63, min(2**63 - 1, -s))) for n, (s, i) in enumerate(found, 1)]
    return sorted(want)


@pytest.mark.parametrize("block", [17, 16_384])
def test_top_inner_products_are_brute_force(odd_vectors, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 5)
    got = [tuple(r) for r in topk.top_inner_products(odd_vectors, F.col("vec_id") % 20 == 0, 9).collect()]
    assert sorted(got) == brute_products(odd_vectors.collect(), 64, 20, 9)


@pytest.mark.parametrize("size", [1e3, 1e6, 1e8, 1e9, 1e12, 3e30, 1e300])
@pytest.mark.parametrize("block", [19, 16_384])
def test_large_components_and_repeated_ids_are_exact(spark, monkeypatch, size, block):
    """Scores beyond 2**53 and beyond a long, next to small ones; ids that several vectors share."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 7)
    r = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in r.standard_normal(5) * (size if r.random() < 0.6 else 3)], None, None, None) for i in r.integers(0, 60, 90)]
    rows += [(100 + i, [size, size, size + (i % 3) * size / 2**20, -size, 1.0], None, None, None) for i in range(12)]  # near ties
    rows += [(200 + i, rows[95][1], None, None, None) for i in range(8)] + rows[:4]
    rows.append((300, [1.7e308, 0.0, 0.0, 0.0, 0.0], None, None, None))  # 64 times it is not finite
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score double, rank int").repartition(2)
    got = sorted(tuple(x) for x in topk.top_inner_products(df, F.col("vec_id") % 10 == 0, 6).collect())
    assert got == brute_products([x for x in df.collect() if x["vec_id"] != 300], 64, 10, 6)


def test_long_range_keys_keep_the_order():
    scores = [2**63 - 1, 2**63, 2**64 + 1, 2**200, -2**63 + 1, -2**63, -2**63 - 1, -2**90, 0, 5]
    longs, keys = topk.as_long(np.array(scores, object))
    order = sorted(range(len(scores)), key=lambda i: (longs[i], keys[i] if keys[i] is not None else (b"\xff\xff\xff" if longs[i] < 0 else b"")))
    assert [scores[i] for i in order] == sorted(scores)


def test_blocks_meet_in_many_tasks(spark, odd_vectors, monkeypatch):
    """One exchange of the index, dealt by its blocks, that adaptive execution doesn't put together."""
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 30)
    rows = vectors.usable(odd_vectors, F.col("vec_id") % 20 == 0, "vec_id", "embedding", nonzero=False)
    index = vectors.grouped(rows, 30, topk.sorted_lists, "lists")
    asked = vectors.grouped(rows.filter("asked"), 10, None, "queries")
    met = vectors.meet(index, asked, None, "query_id long")
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and "Join Inner, ((dim" in plan and "Cross" not in plan


def test_threshold_search_stops_early():
    r = np.random.default_rng(3)
    data = np.zeros((4000, 4))
    data[np.arange(4000), r.integers(0, 4, 4000)] = np.round(r.pareto(1.2, 4000) * 50)
    lists = np.frombuffer(topk.sorted_lists(np.arange(4000), data), np.int32).reshape(4, -1)
    queries = np.array([[5.0, 1, 0, 0], [-3, 0, 0, 7]])
    place, row, score, scored = topk.threshold_search(np.arange(4000), data, lists, np.array([-1, -2]), queries, 5)
    assert scored < 4000
    for q in range(2):
        all_scores = data @ queries[q]
        assert sorted(zip(-score[place == q], row[place == q])) == sorted(zip(-all_scores, range(4000)))[:5]


def test_neighbours_of_odd_vectors(odd_vectors, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 60)
    got = ann.nearest_neighbours(odd_vectors, F.col("vec_id") % 20 == 0, 10, confidence=0.9999).collect()
    v = usable(odd_vectors.collect(), False)
    hits = total = 0
    for q in sorted({i for i, _ in v if i % 20 == 0}):
        mine = [x for i, x in v if i == q]  # equal ones here: each row has an answer of its own
        found = sorted((float(np.sqrt(((mine[0] - x) ** 2).sum())), i) for i, x in v if i != q and len(x) == len(mine[0]))[:10]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in own] == sorted(list(range(1, len(found) + 1)) * len(mine))
        own = own[::len(mine)]
        assert all(min(abs(s - float(np.sqrt(((mine[0] - x) ** 2).sum()))) for j, x in v if j == i) < 1e-12 for _, i, s in own)
        assert [(s, i) for _, i, s in own] == sorted((s, i) for _, i, s in own)
        hits += len({i for _, i, _ in own} & {i for _, i in found})
        total += len({i for _, i in found})
    assert hits >= 0.99 * total


def test_recall_on_the_given_vectors(spark):
    sf = "/root/testdata/sf0.01"
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = df.collect()
    ids, data = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in ann.nearest_neighbours(df, F.col("vec_id") % 10 == 0, 10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, mine in got.items():
        d = np.sqrt(((data - data[ids == q]) ** 2).sum(1))
        order = [i for i in ids[np.lexsort((ids, d))] if i != q][:10]
        hits += len(mine & set(order))
    assert hits >= 0.9 * 10 * len(got) and len(got) == (ids % 10 == 0).sum()


def test_chi_square_law():
    r = np.random.default_rng(5)
    x = (r.standard_normal((200_000, ann.DIMS)) ** 2).sum(1)
    for p in (0.1, 0.5, 0.95):
        assert (x <= ann.chi_square_quantile(p)).mean() == pytest.approx(p, abs=0.01)


def test_empty_tables(spark):
    empty = table(spark, [])
    assert ann.nearest_neighbours(empty, F.col("vec_id") % 2 == 0, 3).count() == 0
    assert topk.top_inner_products(empty, F.col("vec_id") % 2 == 0, 3).count() == 0
    one = table(spark, [(2, [1.0, 2.0], None, None, None)])
    assert ann.nearest_neighbours(one, F.col("vec_id") % 2 == 0, 3).count() == 0
