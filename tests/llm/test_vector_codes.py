import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rampart.llm import vector_codes as vc


def sq(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def brute(rows):
    """{vec_id: (code, error, label_error, sha)} from the definition; rows: (id, vector, label) of one dimension."""
    kept = sorted(((i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    dim = len(kept[0][1])
    at = vc.cuts(dim)
    x = [[math.floor(Fraction(c) * 1024) for c in v] for _, v, _ in kept]
    parts = [[v[at[p]:at[p + 1]] for v in x] for p in range(4)]
    books = [[list(v) for v in part[:256]] for part in parts]
    near = lambda p, v: min(range(len(books[p])), key=lambda e: (sq(books[p][e], v), e))
    for _ in range(4):
        for p in range(4):
            owner = [near(p, v) for v in parts[p]]
            moved = [list(e) for e in books[p]]
            for e in set(owner):
                own = [v for v, o in zip(parts[p], owner) if o == e]
                moved[e] = [sum(c) // len(own) for c in zip(*own)]
            books[p] = moved
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    codes = [[near(p, parts[p][k]) for p in range(4)] for k in range(len(kept))]
    errors = [sum(sq(books[p][codes[k][p]], parts[p][k]) for p in range(4)) for k in range(len(kept))]
    out = []
    for (i, _, g), c, e in zip(kept, codes, errors):
        whole = sum(err for (_, _, h), err in zip(kept, errors) if h == g)
        out.append((i, "".join(f"{n:02x}" for n in c), e if e < 2**63 else None, whole if whole < 2**63 else None, sha))
    return out


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(i, v, g, "x", 1) for i, v, g in rows], "vec_id long, embedding array<double>, label int, code string, error int").repartition(parts)
    return sorted((tuple(r) for r in vc.compress(df).select("vec_id", "code", "error", "group_error", "codebooks_sha256").collect()), key=str)


def rows_of(n, dim, seed, spread=1.0):
    r = random.Random(seed)
    centres = [[r.gauss(0, spread) for _ in range(dim)] for _ in range(7)]
    return [(i, [c + r.gauss(0, spread / 8) for c in r.choice(centres)], r.choice([0, 1, 2, None])) for i in range(n)]


def test_codes_are_the_definition(spark):
    rows = rows_of(400, 12, 1)
    rows += [(1000 + k, [0.001 * (k % 2)] * 12, 1) for k in range(30)]                     # ties
    rows += [rows[7], rows[7], (None, rows[9][1], 2), (7, rows[11][1], None)]               # repeated rows and ids
    rows += [(2000, None, 1), (2001, [1.0] * 11 + [None], 1), (2002, [math.nan] * 12, 1), (2003, [math.inf] + [0.0] * 11, None)]
    random.Random(2).shuffle(rows)
    assert run(spark, rows) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("size", [1e9, 1e120, 1.6e308])
def test_large_finite_components_are_exact(spark, size):
    rows = [(i, [size * (k + 1) / (i % 5 + 1) * (-1) ** i for k in range(4)], 0) for i in range(12)] + [(90, [0.5, -0.25, 3.0, 0.0], 1)]
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_few_rows_other_dimensions_and_empty_tables(spark):
    assert run(spark, []) == []
    one = [(5, [0.5, -0.5, 0.25], None)]                      # three components: the last part is empty
    assert run(spark, one) == sorted(brute(one), key=str)
    mixed = rows_of(40, 8, 3)
    other = [(100 + i, v, g) for i, v, g in rows_of(30, 4, 4)] + [(500, [], 1)]
    got = {r[0]: r for r in run(spark, mixed + other)}
    for k, rows in ((0, mixed), (1, other[:30]), (2, other[30:])):
        assert sorted((got[i] for i, _, _ in rows), key=str) == sorted(brute(rows), key=str), k


def test_sums_over_many_tasks(spark, monkeypatch):
    rows = rows_of(300, 4, 5)
    monkeypatch.setattr(vc, "FAN_IN", 2)
    assert run(spark, rows, parts=9) == sorted(brute(rows), key=str)


def test_tree_leaves_out_subtrees_and_no_ties():
    r = np.random.default_rng(0)
    entries = np.floor(r.standard_normal((16, 8))[r.integers(0, 16, 256)] * 1000 + r.standard_normal((256, 8)) * 40)
    book = vc.Codebook(entries)
    x = np.floor(entries[r.integers(0, 256, 5000)] + r.standard_normal((5000, 8)) * 30)
    number, best, measured = book.nearest(x)
    d = ((x[:, None, :] - entries) ** 2).sum(2)
    assert (number == d.argmin(1)).all() and (best == d.min(1)).all()
    assert measured < 0.4 * d.size
    grid = np.array([[a, b] for a in range(16) for b in range(16)], float) * 2  # every centre is as near to four entries
    x = grid[r.integers(0, 256, 2000)] + 1
    d = ((x[:, None, :] - grid) ** 2).sum(2)
    number, best, _ = vc.Codebook(grid).nearest(x)
    assert (number == d.argmin(1)).all() and (best == d.min(1)).all()
    same = vc.Codebook(np.ones((256, 3)))
    assert same.nearest(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]


def test_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = vc.compress(rows)
    assert got.count() == rows.count() and got.select("codebooks_sha256").distinct().count() == 1
    assert got.filter(F.length("code") != 8).count() == 0
