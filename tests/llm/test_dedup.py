import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from brute import brute_removed
from rampart.llm import common, simhash, substring_dedup, suffix_dedup
from rampart.llm.graph import components
from rampart.llm.suffix_sort import InducedSorter


def key(x):
    return (x is None, x if x is not None else 0)


@pytest.mark.parametrize("gram", [4, 10, 25])
def test_substring_dedup_is_brute_force(repeats, odd_docs, gram):
    for docs in (repeats, odd_docs):
        got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"], len(r["spans"])) for r in substring_dedup.remove_repeats(docs, 50, gram).collect()),
                     key=lambda t: (key(t[0]), t[1:]))
        want = []
        for i, words, gone in brute_removed([(r["doc_id"], r["text"]) for r in docs.collect()], lambda t: [w.decode() for w in t.encode().split()], 50):
            spans = sum(1 for a, b in zip([False, *gone], gone) if b and not a)
            want.append((None if i == float("inf") else i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g), spans))
        assert got == sorted(want, key=lambda t: (key(t[0]), t[1:]))


@pytest.mark.parametrize("gram", [8, 24])
def test_suffix_dedup_is_brute_force(repeats, gram):
    docs = repeats.select("doc_id", "text").union(repeats.sparkSession.createDataFrame([(90, "é" * 60), (91, "xé" + "é" * 40), (92, None)], "doc_id long, text string"))
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in suffix_dedup.remove_repeats(docs, 50, gram).collect()),
                 key=lambda t: (key(t[0]), t[1:]))
    want = []
    for i, raw, gone in brute_removed([(r["doc_id"], r["text"]) for r in docs.collect()], lambda t: list(t.encode()), 50):
        spans = sum(1 for a, b in zip([False, *gone], gone) if b and not a)
        want.append((None if i == float("inf") else i, len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    assert got == sorted(want, key=lambda t: (key(t[0]), t[1:]))


@pytest.fixture
def crowd(spark):
    """A hot gram: every document has the same ten words with other text around them, some the same text."""
    r = np.random.default_rng(9)
    prose = lambda n: [f"v{x}" for x in r.integers(0, 10**6, n)]
    line, shared = prose(10), prose(100)
    rows = [(i, " ".join(prose(60) + line + prose(60))) for i in range(120)]
    rows += [(200 + i, " ".join(prose(30) + shared[:30 + i] + line + shared[50 - i:] + prose(5))) for i in range(6)]
    rows += [(None, rows[7][1]), (7, rows[8][1]), (300, rows[9][1]), (301, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("hot", [0, 10])
def test_crowded_anchors_are_brute_force(crowd, repeats, hot):
    for module, split, of in ((substring_dedup, lambda t: [w.decode() for w in t.encode().split()], "n_words"), (suffix_dedup, lambda t: list(t.encode()), "n_bytes")):
        for docs in (crowd, repeats.select("doc_id", "text")):
            got = module.remove_repeats(docs, 50, hot=hot).select("doc_id", of, "n_removed", "spans").collect()
            got = sorted(((r[0], r[1], r[2], sorted((s["first"], s["last"]) for s in r[3])) for r in got), key=lambda t: (key(t[0]), t[1:]))
            want = []
            for i, units, gone in brute_removed([(r["doc_id"], r["text"]) for r in docs.collect()], split, 50):
                edge = np.flatnonzero(np.diff(np.r_[0, np.array(gone, int), 0])).tolist()
                want.append((None if i == float("inf") else i, len(units), sum(gone), [(a, b - 1) for a, b in zip(edge[::2], edge[1::2])]))
            assert got == sorted(want, key=lambda t: (key(t[0]), t[1:]))


def test_crowded_anchors_are_not_one_group(crowd, monkeypatch):
    largest = {}

    def spy(df, dtype, answer, packed=False, real=common.answered):
        def rows(table):
            many = max(collections.Counter(k for b in table.column("blob").to_pylist() for k in common.unpacked(b, dtype, packed)[dtype.names[0]].tolist()).values())
            return pa.table({"many": pa.array([many], pa.int64())})
        name = dtype.names[-1]
        df = df.localCheckpoint()
        largest[name] = max([0, *(r["many"] for r in df.groupBy("shard").applyInArrow(rows, "many long").collect())])
        return real(df, dtype, answer, packed)

    monkeypatch.setattr(common, "answered", spy)
    substring_dedup.remove_repeats(crowd, 50, hot=20).count()
    suffix_dedup.remove_repeats(crowd, 50, hot=20).count()
    assert largest["shared"] <= 4 and largest["doc"] <= 40 and largest["words"] <= 40 and largest["bytes"] <= 40


def test_empty_tables(no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert simhash.simhash_groups(no_docs).count() == 0


@pytest.mark.parametrize("in_memory", [3, 50, 10**6])
def test_induced_sorting(in_memory):
    r = np.random.default_rng(in_memory)
    for _ in range(60):
        strings = [r.integers(1, r.integers(2, 6), r.integers(1, 40)) for _ in range(r.integers(1, 9))]
        text = np.concatenate([np.r_[s, 0] for s in strings]).astype(np.int16)
        ends = np.flatnonzero(text == 0)
        suffix = {i: tuple(text[i:ends[np.searchsorted(ends, i)]]) for i in np.flatnonzero(text)}
        got = [(p, g) for pos, gap in InducedSorter(text, in_memory).suffixes(25) for p, g in zip(pos.tolist(), gap.tolist())]
        assert sorted(p for p, _ in got) == sorted(suffix)
        for (a, _), (b, gap) in zip(got, got[1:]):
            x, y = suffix[a], suffix[b]
            common = next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
            assert y <= x and min(gap, 25) == min(common, 25)


def brute_fingerprint(text, shingle):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


def test_simhash_is_brute_force(odd_docs, repeats):
    docs = odd_docs.unionByName(repeats)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    fps = [brute_fingerprint(t, 3) for _, t in rows]
    want = sorted((key(i), f, key(c)) for (i, _), f, c in zip(rows, fps, brute_components(fps, [i for i, _ in rows])))
    got = sorted((key(r["doc_id"]), r["fp"] % 2**64, key(r["component_id"])) for r in simhash.simhash_groups(docs).collect())
    assert got == want


@pytest.mark.parametrize("members", [2, 50_000])
def test_links_of_dense_and_sparse_fingerprints(spark, members):
    r = np.random.default_rng(1)
    centres = [int(x) for x in r.integers(0, 2**63, 6)]
    fps = set(int(x) for x in r.integers(0, 2**63, 150))
    for c in centres:
        for _ in range(40):
            f = c
            for b in r.choice(64, int(r.integers(0, 5)), replace=False):
                f ^= 1 << int(b)
            fps.add(f)
    fps = sorted(fps)
    table = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    label = {x["node"] % 2**64: x["component"] for x in components(simhash.fingerprint_links(table, 3, members)).collect()}
    want = brute_components(fps, list(range(len(fps))))
    groups = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(label.get(f, f"alone {f}"))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set.union(*groups.values())) == len(groups)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*chain, *star, (7, 7)], "src long, dst long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(300))


def test_hash_of_kept_text(repeats):
    from pyspark.sql import functions as F

    r = substring_dedup.remove_repeats(repeats).select("text", F.sha2("text", 256).alias("h")).first()
    assert r["h"] == hashlib.sha256(r["text"].encode()).hexdigest()
