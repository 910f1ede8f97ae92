import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rampart.llm import bpe, packing


@pytest.fixture(scope="module")
def library(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_query_columns_follow_the_library(spark, tokenizer, library, odd_docs):
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.token_digests(odd_docs, tokenizer).collect())
    want = []
    for r in odd_docs.collect():
        ids = ids_of(library, r["text"])
        raw = np.array(ids, "<u4").tobytes()
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(raw).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)


ASSIGNED = st.characters(exclude_categories=["Cn", "Cs"])  # new letters are known to one library before the other


@given(st.text(ASSIGNED, max_size=80) | st.text("ab'stred .,!<|endoftext>éÉΣσİ 1\x1c\x85", max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_text(tokenizer, library, text):
    c = bpe.codec(tokenizer)
    ids = c.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, text)
    assert c.decode(ids) == library.decode(ids_of(library, text), skip_special_tokens=False)


def test_words_alone_and_from_the_cache(tokenizer):
    c = bpe.codec(tokenizer)
    words = ["hello", "<|endoftext|>", "don't", "Hello", "x<|endoftext|>y", "<|ENDOFTEXT|>"]
    assert c.encode_words(words) == [c.encode(w) for w in words] == c.encode_words(words)


def test_columns_are_kept_or_replaced(spark, tokenizer, odd_docs, no_docs):
    out = bpe.bpe_encode(odd_docs, tokenizer)
    assert sorted(out.columns) == sorted(odd_docs.columns) and out.schema["ids"].dataType.typeName() == "binary"
    assert out.count() == odd_docs.count()
    back = bpe.bpe_decode(out, tokenizer).where("doc_id = 1").first()
    assert back["decoded"] == "the</w> quick</w> fox</w>"
    assert bpe.bpe_encode(no_docs, tokenizer).count() == 0


def check_packing(rows, capacity, total):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r["length"] for r in rows) == total
    return len(places)


def test_pieces_and_places(spark, tokenizer, library, odd_docs, no_docs):
    docs = odd_docs.unionByName(spark.range(100, 400).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("word of "), (F.col("id") % 90).cast("int")).alias("text")), allowMissingColumns=True)
    capacity = 64
    rows = packing.pack_documents(docs, tokenizer, capacity).collect()
    want = []
    for r in docs.collect():
        ids = ids_of(library, r["text"]) + [0]
        want += [(str(r["doc_id"]), k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(np.array(ids[k:k + capacity], "<u4").tobytes()))
                 for k in range(0, len(ids), capacity)]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    used = check_packing(rows, capacity, sum(w[3] for w in want))
    assert used <= 1.05 * sum(w[3] for w in want) / capacity + 1
    assert packing.pack_documents(no_docs, tokenizer, capacity).count() == 0


@given(st.dictionaries(st.integers(1, 97), st.integers(1, 400), min_size=1, max_size=60))
@settings(max_examples=150, deadline=None)
def test_plan_places_every_item(histogram):
    capacity = 97
    plan = packing.plan_packing(histogram, capacity)
    used = {}
    for n, part in plan.groupby("length"):
        ends = [*part["first_rank"].tolist()[1:], histogram[n]]
        for (first, per, seq, off), end in zip(part[["first_rank", "per", "first_sequence", "offset"]].itertuples(index=False), ends):
            for r in range(first, end):
                k, within = divmod(r - first, per)
                used.setdefault(seq + k, []).append((off + within * n, n))
    rows = [{"sequence_id": s, "offset": o, "length": n} for s, parts in used.items() for o, n in parts]
    assert len(rows) == sum(histogram.values())
    total = sum(n * c for n, c in histogram.items())
    count = check_packing(rows, capacity, total)
    # best-fit decreasing on the same lengths is hardly better
    room = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fit = [i for i, r in enumerate(room) if r >= n]
        if fit:
            room[min(fit, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    assert count <= 1.06 * len(room) + 2


def test_wrong_lengths(spark):
    with pytest.raises(ValueError, match="between 1 and"):
        packing.plan_packing({0: 1}, 8)
    with pytest.raises(ValueError, match="between 1 and"):
        packing.plan_packing({9: 1}, 8)


@pytest.mark.parametrize("size", [49408, 70_000])  # 70 000: keys of more than 32 bits
def test_pair_ranks_are_those_of_the_merges(size):
    rng = np.random.default_rng(4)
    pairs = rng.integers(0, size, (20_000, 2))
    ranks = {int(a) * size + int(b): r for r, (a, b) in enumerate(pairs)}
    asked = np.r_[pairs, rng.integers(0, size, (20_000, 2)), [[0, 0], [size - 1, size - 1]]]
    got = bpe.pair_ranks(ranks, size, len(pairs)).of(asked[:, 0].astype(np.uint32), asked[:, 1].astype(np.uint32))
    assert got.tolist() == [ranks.get(int(a) * size + int(b), len(pairs)) for a, b in asked]


def test_words_are_encoded_when_the_cache_is_emptied(tokenizer, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    c = bpe.BpeCodec(tokenizer)
    for texts in (["one two", "two three", None], ["two four <|endoftext|>five", ""], ["one two three four five six", "two"]):
        assert [np.frombuffer(i, "<u4").tolist() for i in c.encode_batch(texts)] == [ids_of(library, t) for t in texts]
