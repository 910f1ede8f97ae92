import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rampart.llm import pieces


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(path):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def texts():
    rng = random.Random(1)
    letters = "abcdefgh  ABC▁éß\n\t\x00🙂漢́.,<>0x41"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    return out + ["", " ", "  ", "▁", "x ", " x", "<s> </s> <unk> <0x41>", "a" * 5000, "é" * 700, "ab" * 3000, "".join(rng.choice("etaoin") for _ in range(3000)),
                  " " * 500 + "x", "﻿word", "\x85\x1c  word", " ".join(rng.choice(["the", "of", "naïve", "2024", "x="]) for _ in range(30_000))]


def test_encodes_and_decodes_as_the_library(spark, path, library):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in pieces.piece_encode(df, path, decoded_col="decoded").collect()}
    for i, t in rows:
        want = library.encode(t)
        assert got[i]["ids"] == want, repr(t[:80])
        assert got[i]["decoded"] == library.decode(want), repr(t[:80])


def test_portions_do_not_matter(spark, path, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts()[:300])], "doc_id long, text string").coalesce(1)
    whole = {r["doc_id"]: r["ids"] for r in pieces.piece_encode(df, path).collect()}
    c = pieces.codec(path)
    monkeypatch.setattr(pieces, "PORTION_BYTES", 100)
    bounds = list(pieces._portions([60, 30, 30, 500, 0, 0, 90]))
    assert bounds == [(0, 2), (2, 3), (3, 4), (4, 7)]
    assert all(whole[i] == pieces._encode_portion(c, [t], False)[0].to_pylist()[0] for i, t in enumerate(texts()[:300]))


def test_side_by_side_is_one_by_one(path):
    c = pieces.codec(path)
    words = sorted({w for t in texts()[:2000] for w in pieces.separated(t).split(" ")})
    ids, sizes = c.segment_all(words)
    upto = 0
    for w, n in zip(words, sizes.tolist()):
        assert ids[upto:upto + n].tolist() == c.segment("▁" + w)
        upto += n


def test_decodes_any_ids_as_the_library(spark, path, library):
    rng = random.Random(2)
    lists = [[rng.choice([rng.randrange(32_000), rng.randrange(260), 259, 28705, 0, 1, 2]) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    df = spark.createDataFrame([(k, i, "old") for k, i in enumerate(lists)] + [(-1, None, "old")], "k long, ids array<int>, decoded string")
    got = {r["k"]: r["decoded"] for r in pieces.piece_decode(df, path).collect()}
    assert got[-1] == ""
    for k, ids in enumerate(lists):
        assert got[k] == library.decode(ids), ids


def test_odd_documents(spark, path, library, odd_docs, no_docs):
    got = pieces.piece_encode(odd_docs, path, decoded_col="lang")  # the columns ids and lang are replaced
    assert got.columns == ["doc_id", "source", "text_hash", "score", "ids", "lang"]
    key = lambda r: (str(r["doc_id"]), len(r["ids"]))
    want = sorted(((str(r["doc_id"]), library.encode(r["text"] or "")) for r in odd_docs.collect()), key=lambda x: (x[0], len(x[1])))
    assert [(str(r["doc_id"]), r["ids"]) for r in sorted(got.collect(), key=key)] == want
    assert pieces.piece_encode(no_docs, path).collect() == []
    digests = {(r["doc_id"], r["n_tokens"]): r for r in pieces.piece_digests(odd_docs, path).collect()}
    fox = digests[1, len(library.encode("the quick fox"))]
    assert fox["ids_sha256"] == hashlib.sha256(",".join(map(str, library.encode("the quick fox"))).encode()).hexdigest()
    assert fox["decoded_sha256"] == hashlib.sha256(b"the quick fox").hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert (digests[2, 0]["ids_sha256"], digests[2, 0]["decoded_sha256"]) == (empty, empty)


def test_given_documents(spark, path, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in pieces.piece_encode(docs.withColumn("t", F.col("text")), path, decoded_col="decoded").collect()}
    for r in docs.collect():
        assert got[r["doc_id"]]["ids"] == library.encode(r["text"] or "")
        assert got[r["doc_id"]]["decoded"] == (r["text"] or "") == got[r["doc_id"]]["t"]
