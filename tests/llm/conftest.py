import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, ids string, text_hash string, score string"


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty, blank, long and repeated texts, clashing column names."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "Éa", "naïve", "1d10t", "x"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [(1, "the quick fox", "en", "s", "i", "h", "9"), (2, None, "en", None, None, None, None), (None, "the quick fox", None, "s", None, None, None),
            (3, "", "fr", "s", None, None, None), (4, " \t\n ", "fr", "s", None, None, None), (5, long, "en", "s", None, None, None),
            (5, long, "en", "s", None, None, None), (6, "12 34 %%", "de", "s", None, None, None), (None, None, None, None, None, None, None),
            (7, "word with odd\u0085blanks \x1c‍ 🙂", "de", "s", None, None, None), (8, "a" * 5_000, "de", "s", None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def repeats(spark):
    """Documents that share passages: copies, overlaps, shifted and nested repeats."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    passage = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    a, b, c, line = passage(120), passage(70), passage(60), passage(14)
    texts = [a, passage(30) + b + passage(10), b + c, passage(5) + a[20:90] + passage(3), a, line * 9, passage(4) + line * 6, c[:49], c[:50],
             c[5:] + c[5:], passage(200), a[:60] + ["new"] + a[61:], [], b[:30] + c[:30] + b[:30] + c[:30]]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, " ".join(t), None, "s", None, None, None) for i, t in zip(order, texts)]
    rows += [(None, " ".join(a[10:80]), None, None, None, None, None), (rows[3][0], " ".join(a), None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)
