import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipe
from rampart.llm import queries


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with planted cases, and their labels, in a folder like the given ones."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = prose(60)
    docs, labels = [], []
    for i in range(300):
        words = prose(rng.randint(30, 150))
        bad = i % 10 == 3
        if bad:
            words.insert(7, "blockhead")
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    base = " ".join(prose(400))
    docs += [(1000, base), (1001, base), (1002, base.replace(vocabulary[3], vocabulary[4], 1))]              # copies
    docs += [(2000 + k, " ".join(prose(40) + passage + prose(40))) for k in range(4)]                        # a shared passage
    docs += [(3000, "you are a bl0ckh3ad " + " ".join(prose(30))), (4000, "12 %% 99"), (4001, ""), (4002, None), (None, "words without an id")]
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "kept") for i, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long, _text string").repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf, passage


def test_stages_do_what_they_say(spark, corpus):
    sf, passage = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    columns = docs.columns
    for k, (name, stage) in enumerate(pipe.STAGES):
        docs = stage(spark, docs, sf)
        path = f"{sf}/stage-{k}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if k < len(pipe.STAGES) - 1:
            assert docs.columns == columns
    everything = set(range(300)) | {1000, 1001, 1002, 2000, 2001, 2002, 2003, 3000, 4000, 4001, 4002, None}
    assert kept["language_id"] == everything - {4000, 4001, 4002}
    assert kept["toxicity"] == kept["language_id"] - {i for i in range(300) if i % 10 == 3} - {3000}
    gone = kept["toxicity"] - kept["simhash_near_dedup"]
    assert 1001 in gone and gone <= {1001, 1002, None}
    assert kept["substring_dedup"] == kept["simhash_near_dedup"] == kept["best_fit_packing"]
    texts = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/stage-3").collect()}
    assert " ".join(passage) in texts[2000]["text"] and all(" ".join(passage) not in texts[2000 + k]["text"] for k in (1, 2, 3))
    assert all(r["n_chars"] == len(r["text"]) for r in texts.values()) and {r["_text"] for r in texts.values()} == {"kept"}


def test_language_stage_states_the_language_it_finds(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    words = {"aa": ["wekto", "lomira", "tasen", "pirul", "kedo"], "bb": ["shring", "thoub", "wrench", "blight", "quonth"]}
    prose = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, prose(lang, 30), lang, i) for i in range(60) for lang in [("aa", "bb")[i % 2]]]
    rows += [(100, prose("aa", 20), None, 1), (101, prose("bb", 20), None, 2), (102, prose("bb", 20_000), None, 3), (103, "12 --", None, 4), (104, None, "aa", 5), (105, prose("aa", 3), "bb", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _lang int")
    stated = lambda: {r["doc_id"]: (r["lang"], r["_lang"]) for r in pipe.language_id(spark, docs, str(tmp_path)).collect()}
    got = stated()
    assert set(got) == set(range(60)) | {100, 101, 102, 105}
    assert got[100] == ("aa", 1) and got[101] == ("bb", 2) and got[102] == ("bb", 3) and got[105] == ("bb", 6)
    train = pipe.langid.train
    monkeypatch.setattr(pipe.langid, "train", lambda d: train(d.replace({"aa": "bb", "bb": "aa"}, subset="lang")))
    assert stated()[100] == ("bb", 1)


def test_near_dedup_keeps_a_row_of_each_group(spark, tmp_path):
    rng = random.Random(4)
    prose = [" ".join("".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(80)) for _ in range(6)]
    rows = [(None, prose[0]), (None, prose[1]), (None, prose[1]), (5, prose[2]), (5, prose[3]), (5, prose[3]), (7, prose[3]), (None, prose[4]), (9, prose[4]), (8, prose[4]), (6, prose[5])]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _key int").repartition(3)
    got = pipe.simhash_near_dedup(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    want = [(None, prose[0]), (None, prose[1]), (5, prose[2]), (5, prose[3]), (8, prose[4]), (6, prose[5])]
    assert sorted((str(r["doc_id"]), r["text"]) for r in got.collect()) == sorted((str(i), t) for i, t in want)


def test_run_and_empty_tables(spark, corpus, tmp_path):
    sf, _ = corpus
    rows = pipe.run(spark, sf).collect()
    assert {r["doc_id"] for r in rows} >= {0, 1000, 2000}
    empty = str(tmp_path)
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert pipe.run(spark, empty).count() == 0


def test_every_query_is_registered():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES) and "pipeline" in names
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(names) and set(queries.ORACLE_SQL) <= set(entry.oracle_sql())
