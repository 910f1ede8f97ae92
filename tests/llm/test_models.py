import math
import os
import random
import tracemalloc
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rampart.llm import common, langid, lm, toxicity
from rampart.llm.bpe import codec
from rampart.llm.common import held_out
from rampart.session import local_path, plain_path

SYLLABLES = {"aa": ["ka", "ro", "ti", "mu"], "bb": ["sch", "ung", "ler", "ein"], "cc": ["αβ", "γω", "δε", "λη"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def languages(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, rng.randint(3, 60)), lang) for i in range(300) for lang in [rng.choice(list(SYLLABLES))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_texts(languages):
    out = held_out("doc_id", 4, 2)
    model = langid.train(languages, where=~out)
    got = langid.identify(languages.withColumn("h", out), model).where("h").collect()
    assert len(got) > 50 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_spans_of_mixed_text(spark, languages):
    rng = random.Random(4)
    parts = [("aa", 20), ("cc", 9), ("bb", 25)]
    text = " ".join(prose(rng, lang, n) for lang, n in parts)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = langid.identify(df, langid.train(languages)).first()
    assert [(s["first_word"], s["last_word"], s["lang"]) for s in r["lang_spans"]] == [(0, 19, "aa"), (20, 28, "cc"), (29, 53, "bb")]
    assert r["lang_pred"] == "bb" and r["score"] == pytest.approx(25 / 54)


def test_viterbi_is_the_best_path(languages):
    labeller = langid.Labeller(langid.train(languages), penalty=3.0)
    rng = random.Random(8)
    texts = [" ".join(prose(rng, rng.choice(list(SYLLABLES)), 1) for _ in range(n)) for n in (0, 1, 5, 7)]
    for t, (path, _) in zip(texts, labeller.label(texts)):
        words = t.split()
        scores = labeller.table[[labeller.known[w] for w in words]] if words else np.zeros((0, 3))

        def value(p, scores=scores):
            return sum(scores[i, x] for i, x in enumerate(p)) - 3.0 * sum(a != b for a, b in zip(p, p[1:]))

        import itertools

        best = max((value(p) for p in itertools.product(range(3), repeat=len(words))), default=0)
        assert value(path.tolist()) == pytest.approx(best, abs=1e-4)


def test_odd_texts_have_a_language_or_none(odd_docs, no_docs, languages):
    model = langid.train(languages)
    out = langid.identify(odd_docs, model)
    assert out.count() == odd_docs.count()
    for r in out.collect():
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered) and 0 <= r["score"] <= 1
    assert langid.identify(no_docs, model).count() == 0
    empty = langid.train(no_docs)
    assert empty["langs"] == [] and {r["lang_pred"] for r in langid.identify(odd_docs, empty).collect()} == {"und"}


# ---- toxicity ------------------------------------------------------------------

@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(6)
    plain = ["house", "river", "garden", "walk", "morning", "quiet", "letter", "stone", "bread", "window"]
    rude = ["blockhead", "scoundrel"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 40))]
        bad = rng.random() < 0.2
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_held_out_texts_and_disguises(spark, toxic):
    docs, labels = toxic
    out = held_out("doc_id", 3, 1)
    model = toxicity.train(docs, labels, where=~out)
    assert set(model["lexicon"]) == {"blockhead", "scoundrel"}
    got = toxicity.score(docs.withColumn("h", out), model).where("h").join(labels, "doc_id").collect()
    assert len(got) > 100 and all((r["toxicity"] >= 0.7) == (r["toxic"] == 1) for r in got)
    disguised = ["you BLOCKHEAD!!", "a bl0ckh3ad here", "b l o c k h e a d", "s.c.o.u.n.d.r.e.l", "scooooundrel", "$coundre1 walk", "blöckheåd", "what a blockhеad", "block*head***"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(disguised)], "doc_id long, text string")
    assert [r["doc_id"] for r in toxicity.score(df, model).where("toxicity < 0.7").collect()] == []
    clean = ["quiet garden 10 stones", "the block, head of river", "WINDOW!!! 100%", "b r e a d and s t o n e", "http://stone.bread/1?x=2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(clean)], "doc_id long, text string")
    assert toxicity.score(df, model).where("toxicity >= 0.7").count() == 0


def test_letters_are_counted_a_few_words_at_a_time():
    words = Counter({"no1": 4, "stop!!": 2, "ab": 3, "é": 1} | {"".join(chr(97 + i // 26 ** k % 26) for k in range(12)): 1 + i % 3 for i in range(150_000)})
    table = np.zeros(28 ** 3)
    tracemalloc.start()
    toxicity._add_letters(words, table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # 145 MB with all words at once
    expected = Counter()
    for w, n in words.items():
        if (w := w.rstrip("!")).isalpha():
            codes = [27, 27, *(ord(c) - 97 if c.isascii() else 26 for c in w), 27]
            for t in zip(codes, codes[1:], codes[2:]):
                expected[t] += n
    assert {divmod(k, 28 * 28)[:1] + divmod(k % 784, 28): table[k] for k in np.flatnonzero(table).tolist()} == expected


def test_restoring_is_the_best_lattice_path(toxic):
    model = toxicity.train_characters(toxic[0])

    def brute(seen):
        best = (-math.inf, "")
        ways = [(0.0, (27, 27), "")]
        before = ""
        for c in seen:
            new = []
            for total, (a, b), text in ways:
                for code, cost, letter in toxicity.choices(c, before):
                    if code < 0 or code == 27 == b:
                        new.append((total - cost, (a, b), text))
                    else:
                        new.append((total - cost + model[a, b, code], (27, 27) if code == 27 else (b, code), text + letter))
            ways, before = new, c
        for total, (a, b), text in ways:
            best = max(best, (total + (model[a, b, 27] if b != 27 else 0.0), text))
        return best[1].strip()

    for seen in ("st0ne", "w4lk", "g a r d", "riiver", "1", "m0rn1ng", "q-u1et"):
        assert toxicity.restore(seen, model) == brute(seen)


def test_odd_texts_have_a_score(odd_docs, no_docs, toxic):
    docs, labels = toxic
    model = toxicity.train(docs, labels.union(labels.sparkSession.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")))
    out = toxicity.score(odd_docs, model)
    assert out.count() == odd_docs.count() and out.where("toxicity between 0 and 1").count() == odd_docs.count()
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.train(no_docs, labels)
    assert none["lexicon"] == {} and toxicity.score(odd_docs, none).where("toxicity = 0").count() == odd_docs.count()


def test_sampled_fit_finds_the_words_of_the_full_fit(spark):
    rng = random.Random(8)
    plain = ["house", "river", "garden", "walk", "morning", "quiet", "letter", "stone", "bread", "window"]
    rude = ["blockhead", "scoundrel", "nitwit", "dunce"]  # each in a quarter of the toxic texts
    rows, labels = [], []
    for i in range(4000):
        words = [rng.choice(plain) for _ in range(20)]
        if i % 5 == 0:
            words.insert(3, rude[i // 5 % 4])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    rows += [(20, "another text of an id"), rows[40], rows[40]]  # neither adds to the counts of another text
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    whole = toxicity.train(docs, labels)
    assert set(whole["lexicon"]) >= set(rude)
    old = toxicity.LEAST_SHARE
    toxicity.LEAST_SHARE = 0.05  # of 800 toxic texts 40; a word has about 20 of the sampled ones
    try:
        part = toxicity.train(docs, labels, labelled=400)
    finally:
        toxicity.LEAST_SHARE = old
    assert set(part["lexicon"]) == set(rude)
    assert abs(part["prior"] - whole["prior"]) < 0.06 and abs(whole["prior"] - 0.2) < 0.001
    assert all(abs(part["lexicon"][w] - whole["lexicon"][w]) < 0.2 for w in rude)


# ---- language model ---------------------------------------------------------------

def brute_counts(rows):
    low = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + ["\n"]
    c = {}
    for t, out in rows:
        for w in [] if out else low(t):
            c[w] = c.get(w, 0) + 1
    n, v = sum(c.values()), len(c)
    return [(len(low(t)), sum(w in c for w in low(t)), n, sum(math.log10((c.get(w, 0) + 1) / (n + v + 1)) for w in low(t))) for t, _ in rows]


def test_base_is_brute_force(spark, tokenizer, odd_docs, languages, no_docs):
    docs = odd_docs.unionByName(languages.limit(60), allowMissingColumns=True).withColumn("h", held_out("doc_id", 7, 2))
    rows = [(r["text"], r["h"]) for r in docs.collect()]
    want = sorted((n, k, total, round(base, 6)) for n, k, total, base in brute_counts(rows))
    got = lm.score(docs, tokenizer, "h").collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in got)
    assert lm.score(no_docs.withColumn("h", F.lit(False)), tokenizer, "h").count() == 0
    alone = lm.score(docs.withColumn("h", F.lit(True)), tokenizer, "h").collect()
    assert len(alone) == len(rows) and {r["train_tokens"] for r in alone} == {0}


def test_windows_score_every_id_once():
    r = np.random.default_rng(0)
    ids = [r.integers(0, 90, n).astype(np.int32) for n in (0, 1, 23, 24, 25, 100)]
    inputs, targets, text = lm.windows_of(ids, 99)
    for k, x in enumerate(ids):
        own = targets[text == k]
        assert own[own >= 0].tolist() == [*x, 99]
    # a prediction depends on nothing after it, and on padding not at all
    model = lm.Attention(np.arange(100.0))
    for n in model.weights:
        model.weights[n] = (r.standard_normal(model.weights[n].shape) * 0.3).astype(np.float32)
    base, _ = model.forward(inputs)
    later = inputs.copy()
    later[:, -1] = np.where(later[:, -1] >= 0, (later[:, -1] + 7) % 90, -1)
    changed, _ = model.forward(later)
    assert np.allclose(base[:, :-1], changed[:, :-1], atol=1e-5)
    assert np.allclose(np.exp(base).sum(2), 1, atol=1e-4)


def test_gradients():
    r = np.random.default_rng(1)
    model = lm.Attention(r.integers(0, 500, 900).astype(float))
    for n in model.weights:
        model.weights[n] = r.standard_normal(model.weights[n].shape) * 0.3
    model.bigram, model.causal = model.bigram.astype(float), model.causal.astype(float)
    inputs, targets, _ = lm.windows_of([r.integers(0, 899, n).astype(np.int32) for n in (3, 30, 70)], 899)

    def loss():
        logp, _ = model.forward(inputs)
        b, t = np.nonzero(targets >= 0)
        return -logp[b, t, model.target[targets[b, t]]].mean()

    for n, g in model.gradients(inputs, targets).items():
        w, at = model.weights[n], np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = w[at], 1e-5
        w[at] = old + e
        up = loss()
        w[at] = old - e
        down = loss()
        w[at] = old
        assert g[at] == pytest.approx((up - down) / (2 * e), rel=1e-3)


def test_beats_the_base_on_held_out_prose(spark, tokenizer):
    rng = random.Random(9)
    kinds = [["th", "er", "ing", "ou", "sh", "ti"], ["ka", "ro", "mi", "lu", "zo", "be"]]
    rows = []
    for i in range(400):  # a text keeps to one kind of words
        syllables = rng.choice(kinds)
        rows.append((i, " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(20, 200)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", held_out("doc_id", 7, 2))
    got = lm.score(docs, tokenizer, "h").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_every_training_window_is_fitted(spark, tokenizer, languages, monkeypatch):
    docs = languages.withColumn("h", held_out("doc_id", 7, 2))
    many = []

    def spy(counted, size, real=lm._fit):
        blobs = counted.filter(F.col("kind") == lm.WINDOWS).filter(F.col("shard") < lm.ROUNDS).select("blob").collect()
        many.append(sum(len(common.unpacked(r["blob"], lm.WINDOW, True)) for r in blobs))
        return real(counted, size)

    monkeypatch.setattr(lm, "_fit", spy)
    got = lm.score(docs, tokenizer, "h").collect()
    trained = docs.where("not h").count()
    # a window at least for each text, and one for every STRIDE words
    assert many[0] >= max(trained, sum(r["n_tokens"] for r in got if not r["held_out"]) / lm.STRIDE)


def test_passes_without_spelling_drop_the_codec(tokenizer):
    codec(tokenizer).encode("a cache of words")
    assert codec.cache_info().currsize
    assert list(lm.rows_of([])) == [] and not codec.cache_info().currsize


def test_windows_are_deleted_once_the_weights_are_fitted(spark, tokenizer, languages, monkeypatch):
    files = []

    def spy(counted, size, real=lm._fit):
        files.extend(local_path(plain_path(f)) for f in counted.inputFiles())
        return real(counted, size)

    monkeypatch.setattr(lm, "_fit", spy)
    got = lm.score(languages.withColumn("h", held_out("doc_id", 7, 2)), tokenizer, "h")
    left = {f.split("kind=")[1][0] for f in files if os.path.exists(f)}
    assert str(lm.WINDOWS) not in left and {str(lm.SPELLED), str(lm.LENGTHS)} <= left
    assert got.count() == languages.count()


def test_large_logits_are_shifted():
    model = lm.Attention(np.arange(100.0))
    inputs, targets, _ = lm.windows_of([np.arange(60, dtype=np.int32)], 99)
    model.weights["up"] = np.random.default_rng(2).standard_normal(model.weights["up"].shape).astype(np.float32) * 400
    assert np.isfinite(model.class_scores(inputs, targets)).all()
    assert all(np.isfinite(g).all() for g in model.gradients(inputs, targets).values())


def test_pair_counts_are_summed_by_key():
    r = np.random.default_rng(3)
    parts = [np.array([(k, n) for k, n in r.integers(0, 50, (many, 2))], lm.PAIR) for many in (0, 1, 80)]
    want = {}
    for k, n in np.concatenate(parts).tolist():
        want[k] = want.get(k, 0) + n
    assert lm.summed(parts).tolist() == sorted(want.items()) and not len(lm.summed([]))


def test_words_are_scored_the_same_in_portions(monkeypatch):
    r = np.random.default_rng(5)
    counts = r.integers(0, 9, 200).astype(float)
    known = lm.Known(lm.Attention(counts), np.array([counts, counts / 3]), np.array([counts, counts / 2]))
    n = r.integers(1, 4, 50)
    ids = r.integers(0, 200, n.sum()).astype(np.int32)
    args = -r.random(len(ids)), ids, n, r.integers(0, 3, 50).astype(float)
    whole = known.words(*args)
    for many in (1, 7, 50):
        monkeypatch.setattr(lm, "WORDS_TOGETHER", many)
        assert known.words(*args).tolist() == whole.tolist()


def test_documents_are_written_and_split_once(spark, tokenizer, languages, monkeypatch):
    tables = []

    def spy(df, name, *args, real=common.materialize, **options):
        tables.append(name)
        return real(df, name, *args, **options)

    monkeypatch.setattr(common, "materialize", spy)
    got = lm.score(languages.withColumn("h", held_out("doc_id", 7, 2)), tokenizer, "h")
    assert tables == ["counts", "words"]  # no copy of the texts beside them
    assert got.count() == languages.count()


def test_words_of_a_block_are_those_of_bytes(tokenizer):
    raw = ["", " ", "\n\n A\tb\x0bC\x0cd\re  ", "\x1c x\x1dy \x85 Z\xa0w", "\x00 a", "É é Σσς İ", " <|endoftext|> <|endoftext|>x a", "a a  b"]
    t = lm.Text(pa.array(raw, pa.string()), np.arange(len(raw)) % 2 > 0, tokenizer, 49407, 24)
    flat = [w.decode() for x in raw for w in [*x.encode().lower().split(), b"\n"]]
    assert t.sizes.tolist() == [len(x.encode().split()) + 1 for x in raw]
    names = {}
    assert all(names.setdefault(n, w) == w for n, w in zip(t.words.tolist(), flat)) and len(set(names.values())) == len(names) == len(t.lengths)
    assert (np.diff(t.shard) >= 0).all()
    for n, w in names.items():
        ids = t.spelled[t.begin[n]:t.begin[n] + t.lengths[n]].tolist()
        assert ids == ([49407] if w == "\n" else np.frombuffer(codec(tokenizer).encode(w), "<u4").tolist())


def test_shares_of_pairs_are_their_counts():
    r = np.random.default_rng(7)
    model = lm.Attention(r.integers(0, 99, 700).astype(float))
    pairs = np.sort(r.choice(len(model.bigram) * 700, 5000, replace=False))
    many = r.integers(1, 50, 5000).astype(float)
    model.set_bigrams(pairs, many)
    known = lm.Known(model, np.ones((2, 700)), np.ones((2, 700)))
    before, ids = r.integers(0, 700, 4000), r.integers(0, 700, 4000)
    count = dict(zip(pairs.tolist(), many.tolist()))
    n = np.array([count.get(k, 0.0) for k in (model.read[before].astype(np.int64) * 700 + ids).tolist()])
    want = np.log((n + lm.SHRINK * np.exp(model.share[ids])) / (model.seen[model.read[before], model.target[ids]] + lm.SHRINK))
    assert n.any() and np.allclose(known.shares(before, ids), want, rtol=1e-12)


def test_word_ids_are_those_of_texts(tokenizer):
    rng = random.Random(4)
    alphabet = ["a", "b", "é", "é", "́", "Σ", "ς", "İ", "ß", "ᄀ", "ᅡ", " ", "\x1c", "　", "<|endoftext|>", "<|", ".", ",", "1", "😀", "ﬁ"]
    c = codec(tokenizer)
    for k in range(300):
        words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(k % 5 > 0, 6))) for _ in range(rng.randint(0, 12))]
        ids, sizes = c.word_ids(words)
        assert ids.astype("<u4").tobytes() == b"".join(map(c.encode, words)) and sizes.tolist() == [len(c.encode(w)) // 4 for w in words]


def test_only_odd_words_are_split_one_by_one(tokenizer, monkeypatch):
    words = ["größe,", "a1b22", "$$$x$", "it's", "中文", "wort", "é½é", "x...", "7", "!", "٣a", "a\x85b"]
    want = [codec(tokenizer).encode(w) for w in words]
    c, asked = codec(tokenizer), []
    monkeypatch.setattr(c, "_split", lambda chunks, real=c._split: asked.extend(chunks) or real(chunks))
    for some in (words, words[:3], words[3:5], words[5:6]):
        asked.clear()
        ids, sizes = c.word_ids(some)
        assert set(asked) <= {"it's", "中文", "٣a", "a\x85b", "a", "b"}
        assert ids.astype("<u4").tobytes() == b"".join(want[words.index(w)] for w in some)
        assert sizes.tolist() == [len(want[words.index(w)]) // 4 for w in some]


def test_a_step_makes_its_classes_in_portions():
    r = np.random.default_rng(8)
    model = lm.Attention(r.integers(0, 99, 700).astype(float))
    inputs, targets, _ = lm.windows_of([r.integers(0, 700, lm.BATCH * lm.STRIDE - 1).astype(np.int32)], 699)
    model.gradients(inputs, targets)
    tracemalloc.start()
    model.gradients(inputs, targets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(inputs) == lm.BATCH and peak < 1_100_000  # two arrays of all classes alone are 786 kB


def test_scores_of_large_sums_are_those_of_doubles():
    r = np.random.default_rng(10)
    model = lm.Attention(r.integers(0, 99, 100).astype(float))
    inputs, targets, _ = lm.windows_of([r.integers(0, 99, n).astype(np.int32) for n in (5, 60)], 99)
    for scale in (0.5, 6, 40):  # of scores and logits: small, and beyond what exp in 32 bits can hold
        model.weights = {n: (r.standard_normal(w.shape) * scale ** (n in ("see", "up"))).astype(np.float32) for n, w in model.weights.items()}
        w = {n: x.astype(float) for n, x in model.weights.items()}
        x = w["embed"][model.read[inputs]] + w["place"]
        q, k, v = np.split(x @ w["see"], 3, 2)
        score = q[:, lm.CONTEXT:] @ k.transpose(0, 2, 1) * lm.DIMS ** -0.5
        unseen = np.arange(lm.WIDTH) > lm.CONTEXT + np.arange(lm.STRIDE)[:, None]
        score[np.broadcast_to(unseen, score.shape) | ((inputs[:, :1, None] < 0) & (np.arange(lm.WIDTH) < lm.CONTEXT))] = -np.inf
        p = np.exp(score - score.max(2, keepdims=True))
        h = p / p.sum(2, keepdims=True) @ v @ w["out"] + x[:, lm.CONTEXT:]
        logits = h @ w["up"] + model.bigram[model.read[inputs]][:, lm.CONTEXT:]
        logits -= logits.max(2, keepdims=True)
        logits -= np.log(np.exp(logits).sum(2, keepdims=True))
        want = np.take_along_axis(logits, model.target[targets][:, :, None].astype(int), 2)[:, :, 0][targets >= 0]
        assert np.allclose(model.class_scores(inputs, targets), want, rtol=1e-3, atol=1e-2 * scale)


def test_repeated_words_are_judged_once():
    r = np.random.default_rng(6)
    counts = r.integers(0, 9, 200).astype(float)
    known = lm.Known(lm.Attention(counts), np.array([counts, counts / 3]), np.array([counts, counts / 2]))
    n, which = r.integers(1, 4, 20), r.integers(0, 20, 3000)
    ids, c = r.integers(0, 200, n.sum()).astype(np.int32), r.integers(0, 3, 20).astype(float)
    begin = np.cumsum(n) - n
    every = np.concatenate([ids[begin[w]:begin[w] + n[w]] for w in which])
    classes = -r.random(len(every))
    got = known.in_text(classes, n[which], known.apart(ids, n, c), which)
    assert np.allclose(got, known.words(classes, every, n[which], c[which]), rtol=1e-12)
    at = np.cumsum(n[which]) - n[which]
    for w, a, x in zip(which[:50], at, got):
        own, k = ids[begin[w]:begin[w] + n[w]], classes[a:a + n[w]]
        first = own[0]
        spelled = known.new[first] + known.go[own[:-1]].sum() + known.stop[own[-1]] + (k[1:] + known.shares(own[:-1], own[1:])).sum()
        counted = known.old[first] + np.log(c[w] / max(known.tokens[first], 1)) if c[w] else -np.inf
        assert x == pytest.approx(k[0] + known.first_share[first] + np.logaddexp(counted, spelled))
