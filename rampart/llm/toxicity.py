"""Toxicity by noisy-channel deobfuscation.

A disguised word is a lattice: each of its characters may stand for some letters
(leetspeak, accents and look-alikes), for nothing (separators, repetition) or for a
word's end (spacing). Viterbi decodes the most likely text under a channel with fixed
costs and a character trigram model counted over all training texts. The words of
the restored text are scored with what the labelled training texts say of them.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.llm.bpe import add_columns, clear_worker
from rampart.llm.common import discard, materialize

HASHES = 1 << 53     # values of the hash that the sample is drawn by
LABELLED = 50_000   # about so many distinct labelled texts fit the word scores, the first by hash
LEAST_TEXTS, LEAST_SHARE = 5, 0.005  # of the toxic texts, that a word must occur in
LEAST_SCORE = 0.6
PRIOR_TEXTS = 4.0
CACHE_ENTRIES = 400_000
WORDS_HELD = 150_000     # different words that a task holds before it counts their letters
WORDS_TOGETHER = 20_000  # words whose letters are counted at once

# ---- channel -----------------------------------------------------------------

A, OTHER, EDGE, SIZE = 0, 26, 27, 28  # codes: a-z, another letter, a word's end

#: What a character may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
#: Cyrillic and Greek letters that look like Latin ones.
LOOKALIKES = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "к": "k", "м": "m", "т": "t", "н": "h", "в": "b",
              "ο": "o", "α": "a", "ι": "i", "ν": "v", "ρ": "p", "τ": "t"}
#: Costs in nats.
SWAP, DROP, REPEAT, SPACE_DROP, BREAK, DISGUISE = 1.0, 1.0, 0.3, 1.0, 1.0, 5.0
PATHS = 6

TRIPLE = re.compile(r"(.)\1\1")
DOUBLE = re.compile(r"(.)\1+")
TAIL = re.compile(r"(?:[^\w@$]|_|([@$])\1\1+)+$")
HEAD = re.compile(r"^[^\w@$!|(+]+")
SPACED = re.compile(r"(?<!\S)(?:\S\s){3,}\S(?!\S)")


def fold(c: str) -> str:
    """The plain Latin letter that a letter looks like, or the letter itself."""
    return LOOKALIKES.get(c) or unicodedata.normalize("NFD", c)[0]


def choices(c: str, before: str) -> list[tuple[int, float, str]]:
    """(code, cost, letter) of what one character may stand for; code -1: nothing."""
    out: list[tuple[int, float, str]] = []
    if "a" <= c <= "z":
        out.append((ord(c) - 97, 0.0, c))
    elif c.isalpha():
        out.append((OTHER, 0.0, c))
        if "a" <= (f := fold(c)) <= "z":
            out.append((ord(f) - 97, SWAP, f))
    elif c.isspace():
        return [(-1, SPACE_DROP, ""), (EDGE, 0.0, " ")]
    else:
        out += [(ord(x) - 97, SWAP, x) for x in LEET.get(c, "")]
        if not c.isdigit():
            out.append((-1, DROP, ""))
        out.append((EDGE, BREAK, " "))
    if c == before:
        out.append((-1, REPEAT, ""))
    return out


def restore(seen: str, model: np.ndarray, lexicon: dict[str, float] | None = None) -> str:
    """The likeliest text behind lower-case ``seen``; model: log P(c | a, b).

    Each state keeps its PATHS best ways, and a scored word among the finished
    texts gains DISGUISE: such words are what people disguise."""
    beam: dict[tuple[int, int], list[tuple[float, str]]] = {(EDGE, EDGE): [(0.0, "")]}
    before = ""
    for c in seen:
        after: dict[tuple[int, int], dict[str, float]] = defaultdict(dict)
        options = choices(c, before)
        for (a, b), ways in beam.items():
            for code, cost, letter in options:
                if code < 0 or code == EDGE == b:
                    state, gain, letter = (a, b), -cost, ""
                else:
                    gain = model[a, b, code] - cost
                    state = (EDGE, EDGE) if code == EDGE else (b, code)
                into = after[state]
                for total, text in ways:
                    text += letter
                    if into.get(text, -math.inf) < total + gain:
                        into[text] = total + gain
        beam = {state: sorted(((v, t) for t, v in ways.items()), reverse=True)[:PATHS] for state, ways in after.items()}
        before = c
    ends = [(total + (model[a, b, EDGE] if b != EDGE else 0.0), text) for (a, b), ways in beam.items() for total, text in ways]
    if lexicon:
        ends = [(v + DISGUISE * sum(w in lexicon for w in t.split()), t) for v, t in ends]
    return max(ends)[1].strip()


class Reader:
    """Words of a text, disguised ones restored; decoded words are cached."""

    def __init__(self, model: np.ndarray, lexicon: dict[str, float] | None = None):
        self.model, self.lexicon = model, lexicon
        self.known: dict[str, tuple[str, ...]] = {}

    def _token(self, token: str) -> tuple[str, ...]:
        core = HEAD.sub("", TAIL.sub("", token))
        if core.isalpha():
            lexicon = self.lexicon
            if core.isascii() or lexicon is None:
                plain = not TRIPLE.search(core) and (lexicon is None or core in lexicon or DOUBLE.sub(r"\1", core) not in lexicon)
            else:
                plain = "".join(map(fold, DOUBLE.sub(r"\1", core))) not in lexicon
            if plain:
                return (core,)
        elif not any(c.isalpha() for c in core):
            return ()
        return tuple(restore(core, self.model, self.lexicon).split())

    def tokens(self, text: str) -> list[tuple[str, tuple[str, ...]]]:
        """(as written, restored words) of each different token and spaced-out run."""
        text = text.lower()
        seen = set(text.split())
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        known = self.known
        for t in seen:
            if t not in known:
                known[t] = self._token(t)
        out = [(t, known[t]) for t in seen]
        for m in SPACED.finditer(text):
            out.append((m[0], tuple(restore(m[0], self.model, self.lexicon).split())))
        return out

    def hits(self, text: str) -> tuple[set[str], list[str]]:
        """The lexicon's words in a text, and which of them were disguised."""
        text = text.lower()
        seen = set(text.split())
        known, lexicon = self.known, self.lexicon
        if len(known) > CACHE_ENTRIES:
            known.clear()
        for t in seen:
            if t not in known:
                known[t] = tuple(w for w in self._token(t) if w in lexicon)
        pairs = [(t, known[t]) for t in seen if known[t]]
        for m in SPACED.finditer(text):
            pairs.append((m[0], tuple(w for w in restore(m[0], self.model, self.lexicon).split() if w in lexicon)))
        return {w for _, ws in pairs for w in ws}, sorted({w for t, ws in pairs for w in ws if w not in t})


# ---- training ------------------------------------------------------------------

def _codes(words: list[str]) -> np.ndarray:
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where(points == 32, EDGE, np.where((points >= 97) & (points <= 122), points - 97, OTHER))


def _add_letters(words: Counter, table: np.ndarray) -> None:
    """Adds the trigrams of letters in the plain ones of ``words`` to ``table``, as often as each word occurs."""
    found = iter(words.items())
    while part := list(islice(found, WORDS_TOGETHER)):
        plain = [(c, n) for w, n in part if (c := TAIL.sub("", w)).isalpha()]
        if not plain:
            continue
        codes = _codes([w for w, _ in plain])
        # each trigram weighs as often as the word of its last letter; its edge goes with it
        owner = np.cumsum(np.r_[0, codes[:-1] == EDGE]) - 1
        many = np.array([n for _, n in plain], float)
        # the first letter's left context is the edge alone
        left = np.where(np.r_[EDGE, codes[:-1]] == EDGE, EDGE, np.r_[EDGE, EDGE, codes[:-2]])
        b = np.r_[EDGE, codes[:-1]]
        at = np.arange(1, len(codes))
        table += np.bincount((left[at] * SIZE + b[at]) * SIZE + codes[at], many[np.minimum(owner[at], len(many) - 1)], SIZE ** 3)


def train_characters(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """log P(c | a, b) of letters in the plain words of all rows: SIZE cubed numbers."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        table = np.zeros(SIZE ** 3)
        words: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                words.update(t.as_py().lower().split())
                if len(words) > WORDS_HELD:
                    _add_letters(words, table)
                    words.clear()
        _add_letters(words, table)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(table[at])], names=["k", "n"])

    rows = (df.filter(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string")).mapInArrow(count, "k int, n double")
            .groupBy("k").agg(F.sum("n").alias("n")).toArrow())  # SIZE cubed rows at most
    table = np.zeros(SIZE ** 3)
    table[rows.column("k").to_numpy()] = rows.column("n").to_numpy()
    table = table.reshape(SIZE, SIZE, SIZE)
    pair = (table.sum(0) + 1) / (table.sum((0, 2))[:, None] + SIZE)
    return np.log((table + 5 * pair) / (table.sum(2, keepdims=True) + 5))


def train(docs: DataFrame, labels: DataFrame, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", labelled: int = LABELLED) -> dict:
    """{"characters", "lexicon": word to share of toxic texts, "prior"}.

    The character model counts all rows of ``docs`` (within ``where``). The word
    scores come from about ``labelled`` different labelled texts, those that are first by
    a hash of the text; copies count once, a null label not at all. The lexicon holds every
    word of LEAST_SCORE that enough of their toxic texts have. Without labelled texts it is empty."""
    kept = (docs if where is None else docs.filter(where)).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    characters = train_characters(kept, "_text")
    truth = labels.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("y")).filter("y is not null and _id is not null")
    hashed = kept.withColumn("h", F.xxhash64(F.coalesce("_text", F.lit("")))).filter("_id is not null")
    texts = materialize(hashed.select("_id", "h").join(truth, "_id").groupBy("h").agg(F.min("_id").alias("_id"), F.min_by("y", "_id").alias("y")), "labelled")
    n = texts.count()
    share = min(1.0, labelled / n) if n else 0.0
    sample = texts.filter(F.pmod("h", F.lit(HASHES)) < math.ceil(share * HASHES))
    # word counts, their least number and the prior have one base: the sampled texts, each once
    n, toxic = sample.agg(F.count("*"), F.sum((F.col("y") > 0).cast("int"))).first()
    if not n:
        discard(texts)
        return {"characters": characters, "lexicon": {}, "prior": 0.0}
    rows = hashed.join(F.broadcast(sample), ["_id", "h"]).dropDuplicates(["h"]).select("_text", F.col("y").cast("int"))
    shared = docs.sparkSession.sparkContext.broadcast(characters)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        reader = Reader(shared.value)
        seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())], names=["w", "clean", "toxic"])
            seen.clear()
            return out

        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w in {w for _, ws in reader.tokens(t or "") for w in ws}:
                    seen[w][y > 0] += 1
                if len(seen) > CACHE_ENTRIES:
                    yield flush()
        yield flush()

    prior = float(toxic) / n
    score = (F.col("toxic") + PRIOR_TEXTS * prior) / (F.col("toxic") + F.col("clean") + PRIOR_TEXTS)
    words = (rows.mapInArrow(count, "w string, clean long, toxic long").groupBy("w").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .filter(F.col("toxic") >= max(LEAST_TEXTS, LEAST_SHARE * float(toxic))).select("w", "toxic", score.alias("p")).filter(F.col("p") >= LEAST_SCORE)
             .orderBy("w"))  # of the labelled sample alone, in LEAST_TEXTS of its toxic texts
    lexicon = {r["w"]: r["p"] for r in words.collect()}
    discard(texts)
    return {"characters": characters, "lexicon": lexicon, "prior": prior}


def score(df: DataFrame, model: dict, text_col: str = "text", names: tuple[str, str] = ("toxicity", "restored_words")) -> DataFrame:
    """Add toxicity (0 to 1) and restored_words (lexicon words that were
    disguised), or ``names``.

    toxicity is the chance that at least one of the text's scored words makes it
    toxic; without any, and for null and empty texts, a third of the prior. All
    rows, repeated ones too, and columns are kept; columns of these names are
    replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # SIZE cubed numbers and the words of :func:`train`

    def make():
        clear_worker()
        m = shared.value
        lexicon = m["lexicon"]
        reader = Reader(m["characters"], lexicon)

        def work(texts: list) -> list[list]:
            scores, words = [], []
            for t in texts:
                hits, disguised = reader.hits(t or "")
                scores.append(1 - math.prod(1 - lexicon[w] for w in sorted(hits)) if hits else m["prior"] / 3)
                words.append(disguised)
            return [scores, words]

        return work

    kinds = ("double", pa.float64()), (T.ArrayType(T.StringType()), pa.list_(pa.string()))
    return add_columns(df, dict(zip(names, kinds)), text_col, make)
