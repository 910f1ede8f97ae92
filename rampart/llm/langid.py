"""Language identification of mixed text.

The script of a word (by ranges of code points) narrows the languages it may
have to those written in it; hashed character n-grams score the word in each;
Viterbi with a penalty for switching labels every word of the text, so that spans
of other languages come out. The counts come from all training rows; the model is
a table of BUCKETS rows and one column a language, whatever the corpus size.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.llm.bpe import add_columns, clear_worker
from rampart.llm.common import discard, materialize

BUCKETS = 1 << 16
MAX_LANGUAGES = 1000
PENALTY = 8.0       # nats for a switch of language between words
WORD_LIMIT = 10.0   # no word counts more than this against a language
CACHE_ENTRIES = 300_000

#: First and last code point of letters, by script (Unicode blocks).
SCRIPTS = [
    (0x0041, 0x024F, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"), (0x0530, 0x058F, "armenian"),
    (0x0590, 0x05FF, "hebrew"), (0x0600, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"),
    (0x0A00, 0x0A7F, "gurmukhi"), (0x0A80, 0x0AFF, "gujarati"), (0x0B80, 0x0BFF, "tamil"), (0x0C00, 0x0C7F, "telugu"),
    (0x0C80, 0x0CFF, "kannada"), (0x0D00, 0x0D7F, "malayalam"), (0x0E00, 0x0E7F, "thai"), (0x0E80, 0x0EFF, "lao"),
    (0x10A0, 0x10FF, "georgian"), (0x1100, 0x11FF, "hangul"), (0x1200, 0x137F, "ethiopic"), (0x1780, 0x17FF, "khmer"),
    (0x1E00, 0x1EFF, "latin"), (0x1F00, 0x1FFF, "greek"), (0x3040, 0x30FF, "kana"), (0x3400, 0x9FFF, "han"),
    (0xAC00, 0xD7AF, "hangul"),
]
NAMES = sorted({s for _, _, s in SCRIPTS}) + ["other"]
_STARTS = [a for a, _, _ in SCRIPTS]


def script_of(word: str) -> int:
    """The script of a word's first letter, as a place in NAMES; -1 without a letter."""
    for c in word:
        if c.isalpha():
            at = bisect_right(_STARTS, ord(c)) - 1
            return NAMES.index(SCRIPTS[at][2]) if at >= 0 and ord(c) <= SCRIPTS[at][1] else len(NAMES) - 1
    return -1


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every hashed n-gram of 1 to 3 characters, word ends included."""
    text = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    gap = text == 0
    word = np.cumsum(gap) - 1
    out_word, out_hash = [], []
    h = np.zeros(len(text), np.uint64)
    inside = ~gap
    for n in range(1, 4):
        # n-grams that start at each place; only the ends of one may be a word's edge
        m = len(text) - n + 1
        h = (h[:m] + np.uint64(n) + text[n - 1:]) * np.uint64(0x9E3779B97F4A7C15)
        h = h ^ h >> np.uint64(29)
        if n == 1:
            ok = inside
        elif n == 2:
            ok = inside[:-1] | inside[1:]
        else:
            ok = inside[1:-1]
        at = np.flatnonzero(ok[:m])
        # a leading edge belongs to the word after it: word[] counts it so already
        out_word.append(word[at])
        out_hash.append((h[at] >> np.uint64(40)).astype(np.int64) % BUCKETS)
    return np.concatenate(out_word), np.concatenate(out_hash)


def _words(text: str) -> list[str]:
    return (text.replace("\0", " ") if "\0" in text else text).lower().split()


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", where: Column | None = None) -> dict:
    """The model of all rows with a text and a language (within ``where``).

    {"langs": sorted labels, "scores": float32 log probability by bucket and
    label, "scripts": share of each script by label}. An empty table gives a
    model without languages; more than MAX_LANGUAGES labels raise ValueError."""
    src = df.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    src = (src if where is None else src.filter(where)).select(F.col(lang_col).cast("string").alias("l"), F.col(text_col).cast("string").alias("t"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_worker()
        seen: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in seen.items():
                table = np.zeros(BUCKETS + len(NAMES), np.int64)
                words, many = list(counter), np.fromiter(counter.values(), np.int64)
                for k in range(0, len(words), 50_000):
                    part, n = words[k:k + 50_000], many[k:k + 50_000]
                    word, bucket = features(part)
                    scripts = np.array([script_of(w) for w in part])
                    table[:BUCKETS] += np.bincount(bucket, n[word], BUCKETS).astype(np.int64)
                    table[BUCKETS:] += np.bincount(scripts[scripts >= 0], n[scripts >= 0], len(NAMES)).astype(np.int64)
                at = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(table[at])], names=["l", "bucket", "n"])
            seen.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[lang].update(_words(text))
                if sum(map(len, seen.values())) > CACHE_ENTRIES or len(seen) > 50:
                    yield from flush()
        yield from flush()

    counts = materialize(src.mapInArrow(count, "l string, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")), "lang-counts")
    langs = sorted(r[0] for r in counts.filter(F.col("bucket") >= BUCKETS).select("l").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different languages")
    table = np.zeros((BUCKETS + len(NAMES), len(langs)))
    found = counts.filter(F.col("l").isin(langs)).toArrow() if langs else None  # BUCKETS rows a language at most
    if found is not None:
        place = {lang: i for i, lang in enumerate(langs)}
        table[found.column("bucket").to_numpy(), [place[x] for x in found.column("l").to_pylist()]] = found.column("n").to_numpy()
    discard(counts)
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    share = (grams + 0.1) / (grams.sum(0) + 0.1 * BUCKETS)
    return {"langs": langs, "scores": np.log(share).astype(np.float32), "scripts": scripts / np.maximum(scripts.sum(0), 1)}


class Labeller:
    """Labels the words of texts with a model of :func:`train`."""

    def __init__(self, model: dict, penalty: float = PENALTY):
        self.langs, self.model, self.penalty = model["langs"], model, penalty
        # a script allows the languages that have 1 % of their words in it; if none has, all
        allowed = model["scripts"] >= 0.01
        self.allowed = np.where(allowed.any(1, keepdims=True), allowed, True)
        self.known: dict[str, int] = {}
        self.table = np.zeros((1, len(self.langs)), np.float32)
        self.lettered = np.zeros(1, bool)

    def _learn(self, words: list[str]) -> None:
        scores = np.zeros((len(words), len(self.langs)), np.float32)
        for k in range(0, len(words), 20_000):
            word, bucket = features(words[k:k + 20_000])
            grams = self.model["scores"][bucket]
            for j in range(len(self.langs)):
                scores[k:k + 20_000, j] = np.bincount(word, grams[:, j], minlength=len(words[k:k + 20_000]))[:len(words[k:k + 20_000])]
        scripts = np.array([script_of(w) for w in words])
        if self.langs:
            scores = np.where(self.allowed[scripts], scores, -np.inf)
            scores = np.maximum(scores - scores.max(1, keepdims=True), -WORD_LIMIT)
        scores[scripts < 0] = 0  # nothing to go by
        base = len(self.table)
        self.known.update(zip(words, range(base, base + len(words))))
        self.table = np.concatenate([self.table, scores])
        self.lettered = np.concatenate([self.lettered, scripts >= 0])

    def label(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(language of each word, whether the word has a letter) for each text."""
        split = [_words(t) for t in texts]
        new = [w for w in set().union(*split) if w not in self.known]
        if len(self.known) + len(new) > CACHE_ENTRIES:
            self.known, self.table, self.lettered = {}, self.table[:1], self.lettered[:1]
            new = list(set().union(*split))
        if new:
            self._learn(new)
        order = sorted(range(len(texts)), key=lambda i: -len(split[i]))
        sizes = np.array([len(split[i]) for i in order])
        get = self.known.__getitem__
        flat = np.fromiter((x for i in order for x in map(get, split[i])), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        path = np.zeros(len(flat), np.int32)
        back = np.zeros((len(flat), len(self.langs)), np.int16)
        if len(flat) and self.langs:
            # all texts step on together; the longest come first, so those left are a prefix
            steps = int(sizes[0])
            active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(steps), side="right")
            stay = np.arange(len(self.langs), dtype=np.int16)
            best = np.zeros((len(sizes), len(self.langs)), np.float32)
            for t in range(steps):
                a = active[t]
                at = starts[:a] + t
                b = best[:a]
                top = b.argmax(1)
                jump = b[np.arange(a), top] - self.penalty
                moves = jump[:, None] > b
                back[at] = np.where(moves, top[:, None], stay)
                best[:a] = np.where(moves, jump[:, None], b) + self.table[flat[at]]
            state = best.argmax(1)
            for t in range(steps - 1, -1, -1):
                a = active[t]
                at = starts[:a] + t
                path[at] = state[:a]
                state[:a] = back[at, state[:a]]
        out: list = [None] * len(texts)
        for i, s, n in zip(order, starts.tolist(), sizes.tolist()):
            out[i] = (path[s:s + n], self.lettered[flat[s:s + n]])
        return out


SPANS = T.ArrayType(T.StructType([T.StructField("first_word", T.IntegerType()), T.StructField("last_word", T.IntegerType()), T.StructField("lang", T.StringType())]))
_SPANS = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("lang", pa.string())]))
LABEL_WORDS = 400_000  # labelled together


def identify(df: DataFrame, model: dict, text_col: str = "text", penalty: float = PENALTY,
             names: tuple[str, str, str] = ("lang_pred", "score", "lang_spans")) -> DataFrame:
    """Add lang_pred, score and lang_spans (or ``names``) to every row.

    lang_spans are runs of words of one language (places from 0). lang_pred has
    most of the lettered words, ties going to the first in order; score is its
    share of them. A null, empty or letterless text, or a model without
    languages, gives ``und``, 0 and no spans. Columns that have these names
    are replaced; everything else, repeated rows too, is kept as it is."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages

    def verdict(langs: list[str], path: np.ndarray, lettered: np.ndarray):
        votes = np.bincount(path[lettered], minlength=len(langs)) if langs else np.zeros(0)
        if not votes.sum():
            return "und", 0.0, []
        edge = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
        last = np.r_[edge[1:], len(path)] - 1
        spans = [{"first_word": a, "last_word": b, "lang": langs[p]} for a, b, p in zip(edge.tolist(), last.tolist(), path[edge].tolist())]
        return langs[int(votes.argmax())], float(votes.max() / votes.sum()), spans

    def make():
        clear_worker()
        labeller = Labeller(shared.value, penalty)

        def work(texts: list) -> list[tuple]:
            texts = [t or "" for t in texts]
            out: list = [None] * len(texts)
            part: list[int] = []
            size = 0
            for i in [*sorted(range(len(texts)), key=lambda i: len(texts[i])), None]:  # texts of like length together
                if i is None or part and size + len(texts[i]) > 6 * LABEL_WORDS:
                    for j, (path, lettered) in zip(part, labeller.label([texts[j] for j in part])):
                        out[j] = verdict(labeller.langs, path, lettered)
                    part, size = [], 0
                if i is not None:
                    part.append(i)
                    size += len(texts[i])
            return list(zip(*out))

        return work

    return add_columns(df, dict(zip(names, (("string", pa.string()), ("double", pa.float64()), (SPANS, _SPANS)))), text_col, make, rows=10_000)
