"""BPE encoding and decoding with forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be spanned by a
merge, so a word is cut there for certain; the fragments are encoded independently
and their ids concatenated. Words not yet in a worker's bounded cache are encoded
together, in array operations. No shuffle: one pass over the texts.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.llm.common import release

CACHE_ENTRIES = 700_000  # in each worker
SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != "\n"]  # all that str.split cuts at, but line breaks

LINE = ord("\n")
# kinds of code points, where the Split pattern has no exceptions; the last is for all that follow
ODD, LETTER, NUMBER, OTHER, BREAK = range(5)
KINDS = np.array([BREAK if c == "\n" else ODD if c == "'" or c.isspace() else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER)
                  for c in map(chr, range(0x250))] + [ODD], np.uint8)


def byte_symbols() -> list[str]:
    """Byte-level BPE's printable stand-in for each byte, by the public rule."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in keep}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class PairTable:
    """Ranks of pairs, keyed a * size + b in 32 bits, found without a search: the high bits of a
    mixed key name a bucket, whose shift moves its low bits to a place of the key's own."""

    BITS, MIX = 18, np.uint32(0x9E3779B1)  # odd: different keys stay different when mixed

    def __init__(self, ranks: dict[int, int], size: int, none: int):
        self.size, self.none, places = np.uint32(size), np.int32(none), 1 << self.BITS
        self.shift = np.zeros(1 << 32 - self.BITS, np.uint32)
        self.keys, self.ranks = np.zeros(places, np.uint32), np.full(places, none, np.int32)
        keys, taken = np.fromiter(ranks, np.uint32, len(ranks)), bytearray(places)
        mixed = keys * self.MIX
        buckets: dict[int, list[int]] = {}
        for m in mixed.tolist():
            buckets.setdefault(m >> self.BITS, []).append(m & places - 1)
        for bucket, low in sorted(buckets.items(), key=lambda x: -len(x[1])):  # the fullest first
            shift = next(s for s in range(places) if not any(taken[x ^ s] for x in low))
            self.shift[bucket] = shift
            for x in low:
                taken[x ^ shift] = 1
        at = self._places(keys)
        self.keys[at], self.ranks[at] = keys, np.fromiter(ranks.values(), np.int32, len(ranks))

    def _places(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * self.MIX
        return mixed & np.uint32((1 << self.BITS) - 1) ^ self.shift[mixed >> np.uint32(self.BITS)]

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = self._places(keys)
        return np.where(self.keys[at] == keys, self.ranks[at], self.none)


class SortedPairs:
    """The same by binary search, for vocabularies that :class:`PairTable` doesn't hold."""

    def __init__(self, ranks: dict[int, int], size: int, none: int):
        self.size, self.none = np.uint64(size), np.int32(none)
        by_key = sorted(ranks.items())
        self.keys, self.ranks = np.array([k for k, _ in by_key], np.uint64), np.array([r for _, r in by_key], np.int32)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], self.none)


def pair_ranks(ranks: dict[int, int], size: int, none: int) -> PairTable | SortedPairs:
    """Finds the ranks of pairs in arrays; ``none`` where there is no merge."""
    held = size <= 1 << 16 and len(ranks) <= 1 << PairTable.BITS - 1
    return (PairTable if held else SortedPairs)(ranks, size, none)


class BpeCodec:
    """Encoder and decoder read from a tokenizers JSON file.

    Understands what such a file states for word-level BPE: the normalizers NFC,
    Replace and Lowercase, a Split pattern before ByteLevel, an end-of-word
    suffix, and special tokens matched in the raw text. Anything else raises
    ValueError rather than giving other ids than the library. (Characters newer
    than the library's Unicode tables may count as letters here already.)"""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        norms = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if (model["type"], split["type"], level["type"], norms) != ("BPE", "Split", "ByteLevel", ["NFC", "Replace", "Lowercase"]) \
                or model.get("ignore_merges") or model.get("dropout") or level["use_regex"] or spec.get("decoder"):
            raise ValueError(f"{path}: this kind of tokenizer file is not supported")
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.tokens = [""] * size
        for t, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = t
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.uint32)
        self.last = np.array([vocab[s + self.suffix] for s in symbols], np.uint32)
        # merges by a * size + b, as ranks; the token that a rank's merge makes
        self.size = size
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        self.ranks = {vocab[a] * size + vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self._rank = pair_ranks(self.ranks, size, len(self.made)).of
        self.byte_ranks = self._rank(self.first[:, None], np.r_[self.first, self.last])  # of two bytes; 256 more: the second ends the word
        # inside[a, b]: byte b follows byte a inside some token
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.inside = np.zeros((256, 256), bool)
        for t in vocab:
            body = t.removesuffix(self.suffix) if self.suffix else t
            known = [byte_of[c] for c in body if c in byte_of]
            self.inside[known[:-1], known[1:]] = True
        self._chunks: dict[str, bytes] = {}

    # -- encoding -------------------------------------------------------------

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word's start (and the last ends)."""
        raw = np.frombuffer("\n".join([*words, ""]).encode(), np.uint8)  # no word holds white space
        ends = raw == LINE
        return self._encode_bytes(raw[~ends], np.flatnonzero(ends) - np.arange(len(words)))

    def _encode_bytes(self, raw: np.ndarray, word_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same from the words' bytes, one after the other, and where each ends."""
        # cut after a word's last byte and where no token spans the pair
        cut = np.ones(len(raw), bool)
        cut[:-1] = ~self.inside[raw[:-1], raw[1:]]
        cut[word_ends - 1] = True
        ends = np.flatnonzero(cut) + 1
        starts = np.r_[0, ends[:-1]]
        closes = np.zeros(len(raw) + 1, bool)
        closes[word_ends] = True
        symbols = np.where(closes[1:], self.last[raw], self.first[raw])
        ranks = np.full(len(raw), len(self.made), np.int32)  # of the pair that starts at each byte
        ranks[:-1] = self.byte_ranks[raw[:-1], raw[1:] + 256 * closes[2:]]
        ids = np.full(len(raw), -1, np.int32)  # a fragment's ids stand from its start on
        sizes = ends - starts
        one = starts[sizes == 1]
        ids[one] = symbols[one]
        for low, high in (*zip(range(1, 12), range(2, 13)), (12, 14), (14, 16), (16, 40)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if len(rows):
                self._merge_rows(symbols, ranks, starts[rows], sizes[rows], ids)
        for r in np.flatnonzero(sizes > 40):
            out = self._merge_long(symbols[starts[r]:ends[r]].tolist())
            ids[starts[r]:starts[r] + len(out)] = out
        kept = ids >= 0
        return ids[kept], np.r_[0, np.cumsum(kept)[word_ends - 1]]

    def _merge_rows(self, symbols: np.ndarray, first_ranks: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Merge all fragments side by side: each round makes every fragment's merge
        of the lowest rank, leftmost first, until no fragment has one."""
        none, width = np.int32(len(self.made)), int(sizes.max())
        at = np.arange(width)
        place = np.minimum(starts[:, None] + at, len(symbols) - 1)
        sym = symbols[place]
        ranks = np.where(at < sizes[:, None] - 1, first_ranks[place], none)
        while len(sym):
            j = ranks.argmin(1)
            row = np.arange(len(sym))
            low = ranks[row, j]
            done = low == none
            if done.any():
                n = sizes[done]
                valid = at[:sym.shape[1]] < n[:, None]
                ids[(starts[done][:, None] + at[:sym.shape[1]])[valid]] = sym[done][valid]
                keep = ~done
                sym, ranks, starts, sizes, j, low = sym[keep], ranks[keep], starts[keep], sizes[keep], j[keep], low[keep]
                row = np.arange(len(sym))
                if not len(sym):
                    return
            sym[row, j] = self.made[low]
            left = at[:sym.shape[1]].astype(j.dtype)
            sym = sym[left != (j + 1)[:, None]].reshape(len(sym), -1)
            ranks = ranks[left != j[:, None]].reshape(len(sym), -1)
            sizes = sizes - 1
            right = np.flatnonzero(j < sizes - 1)
            to = j[right]
            ranks[right, to] = self._rank(sym[right, to], sym[right, to + 1])
            last = np.flatnonzero(j >= sizes - 1)
            inner = last[j[last] < ranks.shape[1]]
            ranks[inner, j[inner]] = none
            left = np.flatnonzero(j > 0)
            to = j[left]
            ranks[left, to - 1] = self._rank(sym[left, to - 1], sym[left, to])

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for one long fragment, by a heap over linked symbols, in n log n."""
        n, size, get, made = len(ids), self.size, self.ranks.get, self.made.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get(ids[i] * size + ids[k])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := get(ids[h] * size + ids[i])) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def _split(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """The words of chunks (text without white space), and how many there are up to each chunk's end."""
        words: list[str] = []
        upto = []
        for c in chunks:
            if c.isalpha():  # all letters: one word for the pattern
                words.append(c)
            elif c[-1] in ".,;:!?" and c[:-1].isalpha():
                words += (c[:-1], c[-1])
            else:
                words += self.pattern.findall(c)
            upto.append(len(words))
        return words, upto

    def _encode_all(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after the other, and how many each has. Where every character's kind is
        known, a word is a run of letters, a number or a run of others; the rest is for :meth:`_split`."""
        points, kinds, ends = self._points(chunks)
        odd = np.diff(np.cumsum(kinds == ODD)[ends], prepend=0) > 0
        lines = np.ones(len(chunks), np.int64)
        if odd.any():
            at = np.flatnonzero(odd).tolist()
            words, upto = self._split([chunks[i] for i in at])
            lines[at] = np.diff(upto, prepend=0)
            chunks = list(chunks)
            for i, a, b in zip(at, [0, *upto], upto):
                chunks[i] = "\n".join(words[a:b])
            points, kinds, ends = self._points([c for c in chunks if c])
            split = np.repeat(np.repeat(odd, lines), np.diff(ends, prepend=-1))  # characters of what is split
            kinds[split & (points != LINE)] = ODD
        last = kinds != np.r_[kinds[1:], ODD]  # of a word
        last |= kinds == NUMBER
        last &= points != LINE
        sizes = 1 + (points >= 1 << 7) + (points >= 1 << 11) + (points >= 1 << 16) - (points == LINE)  # in UTF-8
        raw = np.frombuffer("".join(chunks).replace("\n", "").encode(), np.uint8)
        ids, bounds = self._encode_bytes(raw, np.cumsum(sizes)[last])
        words = np.r_[0, np.cumsum(last)[ends]][np.cumsum(lines)]  # up to each chunk's end
        return ids, np.diff(bounds[words], prepend=0)

    def _points(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of lines, a line break after each; their kinds; where the breaks are."""
        points = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le"), np.uint32)
        return points, KINDS.take(points, mode="clip"), np.flatnonzero(points == LINE)

    def _encode_chunks(self, chunks: list[str]) -> None:
        """Put the ids of chunks into the cache."""
        words, upto = self._split(chunks)
        if words:
            ids, bounds = self._encode_words(words)
            flat = ids.astype("<u4").tobytes()
            a = 0
            for c, b in zip(chunks, (bounds[upto] * 4).tolist()):
                self._chunks[c] = flat[a:b]
                a = b

    def _normal(self, text: str) -> str:
        text = text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()  # by characters: a final capital sigma has no form of its own

    def _spaced(self, text: str) -> list[str]:
        text = self._normal(text)
        # str.split also splits at four separators that the file's \s leaves alone
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in regex.split(r"\s+", text) if c]
        return text.split()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null gives none."""
        parts: list[tuple[int, list[str], bytes]] = []  # of texts: chunks, or a special token's id
        for i, t in enumerate(texts):
            if not t or not any(s in t for s in self.specials):
                parts.append((i, self._spaced(t or ""), b""))
                continue
            for p in self.special_re.split(t):
                special = self.specials.get(p)
                parts.append((i, self._spaced(p), b"") if special is None else (i, [], special.to_bytes(4, "little")))
        flat = list(chain.from_iterable(p for _, p, _ in parts))
        ids = list(map(self._chunks.get, flat))
        missing = [k for k, i in enumerate(ids) if i is None]
        new = list({flat[k] for k in missing})
        if len(self._chunks) + len(new) > CACHE_ENTRIES:
            self._chunks = {}
        self._encode_chunks(new)
        for k in missing:
            ids[k] = self._chunks[flat[k]]
        out, a = [b""] * len(texts), 0
        for i, p, special in parts:
            out[i] += special or b"".join(ids[a:a + len(p)])
            a += len(p)
        return out

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has: those of :meth:`encode_batch`, all
        made at once and without the cache, which words that are all different fill for little."""
        whole, odd = "\n".join(words), []
        # normalization joins or moves nothing across a line break; special tokens and words that are empty or hold white space go apart
        chunks = self._normal(whole).split("\n") if words else []
        if "<|" in whole or len(chunks) != len(words) or not all(words) or any(c in whole for c in SPACES):
            odd = [i for i, w in enumerate(words) if "<|" in w or w.split() != [w]]
            plain = np.delete(np.array(words, object), odd).tolist()
            chunks = self._normal("\n".join(plain)).split("\n") if plain else []
        ids, sizes = self._encode_all(chunks) if chunks else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        if not odd:
            return ids, sizes
        found = [np.frombuffer(b, "<u4").astype(np.int32) for b in self.encode_batch([words[i] for i in odd])]
        apart = np.zeros(len(words), bool)
        apart[odd] = True
        every = np.zeros(len(words), np.int64)
        every[apart], every[~apart] = list(map(len, found)), sizes
        at = np.repeat(apart, every)
        out = np.zeros(len(at), np.int32)
        out[at], out[~at] = np.concatenate(found), ids
        return out, every

    def encode_words(self, words: list[str]) -> list[bytes]:
        """As :meth:`encode_batch`, by :meth:`word_ids`."""
        ids, sizes = self.word_ids(words)
        flat, ends = ids.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, text: str | None) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> str:
        """The tokens joined by spaces, as a file without a decoder states."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def codec(path: str) -> BpeCodec:
    """One codec for each worker and file."""
    return BpeCodec(path)


def clear_worker() -> None:
    """Gives back what a worker's former tasks hold, codecs and their caches of words, too: for
    tasks that use none and fill memory of their own."""
    codec.cache_clear()
    release()


def add_columns(df: DataFrame, columns: dict[str, tuple[str | T.DataType, pa.DataType]], source: str, make, rows: int = 512) -> DataFrame:
    """``df`` with new columns (name: Spark type, Arrow type). ``make()`` gives a
    worker's function from values of the column ``source``, up to ``rows``, to the
    new columns' lists. A column of ``df`` that has a new one's name is replaced,
    at the end."""
    at = df.columns.index(source)
    kept = [i for i, c in enumerate(df.columns) if c not in columns]
    schema = T.StructType([df.schema.fields[i] for i in kept])
    for name, (kind, _) in columns.items():
        schema.add(name, kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        work = make()
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                b = whole.slice(start, rows)
                extra = [pa.array(v, t) for v, (_, t) in zip(work(b.column(at).to_pylist()), columns.values())]
                fields = [*(b.schema.field(i) for i in kept), *(pa.field(n, t) for n, (_, t) in columns.items())]
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *extra], schema=pa.schema(fields))

    return df.mapInArrow(run, schema)


def bpe_encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """Add ``ids_col`` (binary, little-endian unsigned 32-bit ids) and, if named,
    ``decoded_col`` (the ids decoded again). A null or empty text gives no ids;
    a long one is encoded whole. All other columns and rows, repeated ones too,
    are kept; a column that has a new one's name is replaced."""
    columns = {ids_col: ("binary", pa.binary())} | ({decoded_col: ("string", pa.string())} if decoded_col else {})

    def make():
        c = codec(path)

        def work(texts: list) -> list[list]:
            ids = c.encode_batch(texts)
            return [ids, [c.decode(i) for i in ids]] if decoded_col else [ids]

        return work

    return add_columns(df, columns, text_col, make)


def bpe_decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col``: the decoded text of ``ids_col``; null ids give an empty
    text. A column that has its name is replaced."""
    return add_columns(df, {text_col: ("string", pa.string())}, ids_col, lambda: lambda ids: [[codec(path).decode(i or b"") for i in ids]])


def token_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and the digests of ids and decoded text for each row."""
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = bpe_encode(src, path, decoded_col="decoded")
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
