"""SentencePiece BPE: encoding by a table of distinct chunks, and decoding.

No piece of the vocabulary holds a whitespace marker after another character, so no merge
crosses the place before a marker that follows one: a text falls into *chunks*, a run of
markers and the characters up to the next marker, which are segmented independently. The texts of
a portion of rows are split into chunks, numbered in a table of the different ones; each of these is
segmented and decoded once, all of them side by side in arrays, and the documents get
ids and texts back by the positions of their chunks.

The table is one for about PORTION_BYTES of text, not for the corpus: so nothing is shuffled, no chunk is
hot, and a lost task repeats only its own rows. (A table of the corpus, joined back to blocks, would
move each portion's different chunks twice: about a fifth of all words in the given
documents.)
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.llm.bpe import add_columns
from rampart.llm.common import fresh

MARK = "▁"
PORTION_BYTES = 8 << 20  # of text that share a table of chunks
SHORT = 32               # characters, with the marker, of chunks that are merged side by side
SLOTS = 1 << 20          # of the table of pairs

_SPLIT = re.compile(f"([^{MARK}]){MARK}")


class PieceCodec:
    """The vocabulary of a model file and its merges. Characters outside it become byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        self.pieces = [sp.id_to_piece(i) for i in every]
        special = {i for i in every if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        self.ids = {self.pieces[i]: i for i in every if i not in special}
        self.scores = {self.pieces[i]: sp.get_score(i) for i in every if i not in special}
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i in every if sp.is_byte(i)}  # <0xNN>
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        crossing = [p for p in self.ids if _SPLIT.search(p)]
        if crossing or any(sp.is_unused(i) for i in every) or len(self.byte_ids) != 256:
            raise ValueError(f"the model needs byte pieces, no unused ones, and markers only in front: {crossing[:3]}")
        # what an id adds to a decoded text; bytes are put together first
        self.surface = [p.replace(MARK, " ") for p in self.pieces]
        for i in special:
            self.surface[i] = sp.decode([i]) if sp.is_unknown(i) else ""
        self.surfaces = pa.array(self.surface, pa.large_string())
        self.is_byte = np.zeros(len(self.pieces), bool)
        self.is_byte[list(self.bytes)] = True
        self._tables()

    def _tables(self) -> None:
        """Symbols (pieces by id, then further characters) and, by both symbols of a pair, the
        rank of the piece that they make."""
        symbol = dict(self.ids)
        for ch in set().union(*self.ids):
            symbol.setdefault(ch, len(self.pieces) + len(symbol))
        self.n_symbols = max(symbol.values()) + 2  # the last one: a character of no piece
        self.of_char = np.full(0x110000, self.n_symbols - 1, np.int32)
        for ch, i in symbol.items():
            if len(ch) == 1:
                self.of_char[ord(ch)] = i
        order = {s: r for r, s in enumerate(sorted({self.scores[p] for p in self.ids}, reverse=True))}
        self.rank = np.full(len(self.pieces), len(order), np.int64)  # equal scores, equal ranks
        for p, i in self.ids.items():
            self.rank[i] = order[self.scores[p]]
        keys, made = [], []
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * self.n_symbols + b)
                    made.append(i)
        left, value = np.array(keys, np.int64), np.array(made, np.int32)
        self.pair_keys, self.pair_made = np.full(SLOTS, -1, np.int64), np.full(SLOTS, -1, np.int32)
        slot = _slots(left)
        while len(left):  # open addressing: one pair takes a free slot, the rest go on to the next
            free = self.pair_keys[slot] < 0
            self.pair_keys[slot[free]], self.pair_made[slot[free]] = left[free], value[free]
            rest = self.pair_keys[slot] != left
            left, value, slot = left[rest], value[rest], (slot[rest] + 1) % SLOTS

    def _made_by(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        key = a.astype(np.int64) * self.n_symbols + b
        slot = _slots(key)
        got = self.pair_keys[slot]
        out = np.where(got == key, self.pair_made[slot], -1)
        on = np.flatnonzero((got != key) & (got >= 0))
        while len(on):
            slot[on] = (slot[on] + 1) % SLOTS
            got = self.pair_keys[slot[on]]
            hit = got == key[on]
            out[on[hit]] = self.pair_made[slot[on[hit]]]
            on = on[~hit & (got >= 0)]
        return out

    # ---- encoding

    def segment_all(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, one after another; their numbers) of chunks given without
        their first marker."""
        long = [k for k, w in enumerate(keys) if len(w) >= SHORT]
        words = list(keys)
        for k in long:
            words[k] = ""
        symbols, chars, sizes = self._merge_side_by_side(words)
        # a symbol is an id, or a character of no piece, which becomes bytes
        odd = np.flatnonzero(symbols >= len(self.pieces))
        many = np.ones(len(symbols), np.int64)
        spelled = {k: [self.byte_ids[b] for b in chr(c).encode()] for k, c in zip(odd.tolist(), chars[odd].tolist())}
        many[odd] = [len(spelled[k]) for k in odd.tolist()]
        ids = np.repeat(symbols, many)
        starts = np.cumsum(many) - many
        for k, s in spelled.items():
            ids[starts[k]:starts[k] + len(s)] = s
        upto = np.r_[0, np.cumsum(many)][np.r_[0, np.cumsum(sizes)]]
        sizes = np.diff(upto)
        if long:
            ends = np.cumsum(sizes)
            parts, upto = [], 0
            for k in long:  # in the place of the marker alone
                whole = np.array(self.segment(MARK + keys[k]), np.int32)
                parts += [ids[upto:ends[k] - sizes[k]], whole]
                upto, sizes[k] = ends[k], len(whole)
            ids = np.concatenate([*parts, ids[upto:]])
        return ids, sizes

    def _merge_side_by_side(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, their first characters, symbols of each word): in each round every word
        that has a pair left merges its best one, the leftmost of equal ones."""
        text = MARK + MARK.join(words)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) if words else np.zeros(0, np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        symbols = self.of_char[chars]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, ...]] = []
        while len(symbols):
            made = self._made_by(symbols[:-1], symbols[1:])
            made[word[:-1] != word[1:]] = -1
            at = np.flatnonzero(made >= 0)
            if not len(at):
                break
            key = self.rank[made[at]] << 40 | at
            head = np.flatnonzero(np.r_[True, word[at[1:]] != word[at[:-1]]])
            best = np.minimum.reduceat(key, head) & (1 << 40) - 1
            symbols[best] = made[best]
            keep = np.ones(len(symbols), bool)
            keep[best + 1] = False
            active = np.zeros(len(words), bool)
            active[word[best]] = True
            going = active[word]
            if going.sum() < len(going) // 2:  # words without a pair leave
                off = ~going
                done.append((symbols[off], chars[off], word[off]))
                keep &= going
            symbols, chars, word = symbols[keep], chars[keep], word[keep]
        done.append((symbols, chars, word))
        symbols, chars, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbols[order], chars[order], np.bincount(word, minlength=len(words))

    def segment(self, chunk: str) -> list[int]:
        """Ids of one chunk: the pair whose piece has the best score is merged, the
        leftmost of equal ones, until no pair is a piece."""
        out: list[int] = []
        for p in self._merge_long(list(chunk)):
            i = self.ids.get(p)
            if i is None:
                out += [self.byte_ids[b] for b in p.encode()]
            else:
                out.append(i)
        return out

    def _merge_long(self, parts: list[str]) -> list[str]:
        """By a queue of pairs over a linked list: n log n steps."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n:
                pair = parts[a] + parts[b]
                s = self.scores.get(pair)
                if s is not None:
                    heapq.heappush(queue, (-s, a, pair))

        for k in range(n - 1):
            offer(k, k + 1)
        while queue:
            _, a, pair = heapq.heappop(queue)
            b = after[a]
            if b >= n or not parts[a] or parts[a] + parts[b] != pair:
                continue  # one of them has been merged meanwhile
            parts[a], parts[b] = pair, ""
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [p for p in parts if p]

    # ---- decoding

    def text_of(self, ids: Iterable[int]) -> str:
        """Surfaces of ids, markers as spaces, runs of byte pieces as UTF-8; a byte that
        is no part of a character becomes U+FFFD."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            b = self.bytes.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(_characters(bytes(run)))
                run.clear()
            out.append(self.surface[i])
        out.append(_characters(bytes(run)))
        return "".join(out)

    def texts_of(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """:meth:`text_of` of many lists of ids, given one after another."""
        ends = np.cumsum(sizes)
        out = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.r_[0, ends], pa.int64()), self.surfaces.take(pa.array(ids))), pa.scalar("", pa.large_string()))
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(self.is_byte[ids]), side="right"))
        if not len(odd):
            return out
        mask = np.zeros(len(sizes), bool)
        mask[odd] = True
        return pc.replace_with_mask(out, pa.array(mask), pa.array([self.text_of(ids[ends[k] - sizes[k]:ends[k]].tolist()) for k in odd], pa.large_string()))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of any ids: the marker in front of the first visible piece is no space."""
        ids = list(ids)
        first = next((k for k, i in enumerate(ids) if i in self.bytes or self.surface[i]), len(ids))
        text = self.text_of(ids[first:])
        return text[1:] if first < len(ids) and self.pieces[ids[first]].startswith(MARK) else text


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)  # of 2**20


def _characters(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, k = [], 0
    while k < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[k:k + size].decode())
                break
            except UnicodeDecodeError:
                pass
        else:
            size = 1
            out.append("�")
        k += size
    return "".join(out)


@lru_cache(maxsize=4)
def codec(path: str) -> PieceCodec:
    """One codec for each worker and file."""
    return PieceCodec(path)


# ---- the table of distinct chunks --------------------------------------------------


def separated(text: str) -> str:
    """``text`` with one space between its chunks, each without the first of its markers.
    Spaces are markers, and one more is set in front; texts of single spaces are so already."""
    if "  " not in text and MARK not in text and text[:1] != " ":
        return text
    return _SPLIT.sub(r"\1 ", MARK + text.replace(" ", MARK))[1:]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every range, one range after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _encode_portion(c: PieceCodec, texts: list[str | None], decoded: bool) -> list[pa.Array]:
    """Ids of each text (a list array) and, if asked for, the text decoded from them."""
    full = np.array([bool(t) for t in texts], bool)
    split = pc.split_pattern(pa.array([separated(t) for t in texts if t], pa.large_string()), " ")
    counts = np.zeros(len(texts), np.int64)  # an empty text has no chunk; a space alone has one, of two markers
    counts[full] = np.diff(split.offsets.to_numpy())
    found = split.flatten().dictionary_encode()
    codes = found.indices.to_numpy()
    ids, sizes = c.segment_all(found.dictionary.to_pylist())
    starts = np.cumsum(sizes) - sizes
    flat = ids[_ranges(starts[codes], sizes[codes])]
    last = np.cumsum(counts)
    out = [pa.ListArray.from_arrays(pa.array(np.r_[0, np.r_[0, np.cumsum(sizes[codes])][last]], pa.int32()), pa.array(flat, pa.int32()))]
    if decoded:
        surfaces = c.texts_of(ids, sizes).take(pa.array(codes))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.r_[0, last], pa.int64()), surfaces), pa.scalar("", pa.large_string()))
        out.append(pc.utf8_slice_codeunits(joined, 1).cast(pa.string()))  # without the marker set in front
    return out


def _portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about PORTION_BYTES of text, one row at least."""
    start = total = 0
    for k, n in enumerate(sizes):
        if k > start and total + n > PORTION_BYTES:
            yield start, k
            start, total = k, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def piece_encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``df`` without ``text_col``, with ``ids_col`` (array of int) and, if named, ``decoded_col``
    (the ids decoded again), at the end. A null or empty text gives no ids and an empty text;
    a long one is encoded whole. Repeated rows and all other columns are kept; a column that has a
    new one's name is replaced. An empty table gives an empty one."""
    src = df.select(*[c for c in df.columns if c == text_col or c not in (ids_col, decoded_col)])
    at = src.columns.index(text_col)
    kept = [i for i in range(len(src.columns)) if i != at]
    new = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded_col, T.StringType())] if decoded_col else [])
    schema = T.StructType([src.schema.fields[i] for i in kept] + new)

    def encoded(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = whole.column(at)
        for a, b in _portions(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
            part = whole.slice(a, b - a).combine_chunks()
            extra = _encode_portion(codec(path), part.column(at).to_pylist(), decoded_col is not None)
            yield from pa.Table.from_arrays([*(part.column(i) for i in kept), *extra], names=schema.names).to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            held.append(b)
            size += b.column(at).nbytes
            if size >= PORTION_BYTES:
                yield from encoded(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield from encoded(pa.Table.from_batches(held))

    return src.mapInArrow(run, schema)


def piece_decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add ``text_col``: the decoded text of ``ids_col`` (array of int); null gives an empty
    text. A column that has its name is replaced."""
    return add_columns(df, {text_col: ("string", pa.string())}, ids_col, lambda: lambda ids: [[codec(path).decode(i or ()) for i in ids]])


def piece_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and the digests of ids (decimal, joined by commas) and decoded text
    for each row."""
    (key,) = fresh(df, "_key")
    out = piece_encode(df.select(F.col(id_col).alias(key), F.col(text_col).alias("text")), path, decoded_col="decoded")
    return out.select(F.col(key).alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
