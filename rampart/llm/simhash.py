"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints of 64 bits link at ``distance`` (at most 3) differing bits. Cut one
into four blocks of 16: three errors leave a block without any, whose value is
the exact part of the key. The other 48 bits make two segments of 24; one of
them has at most one error. Its first 23 bits are decoded with the perfect binary
Golay code (23,12): the key carries the index of a codeword within 4 bits of the
segment - one of up to six, the nearest and, on the border of its sphere, the
five next. Words one bit apart always share such a codeword: what is within 3 bits of
the one is within 4 of the other. So linked fingerprints share a key, and every
pair that shares one is verified on all 64 bits.

Only distinct fingerprints make keys. Within a key no list of pairs is made:
a search from member to member returns a spanning forest of the true links. Keys
with more than MEMBERS members are dealt anew with a further error-free part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import materialize
from rampart.llm.graph import components

SEED = 42
MEMBERS = 50_000
#: Fixed value: the generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the Golay code.
GOLAY_GENERATOR = 0b110001110101


# ---- fingerprints -------------------------------------------------------------

def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of one text; a null, empty or blank one has zero."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(b" ".join(words), SEED)], np.uint64)
    else:
        joined = b" ".join(words)
        starts = np.r_[0, np.cumsum([len(w) + 1 for w in words])]
        view = memoryview(joined)
        a, b = starts[:len(words) - shingle + 1].tolist(), (starts[shingle:] - 1).tolist()
        hashes = np.array([digest(view[i:j], SEED) for i, j in zip(a, b)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        part = hashes[k:k + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def with_fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id (long) and fp, the fingerprint as a signed long, for every row."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return src.mapInArrow(run, "doc_id long, fp long")


# ---- Golay keys ----------------------------------------------------------------

@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(syndromes, errors): the syndrome of every single bit, and for each of the
    2048 syndromes the error patterns of weight up to 3 (one) and 4 (none or five)."""
    rest = []
    for i in range(23):
        r = 1 << i
        while r.bit_length() > 11:
            r ^= GOLAY_GENERATOR << (r.bit_length() - 12)
        rest.append(r)
    errors: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = 0
            for i in bits:
                s ^= rest[i]
            # a pattern of weight 4 matters only where the nearest codeword is 3 away
            if weight < 4 or errors[s][0].bit_count() == 3:
                errors[s].append(sum(1 << i for i in bits))
    table = np.full((2048, 6), -1, np.int64)
    for s, e in enumerate(errors):
        table[s, :len(e)] = e
    return np.array(rest, np.int64), table


@lru_cache(maxsize=1)
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    rest, _ = golay_tables()
    def table(shift: int, bits: int) -> np.ndarray:
        out = np.zeros(1 << bits, np.int64)
        for i in range(bits):
            out ^= np.where(np.arange(1 << bits) >> i & 1, rest[shift + i], 0)
        return out
    return table(0, 12), table(12, 11)


def codewords(words: np.ndarray) -> np.ndarray:
    """(n, 6): indices of the codewords near each 23-bit word, -1 where there are fewer."""
    low, high = _syndromes()
    errors = golay_tables()[1][low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints (unsigned)."""
    blocks = [(fps >> np.uint64(16 * i)).astype(np.int64) & 0xFFFF for i in range(4)]
    rows, keys = [], []
    for i in range(4):
        a, b, c = (blocks[j] for j in range(4) if j != i)
        rest = a | b << 16 | c << 32
        for half in range(2):
            index = codewords((rest >> (24 * half)) & 0x7FFFFF)
            row, col = np.nonzero(index >= 0)
            rows.append(row)
            keys.append((i * 2 + half) << 28 | blocks[i][row] << 12 | index[row, col])
    return np.concatenate(rows), np.concatenate(keys)


# ---- links within a key -----------------------------------------------------------

def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among distinct fingerprints: from
    each reached member, all not yet reached within the distance are reached."""
    left = fps
    src: list[np.ndarray] = []
    dst: list[np.ndarray] = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= distance
            if near.any():
                got = left[near]
                src.append(np.full(len(got), at))
                dst.append(got)
                queue += list(got)
                left = left[~near]
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *src]), np.concatenate([empty, *dst])


#: How large keys are dealt anew, level by level: each way cuts the 64 bits into
#: four sets, and three errors leave one of the four sets without any.
CUTS = [[sum(1 << b for b in range(64) if b // step % 4 == i) for i in range(4)] for step in (1, 4, 16)]


def refined(key: int, fps: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, fingerprints): the members of a large key under the four keys of the next level."""
    keys = []
    for i, mask in enumerate(CUTS[level]):
        k = (fps & np.uint64(mask)) ^ np.uint64((key * 31 + i + 1) * 0x9E3779B97F4A7C15 % 2**64)
        k = (k ^ k >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append(k ^ k >> np.uint64(29))
    return np.concatenate(keys), np.tile(fps, 4)


def _solve(distance: int, members: int, level: int):
    """Rows (key, fp) sorted by key to links (kind 0: src, dst) and, of keys with
    more members, to rows (kind 1: key, fp) of the next level."""

    def batch(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "src", "dst"])

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[start, len(keys)])
        two = start[size == 2]
        ok = np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance
        src, dst = [fps[two][ok]], [fps[two + 1][ok]]
        for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            a, b = forest(fps[s:s + n], distance)
            src.append(a)
            dst.append(b)
        return batch(0, np.concatenate(src), np.concatenate(dst))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)  # the last key, which may go on
        large: int | None = None
        for b in batches:
            k, f = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            if large is not None:
                n = int(np.searchsorted(k, large, side="right"))
                yield batch(1, *refined(large, f[:n], level))
                k, f, large = k[n:], f[n:], large if n == len(k) else None
            k, f = np.r_[held_k, k], np.r_[held_f, f]
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1], side="left"))
            if cut:
                yield links(k[:cut], f[:cut])
            held_k, held_f = k[cut:], f[cut:]
            if len(held_k) > members and level < len(CUTS):
                large = int(held_k[0])
                yield batch(1, *refined(large, held_f, level))
                held_k, held_f = held_k[:0], held_f[:0]
        if len(held_k):
            yield links(held_k, held_f)

    return run


# ---- the operator ------------------------------------------------------------------

def fingerprint_links(fps: DataFrame, distance: int = 3, members: int = MEMBERS) -> DataFrame:
    """(src, dst): links among the distinct values of ``fps.fp`` whose components
    are those of all pairs within the distance. A written table."""
    if not 0 <= distance <= 3:
        raise ValueError("the keys find distances of 3 bits at most")

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = b.column(0).to_numpy()
            for k in range(0, len(f), 4096):
                row, key = golay_keys(f[k:k + 4096].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(f[k:k + 4096][row])], names=["key", "fp"])

    rows = fps.select("fp").mapInArrow(keys, "key long, fp long")
    found: DataFrame | None = None
    for level in range(len(CUTS) + 1):
        out = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_solve(distance, members, level), "kind int, src long, dst long")
        out = materialize(out, "links")
        links = out.filter("kind = 0").select("src", "dst")
        found = links if found is None else found.union(links)
        rows = out.filter("kind = 1").select(F.col("src").alias("key"), F.col("dst").alias("fp"))
        if rows.isEmpty():
            break
    return found


def simhash_groups(df: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text",
                   members: int = MEMBERS) -> DataFrame:
    """doc_id, fp (signed long) and component_id for every row of ``df``.

    component_id is the smallest doc_id reachable over links of at most
    ``distance`` bits. A text without words, a null one included, has
    fingerprint zero and links like any other. Rows with a null id get the
    component of the others (null if they are alone); repeated rows come back
    repeated; an empty table gives an empty one; further columns are not read."""
    docs = materialize(with_fingerprints(df, id_col, text_col, shingle), "fingerprints")
    fps = materialize(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    label = components(fingerprint_links(fps, distance, members)).select(F.col("node").alias("fp"), "component")
    whole = fps.join(label, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    of = whole.join(least, "component").select("fp", "component_id")
    return docs.join(of, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
