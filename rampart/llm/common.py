"""Shared helpers: written tables, bounded blocks of documents, per-worker caches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.session import hadoop_fs, plain_path, scratch_path

#: A null doc_id sorts after every other; equal ids are never "smaller".
NO_ID = np.int64(2**63 - 1)


def materialize(df: DataFrame, name: str, apart: str | None = None, **options) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back; ``apart``
    names a column that gets a folder for each value.

    Cuts the lineage, so that a lost executor repeats only what follows; the
    folder is deleted when the driver ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.options(**options).parquet(path, partitionBy=apart)
    return spark.read.schema(df.schema).parquet(path)


def in_parts(df: DataFrame, size: int, part: int) -> DataFrame:
    """``df``, of ``size`` bytes, in no more partitions than give each ``part`` bytes, but 12 and the session's
    parallelism at least. A table of many small files costs more to write than its rows: on a local file system
    each file starts two processes that set its mode, copies of a JVM until they run."""
    least = max(12, df.sparkSession.sparkContext.defaultParallelism)
    return df.coalesce(min(max(least, -(-size // part)), 1 << 30))  # a plan of unknown size counts as endless


def discard(df: DataFrame, folder: str | None = None) -> None:
    """Delete a table of :func:`materialize` that nothing will read again, or one ``folder`` of it."""
    for p in {plain_path(f).rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder is None or p.endswith(f"/{folder}"):
            fs, path = hadoop_fs(df.sparkSession, p)
            fs.delete(path, True)


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, with underscores before them as far as ``df`` has such columns."""
    taken = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        return name if name.lower() not in taken else free("_" + name)

    return tuple(map(free, names))


def held_out(id_col: str, mod: int, rest: int) -> Column:
    """crc32(id as text) mod ``mod`` is ``rest``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == rest, F.lit(False))


def shards(spark: SparkSession) -> int:
    """Groups of an exchange: two for each shuffle partition."""
    return 2 * max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))


def release() -> None:
    """Give back to the system what a worker's former tasks have left: workers outlive
    tasks and stages, and free memory that they keep would count for each stage that follows.
    What a worker's first task starts with, its modules, is no garbage and only looked through once."""
    gc.collect()
    if not gc.get_freeze_count():
        gc.freeze()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def columns(batch: pa.RecordBatch) -> list[list]:
    return [c.to_pylist() for c in batch.columns]


# ---- blocks -------------------------------------------------------------------
#
# A block holds the documents of about BLOCK_BYTES of text: their ids, the flags
# and the compressed texts. Exchanges speak of a block's distinct keys, so a hot
# key costs one entry a block however many rows carry it.

BLOCK_BYTES = 4 << 20
LEVEL = 3  # of compression
BLOCK_SCHEMA = "block long, ids binary, flags binary, sizes binary, payload binary, rest binary"


def _block(task: int, seq: int, ids: list, flags: list, texts: list[bytes], rest: pa.Table | None = None) -> dict:
    payload = zstandard.compress(b"".join(texts), LEVEL)
    return {"block": (task << 24) + seq,
            "ids": np.array([NO_ID if i is None else i for i in ids], np.int64).tobytes(),
            "flags": np.array(flags, np.uint8).tobytes(),
            "sizes": np.array([len(t) for t in texts], np.int64).tobytes(), "payload": payload,
            "rest": None if rest is None else _written(rest)}


def _written(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def carried(row: dict) -> pa.Table:
    """The further columns of a block's documents."""
    return pa.ipc.open_stream(row["rest"]).read_all()


def plain(df: DataFrame, id_col: str, text_col: str, flag: Column | None = None, carry: list[str] = ()) -> DataFrame:
    """Ids as i, texts as t (null texts are empty), flags as f, and the columns to keep with them."""
    return df.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"),
                     (F.lit(0) if flag is None else flag.cast("int")).alias("f"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)])


def unwritten_blocks(batches: Iterable[pa.RecordBatch], block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """Number and rows of the blocks that :func:`to_blocks` would write for a task's rows of
    :func:`plain`, for passes that read them once."""
    from pyspark import TaskContext

    release()
    task, seq, size, many = TaskContext.get().partitionId(), 0, 0, 0
    held: list[pa.RecordBatch] = []
    for b in batches:
        start = 0
        for k, n in enumerate(pc.binary_length(b.column("t")).to_pylist()):
            if many and size + n > block_bytes:
                yield (task << 24) + seq, pa.Table.from_batches([*held, b.slice(start, k - start)]).combine_chunks()
                seq, size, many, held, start = seq + 1, 0, 0, [], k
            size, many = size + n, many + 1
        held.append(b.slice(start))
    if many:
        yield (task << 24) + seq, pa.Table.from_batches(held).combine_chunks()


def to_blocks(df: DataFrame, id_col: str, text_col: str, flag: Column | None = None,
              name: str = "blocks", block_bytes: int = BLOCK_BYTES, carry: list[str] = ()) -> DataFrame:
    """Documents as a written table of blocks (null texts are empty); ``carry`` names columns to keep
    with them (:func:`carried`)."""
    src = plain(df, id_col, text_col, flag, carry)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release()
        task, seq, size = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        flags: list = []
        texts: list[bytes] = []
        rest: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(rest) if carry else None
            return pa.RecordBatch.from_pylist([_block(task, seq, ids, flags, texts, table)], BLOCK_ARROW)

        for b in batches:
            start = 0  # of this batch's rows in the block
            for k, (i, t, f) in enumerate(zip(*columns(b.select(["i", "t", "f"])))):
                t = t.encode()
                if texts and size + len(t) > block_bytes:
                    rest.append(b.select(b.schema.names[3:]).slice(start, k - start))
                    yield block()
                    seq, size, ids, flags, texts, rest, start = seq + 1, 0, [], [], [], [], k
                ids.append(i)
                flags.append(f)
                texts.append(t)
                size += len(t)
            rest.append(b.select(b.schema.names[3:]).slice(start))
        if texts:
            yield block()

    return materialize(src.mapInArrow(run, BLOCK_SCHEMA), name, compression="none")


BLOCK_ARROW = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("flags", pa.binary()),
                         ("sizes", pa.binary()), ("payload", pa.binary()), ("rest", pa.binary())])


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(ids, flags, texts as UTF-8) of a block."""
    ids = np.frombuffer(row["ids"], np.int64)
    ends = np.cumsum(np.frombuffer(row["sizes"], np.int64))
    raw = zstandard.ZstdDecompressor().decompress(row["payload"], max_output_size=int(ends[-1]) + 1)
    return ids, np.frombuffer(row["flags"], np.uint8), [raw[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    release()
    for b in batches:
        for k in range(b.num_rows):
            yield b.slice(k, 1).to_pylist()[0]


def out_id(i) -> int | None:
    return None if i == NO_ID else int(i)


# ---- exchanges ------------------------------------------------------------------
#
# Blocks ask shards about their keys and get an answer for each ask: packed arrays
# in one row for each block and shard.

ASK_SCHEMA = "shard int, block long, blob binary"
ASK_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("blob", pa.binary())])


def asks(block: int, shard: np.ndarray, entries: np.ndarray, packed: bool = False) -> pa.RecordBatch:
    """One row for each shard: its entries (a structured array) in their order,
    compressed if ``packed`` (the answer must know)."""
    order = np.argsort(shard, kind="stable")
    found, start = np.unique(shard[order], return_index=True)
    ends = np.r_[start[1:], len(order)]
    blobs = [pack(entries[order[a:b]], packed) for a, b in zip(start, ends)]
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(np.full(len(found), block, np.int64)), pa.array(blobs, pa.binary())], schema=ASK_ARROW)


def answered(ask_rows: DataFrame, dtype: np.dtype, answer, packed: bool = False) -> DataFrame:
    """Rows (shard, block, blob): ``answer(entries)`` of all entries of a shard,
    an array with one item for each entry, dealt back to the blocks. A shard
    holds what hashes to it, about one of shards() parts of all entries."""

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts = [unpacked(b, dtype, packed) for b in table.column("blob").to_pylist()]
        got = answer(np.concatenate(parts))
        ends = np.cumsum([len(p) for p in parts])
        out = [pack(got[a:b], packed) for a, b in zip(np.r_[0, ends[:-1]], ends)]
        return pa.Table.from_arrays([table.column("shard"), table.column("block"), pa.array(out, pa.binary())], schema=ASK_ARROW)

    return ask_rows.groupBy("shard").applyInArrow(solve, ASK_SCHEMA)


def with_answers(blocks: DataFrame, **answers: DataFrame) -> DataFrame:
    """Blocks with each table of answers as a list column of that name."""
    for name, rows in answers.items():
        got = rows.groupBy(F.col("block").alias("_block")).agg(F.collect_list(F.struct("shard", "blob")).alias(name))
        blocks = blocks.join(got, F.col("block") == F.col("_block"), "left").drop("_block")
    return blocks


def pack(items: np.ndarray, packed: bool) -> bytes:
    """Bytes of an array; packed, those of equal significance together and compressed."""
    if not packed:
        return items.tobytes()
    rows = np.frombuffer(items.tobytes(), np.uint8).reshape(len(items), -1)
    return zstandard.compress(np.ascontiguousarray(rows.T).tobytes(), LEVEL)


def unpacked(blob: bytes, dtype: np.dtype, packed: bool) -> np.ndarray:
    if not packed:
        return np.frombuffer(blob, dtype)
    dtype = np.dtype(dtype)
    rows = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(dtype.itemsize, -1)
    return np.frombuffer(np.ascontiguousarray(rows.T).tobytes(), dtype)


def scatter(shard: np.ndarray, got: list[dict] | None, dtype, packed: bool = False) -> np.ndarray:
    """The answers in the order of the block's own entries."""
    out = np.zeros(len(shard), dtype)
    order = np.argsort(shard, kind="stable")
    found, start = np.unique(shard[order], return_index=True)
    ends = dict(zip(found.tolist(), zip(start.tolist(), np.r_[start[1:], len(order)].tolist())))
    for g in got or []:
        a, b = ends[g["shard"]]
        out[order[a:b]] = unpacked(g["blob"], dtype, packed)
    return out


# ---- hot anchors -----------------------------------------------------------------
#
# What is dealt by anchor stays small only while an anchor has few different entries.
# Blocks first send each different anchor once with the number of its entries; the strings of
# anchors with more than HOT go by their own hash, which Spark reduces by partition and key.

HOT = 20_000  # different entries of an anchor (counted to a power of two, never too high)
ALONE, SHARED, CROWDED = 0, 1, 2  # answers to an anchor
ANCHOR = np.dtype([("hash", "<u4"), ("shared", "u1")])
STRINGS_SCHEMA = "anchor long, string long, block long, low long, high long"
FOUND_SCHEMA = "array<struct<anchor:long,string:long,least:long>>"


def anchor_entries(hashes: np.ndarray, shared: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Entries of different anchors: in one byte, whether two documents of the block share
    it and the number of its entries, as its binary digits."""
    out = np.zeros(len(hashes), ANCHOR)
    out["hash"] = hashes
    out["shared"] = shared | np.frexp(many.astype(float))[1].astype(np.uint8) << np.uint8(1)
    return out


def judge_anchors(hot: int):
    def judge(entries: np.ndarray) -> np.ndarray:
        """SHARED where the anchor is in two documents (blocks, or within one), CROWDED
        where it has more than ``hot`` entries, too."""
        found, number, blocks = np.unique(entries["hash"], return_inverse=True, return_counts=True)
        shared = np.bincount(number, entries["shared"] & 1, len(found)) + blocks > 1
        many = np.bincount(number, np.ldexp(1.0, (entries["shared"] >> 1).astype(int) - 1), len(found))
        return np.where(shared, np.where(many > hot, CROWDED, SHARED), ALONE)[number].astype(np.uint8)

    return judge


def string_rows(block: int, anchor: np.ndarray, string: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """A block's strings of crowded anchors, each once with its smallest and largest document."""
    order = np.lexsort((string, anchor))
    a, s, d = anchor[order], string[order], doc[order]
    head = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])][: len(a)])
    low, high = (f.reduceat(d, head) if len(head) else d for f in (np.minimum, np.maximum))
    return pa.RecordBatch.from_arrays([pa.array(a[head].view(np.int64)), pa.array(s[head].view(np.int64)), pa.array(np.full(len(head), block, np.int64)), pa.array(low), pa.array(high)],
                                      names=["anchor", "string", "block", "low", "high"])


def with_strings(blocks: DataFrame, ask) -> DataFrame:
    """Blocks (with their anchors' answers) with a list column ``strings``: the
    strings of crowded anchors that a smaller document has, and which that is. ``ask`` makes
    :func:`string_rows` of blocks; those without a crowded anchor aren't asked."""
    crowded = blocks.filter(F.exists("anchors", lambda a: F.instr(a["blob"].cast("string"), chr(CROWDED)) > 0))
    rows = materialize(crowded.mapInArrow(ask, STRINGS_SCHEMA), "strings")
    least = rows.groupBy("anchor", "string").agg(F.min("low").alias("least"), F.max("high").alias("most")).filter("least < most").drop("most")
    found = rows.join(least, ["anchor", "string"]).filter("least < high")
    got = found.groupBy(F.col("block").alias("_block")).agg(F.collect_list(F.struct("anchor", "string", "least")).alias("strings"))
    return blocks.join(got, F.col("block") == F.col("_block"), "left").drop("_block")


def any_crowded(anchors: DataFrame) -> bool:
    return not anchors.filter(F.instr(F.col("blob").cast("string"), chr(CROWDED)) > 0).isEmpty()


def repeated_strings(anchor: np.ndarray, string: np.ndarray, doc: np.ndarray, found: list[dict] | None) -> np.ndarray:
    """Which strings of crowded anchors a smaller document has."""
    if not found or not len(anchor):
        return np.zeros(len(anchor), bool)
    a, s, least = (np.array([f[k] for f in found], np.int64) for k in ("anchor", "string", "least"))
    pairs = np.c_[np.r_[a, anchor.view(np.int64)], np.r_[s, string.view(np.int64)]]
    different, number = np.unique(pairs, axis=0, return_inverse=True)
    number = number.reshape(-1)
    smallest = np.full(len(different), NO_ID)
    smallest[number[:len(a)]] = least
    return smallest[number[len(a):]] < doc


# ---- hashes of sequences ----------------------------------------------------------

BASE = 0x9E3779B97F4A7C15  # odd, so that powers have an inverse modulo 2**64


class WordHashes(dict):
    """64-bit hash of a word, kept for the worker's most recent words."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


class RangeHashes:
    """Hashes of any ranges of a sequence of numbers, by prefix sums modulo 2**64."""

    def __init__(self, units: np.ndarray):
        n = len(units)
        up = np.full(n, BASE, np.uint64)
        down = np.full(n + 1, pow(BASE, -1, 2**64), np.uint64)
        up[:1] = down[:1] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(units + np.uint64(1)) * np.multiply.accumulate(up), out=self.sums[1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((self.sums[last] - self.sums[first]) * self.down[first])


def selected(grams: np.ndarray, starts: np.ndarray, window: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowing: for every ``length``-unit string within a document, the place of
    the least of its ``window`` grams (the rightmost of equal ones), and the
    string's start. ``grams[i]``, 32 bits, belongs to the gram that starts at unit i;
    ``starts`` are the documents' first units and, at last, the end. Equal
    strings select the same gram."""
    n = int(starts[-1])
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64(0xFFFFFFFF)
    value = grams.astype(np.uint64) << np.uint64(32) | low - np.arange(len(grams), dtype=np.uint64)  # of equal ones the later is less
    span = 1
    while span < window:
        step = min(span, window - span)
        value = np.minimum(value[:-step], value[step:])
        span += step
    place = (low - (value & low)).astype(np.int64)
    last = np.repeat(starts[1:], np.diff(starts))[: n - length + 1] - length  # the last start within each document
    good = np.flatnonzero(np.arange(n - length + 1) <= last)
    return place[good], good


def row_hashes(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each row of bytes, its size included."""
    table = mix(np.arange(1, 257, dtype=np.uint64))
    powers = np.multiply.accumulate(np.full(rows.shape[1], BASE, np.uint64))
    out = mix(sizes.astype(np.uint64) + np.uint64(257))
    for k in range(0, len(rows), 32768):
        out[k:k + 32768] ^= mix((table[rows[k:k + 32768]] * powers).sum(1, dtype=np.uint64))
    return mix(out)
