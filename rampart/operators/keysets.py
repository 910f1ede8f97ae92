"""Key sets as digests: 128 bits for the values of several columns, Bloom filters, and the probe of
incoming keys against stored ones.

Digests decide nothing by themselves: they only leave few rows to compare by their real values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import plan_bytes, staged

# Fixed values of the Bloom filter: words a block, bits a word, bits a key.
WORDS, WORD_BITS, KEY_BITS = 8, 64, 12
#: A filter of more keys than this would be too large to broadcast (12 bits a key: 60 MB).
BLOOM_KEYS = 40_000_000

DIGEST = ("_h1", "_h2")
#: Bytes of a text from which on its digest stands for it.
LONG = 32


def digest(columns) -> list[Column]:
    """Two independent 64-bit hashes of the columns' values."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return [F.xxhash64(*cols).alias(DIGEST[0]), F.xxhash64(F.lit("rampart"), *cols).alias(DIGEST[1])]


def is_text(kind: T.DataType) -> bool:
    """Values that may be long: texts, bytes, nested ones."""
    return isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType))


def as_text(column: str, kind: T.DataType) -> Column:
    """A text that is equal for equal values of such a column."""
    v = F.col(column)
    if isinstance(kind, T.BinaryType):
        return F.hex(v)
    if isinstance(kind, T.StringType):
        return v
    return F.to_json(F.struct(v.alias("v")), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def canonical(columns, types: dict[str, T.DataType]) -> Column:
    """The columns' values as one text, never empty: equal for equal keys (NULLs are equal), different for others."""
    def part(c: str) -> Column:
        v, t = F.col(c), types[c]
        if isinstance(t, (T.FloatType, T.DoubleType)):
            v = F.when(v == 0, F.lit(0).cast(t)).otherwise(v)  # one zero
        text = as_text(c, t) if is_text(t) else v.cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))

    return F.concat(*[part(c) for c in columns])


def compact(columns, types: dict[str, T.DataType]) -> list[Column]:
    """Three columns that stand for a key with texts, none NULL: its values as one text and two zeros, or, if its
    texts have more than LONG bytes, an empty text and its digest."""
    texts = [c for c in columns if is_text(types[c])]
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(as_text(c, types[c])), F.lit(0)) for c in texts])
    short = size <= LONG
    missing = [F.col(c).isNull() for c in columns]  # a hash passes over NULLs
    return [F.when(short, canonical(columns, types)).otherwise(F.lit("")),
            *[F.when(short, F.lit(0).cast("long")).otherwise(h) for h in digest([*columns, *missing])]]


def exploded(df: DataFrame, sets: list[tuple[str, ...]]) -> DataFrame:
    """(_set, _h1, _h2): a row for each row of ``df`` and key set whose values are all present."""
    def one(j: int, keys: tuple[str, ...]) -> Column:
        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        return F.when(present, F.struct(F.lit(j).alias("_set"), *digest(keys)))

    made = F.filter(F.array(*[one(j, k) for j, k in enumerate(sets)]), lambda d: d.isNotNull())
    return df.select(F.explode(made).alias("d")).select("d.*")


def bloom(probe: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """The rows of ``probe`` (with digests) that may be among ``keys``: all that are, and about one in
    a hundred of the others. ``n_keys``, their number, sizes the filter: blocks of 512 bits, one
    row each, which is broadcast; every key sets a bit in each word of one block."""
    blocks = max(1, -(-n_keys * KEY_BITS // (WORDS * WORD_BITS)))
    block = F.pmod(F.col(DIGEST[0]), F.lit(blocks)).alias("_block")

    def bit(i: int) -> Column:
        """Six bits of the second hash a word; there are enough for eight words."""
        at = F.shiftrightunsigned(F.col(DIGEST[1]), 6 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    table = keys.groupBy(block).agg(*[F.bit_or(bit(i)).alias(f"_w{i}") for i in range(WORDS)])
    held = reduce(lambda a, b: a & b, [F.col(f"_w{i}").bitwiseAND(bit(i)) != 0 for i in range(WORDS)])
    return probe.withColumn("_block", block).join(F.broadcast(table), "_block").where(held).select(*probe.columns)


def in_range(stored: DataFrame, rows: DataFrame, sets: list[tuple[str, ...]]) -> DataFrame:
    """The stored rows within the range of some set's first column among ``rows``: a pushed
    filter, by which Parquet statistics skip row groups (clustered keys, e.g. increasing ids,
    then read almost nothing). One aggregate over the written rows gives the ranges."""
    firsts = list(dict.fromkeys(s[0] for s in sets))
    found = rows.agg(*[f(k).alias(f"{n}_{i}") for i, k in enumerate(firsts) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    within = [F.col(k).between(F.lit(found[f"lo_{i}"]), F.lit(found[f"hi_{i}"])) for i, k in enumerate(firsts) if found[f"lo_{i}"] is not None]
    return stored.where(reduce(lambda a, b: a | b, within, F.lit(False)))


def probe(rows: DataFrame, stored: DataFrame, sets: list[tuple[str, ...]]) -> dict[tuple[str, ...], DataFrame]:
    """The values of ``rows`` that ``stored`` has too, by key set; sets without any are left out.

    One scan of the key columns of ``stored`` answers for all sets: both sides become digests, and
    the stored ones are reduced to those of the incoming rows (by broadcast, or by a Bloom filter and
    a shuffle, as the size of the incoming ones says). Only where digests meet are the real values
    compared. A set with a NULL is no key."""
    if not sets:
        return {}
    spark = rows.sparkSession
    incoming = staged(exploded(rows, sets), "incoming-keys")
    stored = in_range(stored, rows, sets)
    held = exploded(stored, sets)
    if plan_bytes(incoming) > broadcast_limit(spark):
        n = incoming.count()
        if n <= BLOOM_KEYS:
            held = bloom(held, incoming, n)
    hits = staged(held.join(incoming, ["_set", *DIGEST], "left_semi").distinct(), "key-hits")
    out = {}
    for j in sorted(r[0] for r in hits.select("_set").distinct().collect()):  # a row for each key set
        keys = list(sets[j])
        met = hits.where(F.col("_set") == j)
        values = stored.select(*keys, *digest(keys)).join(met, list(DIGEST), "left_semi").select(*keys).distinct()
        same = staged(rows.select(*keys).join(values, keys, "left_semi").distinct(), "taken")
        if not same.isEmpty():
            out[sets[j]] = same
    return out


def broadcast_limit(spark) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (none: 0)."""
    from ..sources.files import parse_bytes

    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m"))
    return 0 if text.startswith("-") else parse_bytes(text)
