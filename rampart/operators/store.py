"""Serving tables as Parquet folders and one pointer file.

A table's rows lie in data folders, one for each load, partitioned by key range (``_segment``). The
pointer file ``_current.json`` says which folders, and which of their segments, make up the
table; it is replaced by renaming a finished file over it, so readers see a load whole or not at all,
and a load that fails leaves only a folder that nothing names. A table has one writer at a time; a
second one finds the version changed and fails.

The bounds of the segments are taken from the first rows that are loaded (``SEGMENT_BYTES`` each). They
let an upsert rewrite the ranges that hold incoming keys, and no others. Every folder keeps the
schema that it was written with, so that a table outlives a change of its contract.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import TableContract
from ..errors import LoadError
from ..session import hadoop_fs, plan_bytes
from .reshape import align

CURRENT = "_current.json"
SEGMENT = "_segment"
SEGMENT_BYTES = 256 << 20
MAX_SEGMENTS = 1024


@dataclass
class Folder:
    """A data folder: its schema, its segments that are still in use, and whether these are all it has."""

    schema: str
    segments: list[int]
    whole: bool = True


@dataclass
class Version:
    number: int
    keys: list[str] = field(default_factory=list)
    bounds: list[list[str | None]] = field(default_factory=list)  # first keys of the segments after the first, as text
    folders: dict[str, Folder] = field(default_factory=dict)

    @property
    def n_segments(self) -> int:
        return len(self.bounds) + 1


# ------------------------------------------------------------- pointer file
def current(spark: SparkSession, root: str) -> Version | None:
    fs, p = hadoop_fs(spark, f"{root}/{CURRENT}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark._jvm.java.lang.String(stream.readAllBytes(), "UTF-8")
    finally:
        stream.close()
    d = json.loads(str(text))
    return Version(d["number"], d["keys"], d["bounds"], {k: Folder(**f) for k, f in d["folders"].items()})


def publish(spark: SparkSession, root: str, version: Version) -> None:
    """Make ``version`` (numbered one above the one it follows) the current one."""
    now = current(spark, root)
    if (now.number if now else 0) != version.number - 1:
        raise LoadError(f"another load of {root} came first: version {version.number} exists")
    fs, temporary = hadoop_fs(spark, f"{root}/.{CURRENT}.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    try:
        out.write(bytearray(json.dumps(asdict(version)), "utf-8"))
    finally:
        out.close()
    fs_jvm = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs_jvm, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = fs_jvm.FileContext.getFileContext(temporary.toUri() if temporary.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(temporary, fs_jvm.Path(f"{root}/{CURRENT}"), options)


# ------------------------------------------------------------------ segments
def segment_of(keys: list[str], bounds: list[list[str | None]], schema: T.StructType) -> Column:
    """The number of bounds that are not above a row's key: a binary search in a constant array."""
    if not bounds:
        return F.lit(0)
    names = [f"k{i}" for i in range(len(keys))]
    typed = ",".join(f"{n}:{schema[k].dataType.simpleString()}" for n, k in zip(names, keys))
    text = F.from_json(F.lit(json.dumps([dict(zip(names, b)) for b in bounds])), f"array<struct<{','.join(f'{n}:string' for n in names)}>>")
    table = text.cast(f"array<struct<{typed}>>")
    key = F.struct(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(at: Column, width: Column) -> Column:
        there = F.get(table, at + width - 1)
        return F.when((at + width <= len(bounds)) & (there <= key), at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def choose_bounds(rows: DataFrame, keys: list[str]) -> list[list[str | None]]:
    """Bounds of about equal segments of written ``rows``: a row for each comes to the driver."""
    n = min(MAX_SEGMENTS, -(-plan_bytes(rows) // SEGMENT_BYTES))
    if n <= 1 or not keys or any(isinstance(rows.schema[k].dataType, T.BinaryType) for k in keys):
        return []
    first = (rows.select(*keys).repartitionByRange(n, *keys).groupBy(F.spark_partition_id().alias("_p"))
             .agg(F.min(F.struct(*keys)).alias("k")).orderBy("k").select(*[F.col("k")[k].cast("string") for k in keys]))
    return [list(r) for r in first.collect()][1:]


# ------------------------------------------------------------- read and write
def read(spark: SparkSession, root: str, version: Version, contract: TableContract | None = None,
         segments: set[int] | None = None) -> DataFrame:
    """The table, or some of its segments. Folders of one schema are read together; those that
    differ from the contract are aligned to it."""
    by_schema: dict[str, list[str]] = {}
    for name, f in version.folders.items():
        paths = by_schema.setdefault(f.schema, [])
        if segments is None and f.whole and f.segments:
            paths.append(f"{root}/{name}")
        else:
            paths += [f"{root}/{name}/{SEGMENT}={s}" for s in f.segments if segments is None or s in segments]
    wanted = contract.struct_type() if contract is not None else None
    parts = []
    for schema, paths in by_schema.items():
        if not paths:
            continue
        kind = T.StructType.fromJson(json.loads(schema))
        part = spark.read.schema(kind).option("recursiveFileLookup", "true").parquet(*paths)
        if wanted is not None and kind != wanted:
            part = align(part, contract)
        parts.append(part)
    if not parts:
        kinds = [T.StructType.fromJson(json.loads(s)) for s in by_schema]
        return spark.createDataFrame([], wanted or (kinds[0] if kinds else T.StructType()))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write(spark: SparkSession, df: DataFrame, root: str, version: Version, num_partitions: int | None = None) -> tuple[str, Folder]:
    """A new data folder with ``df`` by segment, sorted by key."""
    name = f"data-{uuid.uuid4().hex}"
    out = df.withColumn(SEGMENT, segment_of(version.keys, version.bounds, df.schema))
    order = [SEGMENT, *[k for k in version.keys if k in df.columns]]
    if num_partitions:
        out = out.repartitionByRange(num_partitions, *order)
    elif version.bounds:
        out = out.hint("rebalance", F.col(SEGMENT))  # a segment's rows together; large ones are split at run time
    out.sortWithinPartitions(*order).write.mode("errorifexists").partitionBy(SEGMENT).parquet(f"{root}/{name}")
    fs, p = hadoop_fs(spark, f"{root}/{name}")
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    segments = sorted(int(n.split("=")[1]) for n in found if n.startswith(f"{SEGMENT}="))
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return name, Folder(kind.json(), segments)


def without_segments(folders: dict[str, Folder], gone: set[int]) -> dict[str, Folder]:
    """The folders without some segments; those that have none left go. A folder that was empty when it was
    written stays: it holds the table's schema."""
    out = {}
    for name, f in folders.items():
        left = [s for s in f.segments if s not in gone]
        if left == f.segments:
            out[name] = f
        elif left:
            out[name] = Folder(f.schema, left, False)
    return out


def delete_unused(spark: SparkSession, root: str) -> list[str]:
    """Delete the data folders, and segments, that the current version does not name: what replaced rows
    and failed loads have left. No reader of an older version may be at work."""
    version = current(spark, root)
    if version is None:
        return []
    fs, p = hadoop_fs(spark, root)
    gone = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if not name.startswith("data-"):
            continue
        folder = version.folders.get(name)
        if folder is None:
            gone.append(name)
        elif not folder.whole:
            inside = [x.getPath().getName() for x in fs.listStatus(s.getPath())]
            gone += [f"{name}/{n}" for n in inside if n.startswith(f"{SEGMENT}=") and int(n.split("=")[1]) not in folder.segments]
    for name in gone:
        fs.delete(hadoop_fs(spark, f"{root}/{name}")[1], True)
    return sorted(gone)
