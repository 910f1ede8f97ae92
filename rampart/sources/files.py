"""Scans and sinks (CSV with header, Parquet) and the stable source index.

``_source_index`` is the 0-based position of a row over all input files in
path order and ``_source_file`` the file itself; together they give a total,
reproducible keep-first order across many files and splits.  For Parquet both
come from the scan's ``_metadata`` (``row_index``).  CSV has no row index: it is parsed
once, into a Parquet copy whose rows keep their split and their place among the task's rows. From the
copy, rows per (file, split) and the first row id of
each split are aggregated (one small row per split), turned into offsets by a
distributed prefix sum over that table, written once, and joined back to the copy; the planner
broadcasts the offsets or shuffles by their written size.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import SUPPORTED_FORMATS, TableContract
from ..operators.reshape import align
from ..operators.validate import CORRUPT, FILE, INDEX
from ..session import hadoop_fs, plain_path_col, staged
from . import multiline

FOOTERS = 16  # read at a time

# Fixed value: units per task aimed at in the prefix sum of offsets.
PREFIX_ROWS_PER_TASK = 50_000


def _check_format(fmt: str) -> str:
    if fmt not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    return fmt


def read_table(spark: SparkSession, path, fmt: str, *, schema: T.StructType | None = None,
               contract: TableContract | None = None, index: bool = False,
               flag_malformed: bool = False, multiline: bool = False, source_file: bool = False) -> DataFrame:
    """Scan CSV (header row, all text, no inference) or Parquet.

    ``index`` attaches ``_source_file`` and ``_source_index``, ``source_file`` the first alone.
    With ``multiline`` quoted CSV fields may hold line breaks: the records are put together by
    many tasks a file (:mod:`multiline`) and parsed once; it needs a schema or contract."""
    _check_format(fmt)
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "csv":
        if schema is None and contract is not None:
            schema = contract.string_schema()
        options = {"mode": "PERMISSIVE", "escape": '"'}
        if schema is not None and flag_malformed:
            schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
            options["columnNameOfCorruptRecord"] = CORRUPT
        if multiline:
            if schema is None:
                raise ValueError("multiline needs a schema or contract")
            return _read_multiline(spark, paths, schema, options, index, source_file)
        reader = spark.read.options(header=True, **options)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.csv(paths)
    else:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.parquet(*paths)
    if index:
        return with_source_index(df, fmt, paths)
    return df.select("*", plain_path_col(F.col("_metadata.file_path")).alias(FILE)) if source_file else df


def read_versions(spark: SparkSession, paths: list[str], contract: TableContract, *, source_file: bool = False) -> DataFrame:
    """Parquet folders written under different versions of a contract as one table of its columns
    and types.

    A folder is one write and has one schema, taken from a footer (FOOTERS folders at a time).
    Folders of one schema are one scan; those that differ from the contract are aligned to it (an older
    type is converted, a column they lack is NULL, one that the contract has no more is dropped), so
    a column of the declared type keeps its pushed filters. ``source_file`` adds ``_source_file``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    with ThreadPoolExecutor(FOOTERS) as pool:
        schemas = list(pool.map(lambda p: spark.read.parquet(p).schema, paths))
    groups: dict[str, list[int]] = {}
    for i, schema in enumerate(schemas):
        groups.setdefault(schema.json(), []).append(i)
    parts = []
    for members in groups.values():
        schema = schemas[members[0]]
        part = spark.read.schema(schema).parquet(*(paths[i] for i in members))
        keep = (FILE,) if source_file else ()
        if source_file:
            part = part.withColumn(FILE, plain_path_col(F.col("_metadata.file_path")))
        parts.append(align(part, contract, keep=keep))
    if not parts:
        return spark.createDataFrame([], T.StructType(contract.struct_type().fields + ([T.StructField(FILE, T.StringType())] if source_file else [])))
    return reduce(DataFrame.unionByName, parts)


def _read_multiline(spark: SparkSession, paths: list[str], schema: T.StructType, options: dict, index: bool, source_file: bool) -> DataFrame:
    splits = split_bound(spark, paths)
    records, counts = multiline.read_records(spark, paths, splits)
    rows = multiline.parsed(records, schema, options)
    rows = staged(rows.select(plain_path_col(F.col("file")).alias(FILE), "number", *schema.names), "multiline")
    if not index:
        return rows.drop("number") if source_file else rows.drop("number", FILE)
    # a file's records are numbered already, from its header on
    units = counts.select(plain_path_col(F.col("file")).alias(FILE), (F.col("records") - 1).alias("_cnt"))
    offsets = staged(prefix_offsets(units, [FILE], "_cnt", splits).drop("_cnt"), "offsets")
    return rows.join(offsets, FILE).select(*schema.names, FILE, (F.col("_off") + F.col("number") - 1).alias(INDEX))


def with_source_index(df: DataFrame, fmt: str, paths: list[str] | None = None,
                      per_file: bool = False) -> DataFrame:
    """Attach ``_source_file`` and ``_source_index`` to a fresh file scan.

    ``_source_index`` is dense and 0-based over all input files taken in path
    order (so it alone identifies a row); with ``per_file`` it restarts at 0
    in every file.  Offsets come from one small row per file (Parquet, whose
    scan exposes ``row_index``) or per (file, split) (text formats, from a written
    copy of the scan, which the result reads), prefixed by a window over that small table and joined back.
    """
    spark = df.sparkSession
    if fmt == "parquet":
        marked = df.select("*", plain_path_col(F.col("_metadata.file_path")).alias(FILE),
                           F.col("_metadata.row_index").alias("_pos"))
        n_files = len(df.inputFiles())
        if per_file or n_files <= 1:
            return marked.withColumnRenamed("_pos", INDEX)
        units = marked.groupBy(FILE).agg(F.count(F.lit(1)).alias("_cnt"))
        offsets = staged(prefix_offsets(units, [FILE], "_cnt", n_files).drop("_cnt"), "offsets")
        out = marked.join(offsets, [FILE], "inner")
        return out.select(*df.columns, FILE, (F.col("_off") + F.col("_pos")).alias(INDEX))
    marked = df.select("*", plain_path_col(F.col("_metadata.file_path")).alias(FILE),
                       F.col("_metadata.file_block_start").alias("_blk"),
                       F.monotonically_increasing_id().alias("_mid"))
    bound = split_bound(spark, paths) if paths is not None else None
    return dense_index(staged(marked, "landing"), df.columns, per_file=per_file, n_hint=bound)


def prefix_offsets(units: DataFrame, order: list[str], count_col: str,
                   n_hint: int | None = None) -> DataFrame:
    """``units`` + ``_off`` = sum of ``count_col`` over all units before each
    one in ``order`` -- a distributed exclusive prefix sum.

    Units are range-partitioned on ``order`` and written once with the number
    of their partition, so that the local sums and the partition totals see
    the same partitions; the totals -- one row per partition -- give each
    partition's base offset.  ``n_hint`` (a bound on the units) sets how many
    partitions there are, nothing else.
    """
    spark = units.sparkSession
    if n_hint is None:
        n_hint = PREFIX_ROWS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-n_hint // PREFIX_ROWS_PER_TASK))
    ranged = staged(units.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id()), "units")
    local = (Window.partitionBy("_pid").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, -1))
    within = ranged.withColumn("_loc", F.coalesce(F.sum(count_col).over(local), F.lit(0)))
    totals = ranged.groupBy("_pid").agg(F.sum(count_col).alias("_tot"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_pid", F.coalesce(F.sum("_tot").over(earlier), F.lit(0)).alias("_base"))
    return (within.join(bases, "_pid")
            .withColumn("_off", F.col("_base") + F.col("_loc"))
            .drop("_pid", "_loc", "_base"))


def dense_index(marked: DataFrame, columns: list[str], *, per_file: bool = False,
                n_hint: int | None = None) -> DataFrame:
    """Dense position from ``_source_file``, split start ``_blk`` and the
    in-split row id ``_mid``: rows per split and each split's first id are
    aggregated (one row per split), summed up in (file, split) order, and
    joined back."""
    splits = (marked.groupBy(FILE, "_blk")
              .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_mid0")))
    if per_file:
        before = (Window.partitionBy(FILE).orderBy("_blk")
                  .rowsBetween(Window.unboundedPreceding, -1))
        offsets = splits.select(FILE, "_blk", "_mid0",
                                F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    else:
        offsets = prefix_offsets(splits, [FILE, "_blk"], "_cnt", n_hint).drop("_cnt")
    out = marked.join(staged(offsets, "offsets"), [FILE, "_blk"], "inner")
    return out.select(*columns, FILE, (F.col("_off") + F.col("_mid") - F.col("_mid0")).alias(INDEX))


def split_bound(spark: SparkSession, paths: list[str]) -> int:
    """Upper bound on (file, split) pairs: files + bytes / maxPartitionBytes."""
    files = size = 0
    for p in paths:
        fs, hp = hadoop_fs(spark, p)
        if not fs.exists(hp):
            continue
        cs = fs.getContentSummary(hp)
        files += int(cs.getFileCount())
        size += int(cs.getLength())
    max_bytes = parse_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    return files + math.ceil(size / max(max_bytes, 1))


def parse_bytes(text: str) -> int:
    """Spark byte-size string (``134217728``, ``128m``, ``1g``, ``64MB``) -> bytes."""
    t = str(text).strip().lower().rstrip("b")
    mult = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if t and t[-1] in mult:
        return int(float(t[:-1]) * mult[t[-1]])
    return int(t)


def write_table(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> None:
    """Write a table directory; CSV gets a header row."""
    _check_format(fmt)
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.parquet(path)


def layer_path(base: str, contract: TableContract, layer: str, process_date, fmt: str | None = None) -> str:
    """``{base}/{layer}/{schema}/{table}/{yyyy/mm/dd}/{table}.{ext}``.

    ``layer`` is a layer kind (``rcv``, ``l0``, ``l1``, ``audit``,
    ``quarantine``) resolved through the contract's ``*_layer`` names.
    """
    if hasattr(process_date, "strftime"):
        date_part = process_date.strftime("%Y/%m/%d")
    else:
        date_part = str(process_date).replace("-", "/")
    ext = fmt or dict(contract.formats).get(layer) or "parquet"
    return (f"{base.rstrip('/')}/{contract.layer(layer)}/{contract.schema_name}/"
            f"{contract.table_name}/{date_part}/{contract.table_name}.{ext}")
