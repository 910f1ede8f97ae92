"""File gates: judge a whole landing directory in one Spark job.

One ``text`` scan of the landing paths, grouped by file, yields the first
line, the count of non-blank lines and the count of lines that are not valid
UTF-8 (partial aggregation: one row per task and file reaches the shuffle).
The same scan's file index lists the files (zero-byte files are listed but
produce no lines); expected paths that do not exist are reported as such.
The verdict is one row per expected file:

    not_found   "File not found - {path}"                  (no quarantine)
    empty       "File empty - {path}"                       zero bytes / blank first line
    unreadable  "File is not readable - {path}"            invalid UTF-8 anywhere
    header_only "File contains only header without data - {path}"
    schema_mismatch "Schema mismatch. Expected [...], got [...]"
    accepted

Gates run in the contract's order; the first that fails gives the verdict.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import TableContract
from ..errors import ContractError
from ..session import hadoop_fs, plain_path, plain_path_col
from .files import with_source_index

VERDICT_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType(), False),
    T.StructField("exists", T.BooleanType(), False),
])


COPIES = 16  # byte copies at a time

# A comma that is not inside double quotes.
_CSV_SPLIT = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _landing_text(spark: SparkSession, paths) -> tuple[DataFrame | None, list[str], list[str]]:
    """(text scan of every data file under the existing paths, listed files,
    missing paths).  Spark's own file index does the listing (in parallel on
    the cluster for many folders); zero-byte files are listed but yield no
    lines, which is how they are recognised."""
    existing, missing = [], []
    for p in ([paths] if isinstance(paths, str) else paths):
        fs, hp = hadoop_fs(spark, p)
        target = existing if fs.exists(hp) else missing
        target.append(plain_path(str(fs.makeQualified(hp))))
    if not existing:
        return None, [], missing
    text = spark.read.option("recursiveFileLookup", "true").text(existing)
    return text, [plain_path(f) for f in text.inputFiles()], missing


def parse_header(line) -> "F.Column":
    """Header line -> array of column names (CSV quoting, BOM and CR removed)."""
    clean = F.regexp_replace(F.regexp_replace(line, "^﻿", ""), r"\r$", "")
    fields = F.split(clean, _CSV_SPLIT)
    return F.transform(fields, lambda f: F.regexp_replace(
        F.regexp_replace(F.trim(f), r'^"(.*)"$', "$1"), '""', '"'))


def file_stats(text: DataFrame) -> DataFrame:
    """Per file: first line, non-blank lines, invalid-UTF-8 lines.

    One pass, no join: the first line is the row with the smallest row id
    inside the split that starts at byte 0 of the file.
    """
    lines = text.select(
        plain_path_col(F.col("_metadata.file_path")).alias("file_path"),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_mid"), "value")
    first_split_id = F.when(F.col("_blk") == 0, F.col("_mid"))
    return (lines.groupBy("file_path")
            .agg(F.min_by("value", first_split_id).alias("first_line"),
                 F.count_if(F.col("value").rlike(r"\S")).alias("n_nonblank"),
                 F.count_if(~F.is_valid_utf8("value")).alias("n_bad_utf8"),
                 F.count(F.lit(1)).alias("n_lines")))


def judge_files(spark: SparkSession, paths, contract: TableContract | None = None, *,
                checks: tuple[str, ...] | None = None) -> DataFrame:
    """Verdict per expected file (see module doc); gates run in config order."""
    if checks is None:
        checks = contract.file_checks if contract is not None else ("validate_file",)
    text, listed, missing = _landing_text(spark, paths)
    listing = [(f, True) for f in listed] + [(m, False) for m in missing]
    files = spark.createDataFrame(listing, VERDICT_SCHEMA)
    if text is not None:
        v = files.join(file_stats(text), "file_path", "left")
    else:
        v = files.select("*", F.lit(None).cast("string").alias("first_line"),
                         F.lit(None).cast("long").alias("n_nonblank"),
                         F.lit(None).cast("long").alias("n_bad_utf8"),
                         F.lit(None).cast("long").alias("n_lines"))
    path = F.col("file_path")
    first = F.col("first_line")
    header = parse_header(first)
    expected = contract.column_names if contract is not None else []
    mismatch = F.concat(
        F.lit(f"Schema mismatch. Expected {expected!r}, got ["),
        F.array_join(F.transform(header, lambda h: F.concat(F.lit("'"), h, F.lit("'"))), ", "),
        F.lit("]"))
    status = F.when(~F.col("exists"), F.lit("not_found"))
    reason = F.when(~F.col("exists"), F.concat(F.lit("File not found - "), path))
    for gate in checks:
        if gate == "validate_file":
            empty = F.col("n_lines").isNull() | ~first.rlike(r"\S")  # zero bytes (listed, but no lines) or a blank header
            steps = [(empty, "empty", F.concat(F.lit("File empty - "), path)),
                     (F.col("n_bad_utf8") > 0, "unreadable", F.concat(F.lit("File is not readable - "), path)),
                     (F.col("n_nonblank") - 1 < 1, "header_only",
                      F.concat(F.lit("File contains only header without data - "), path))]
        elif gate == "validate_schema":
            bad = ~F.coalesce(header == F.array(*[F.lit(c) for c in expected]), F.lit(False))
            steps = [(bad, "schema_mismatch", mismatch)]
        else:
            raise ContractError(f"Unknown file check: {gate}")
        for failed, name, why in steps:
            status, reason = status.when(failed, name), reason.when(failed, why)
    status = status.otherwise("accepted")
    return v.select(
        "file_path", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), status.alias("status"),
        reason.alias("reason"),
        (status.isin("accepted", "not_found") == F.lit(False)).alias("quarantine"))


def quarantine_lines(spark: SparkSession, verdicts: DataFrame) -> DataFrame:
    """Raw lines of every quarantined file with line index and reason.

    Only rejected files are read: their paths go to the reader, their reasons
    stay in the table of verdicts, one row per file.
    """
    rejected = verdicts.where("quarantine AND n_lines > 0").select("file_path", "reason")
    paths = [r["file_path"] for r in rejected.select("file_path").collect()]
    if not paths:
        return spark.createDataFrame([], "file_path string, line_index bigint, line string, reason string")
    lines = with_source_index(spark.read.text(paths), "text", paths, per_file=True)
    return (lines.join(rejected, lines["_source_file"] == rejected["file_path"])
            .select(rejected["file_path"], F.col("_source_index").alias("line_index"),
                    F.col("value").alias("line"), "reason"))


def copy_to_quarantine(spark: SparkSession, src: str, dst: str) -> None:
    """Byte copy of one rejected landing file (Hadoop FS API)."""
    sfs, sp = hadoop_fs(spark, src)
    dfs, dp = hadoop_fs(spark, dst)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(sfs, sp, dfs, dp, False, True,
                                                  spark._jsc.hadoopConfiguration())


def copy_all_to_quarantine(spark: SparkSession, pairs: list[tuple[str, str]]) -> None:
    """Byte copies of rejected files, COPIES at a time. (A DataFrame can't write bytes to named
    files; the lines as a table are :func:`quarantine_lines`.)"""
    with ThreadPoolExecutor(COPIES) as pool:
        list(pool.map(lambda pair: copy_to_quarantine(spark, *pair), pairs))


def accepted_files(verdicts: DataFrame) -> list[str]:
    return [r["file_path"] for r in verdicts.where("status = 'accepted'").select("file_path").collect()]
