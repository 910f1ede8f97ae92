"""Reshaping: lineage columns, name / address splits, rename, projection,
schema alignment and casts.  Every transform is ``DataFrame -> DataFrame``
built from native expressions; the pipeline folds them with ``df.transform``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import TableContract
from ..errors import ContractError
from ..functions import text
from ..functions.types import cast_to

# Lineage columns ``add_column`` knows.
LINEAGE_COLUMNS = ("process_date", "source_file")


def add_lineage(df: DataFrame, rules, run_ts: _dt.datetime, source_file: str | None = None) -> DataFrame:
    """``process_date`` = the run timestamp, ``source_file`` = input path.

    The run timestamp is a parameter, so a rerun reproduces its output.  The
    path comes from ``_source_file`` (set per row by the scan) when present.
    """
    new = {}
    for r in rules:
        name = r["name"] if isinstance(r, dict) else r
        if name == "process_date":
            # From text: a datetime literal would pass through local time zones.
            new[name] = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
        elif name == "source_file":
            if "_source_file" in df.columns:
                new[name] = F.col("_source_file")
            else:
                new[name] = F.lit(source_file).cast("string")
        else:
            raise ContractError(f"Unknown column name: {name}")
    return df.withColumns(new) if new else df


def split_name(df: DataFrame, rules) -> DataFrame:
    new = {}
    for r in rules:
        first_col, last_col = r["to"]
        first, last = text.split_name(F.col(r["from"]))
        new[first_col], new[last_col] = first, last
    return df.withColumns(new)


def split_address(df: DataFrame, rules) -> DataFrame:
    new = {}
    for r in rules:
        addr_col, prov_col = r["to"]
        addr, prov = text.split_address(F.col(r["from"]))
        new[addr_col], new[prov_col] = addr, prov  # computed from the old value
    return df.withColumns(new)


def rename(df: DataFrame, rules) -> DataFrame:
    mapping = {r["from"]: r["to"] for r in rules}
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ContractError(f"Columns not found: {missing}")
    return df.withColumnsRenamed(mapping)


def filter_columns(df: DataFrame, rules) -> DataFrame:
    rules = list(rules)
    if len(rules) != 1:
        raise ContractError("filter_columns takes exactly one output list")
    output = list(rules[0]["output"])
    missing = [c for c in output if c not in df.columns]
    if missing:
        raise ContractError(f"Columns not found: {missing}")
    return df.select(*output)


TRANSFORMS: dict[str, Callable] = {
    "split_name": split_name,
    "split_address": split_address,
    "rename": rename,
    "filter_columns": filter_columns,
}


def register_transform(name: str, fn: Callable[[DataFrame, list], DataFrame]) -> None:
    """Register ``fn(df, rules) -> DataFrame`` under a transformation name."""
    from .. import contract

    TRANSFORMS[name] = fn
    contract._EXTRA_TRANSFORMS.add(name)


def apply_transforms(df: DataFrame, contract: TableContract, *,
                     run_ts: _dt.datetime | None = None, source_file: str | None = None) -> DataFrame:
    """Apply the contract's transformations in config order."""
    for name, rules in contract.transforms:
        if name == "add_column":
            if run_ts is None:
                raise ContractError("add_column needs the run timestamp")
            df = add_lineage(df, rules, run_ts, source_file)
        elif name in TRANSFORMS:
            df = df.transform(TRANSFORMS[name], rules)
        else:
            raise KeyError(name)
    return df


def align(df: DataFrame, target: TableContract, keep: tuple[str, ...] = ()) -> DataFrame:
    """One projection onto the target contract: each target column is the
    source column converted to the declared type (NULL when unconvertible),
    or a typed NULL when absent; extra columns are dropped (``keep`` names
    helper columns to carry along at the end); target order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for c in target.columns:
        if c.name in types and c.spark_type.typeName() == "decimal":
            exprs.append(F.col(c.name).try_cast(c.spark_type).alias(c.name))
        elif c.name in types:
            exprs.append(cast_to(F.col(c.name), c.type, c.format, c.name, types[c.name]).alias(c.name))
        else:
            exprs.append(F.lit(None).cast(c.spark_type).alias(c.name))
    return df.select(*exprs, *keep)


def reshape(df: DataFrame, contract: TableContract, target: TableContract, *,
            run_ts: _dt.datetime | None = None, source_file: str | None = None) -> DataFrame:
    """Transformations of ``contract`` then alignment to ``target``."""
    return align(apply_transforms(df, contract, run_ts=run_ts, source_file=source_file), target)
