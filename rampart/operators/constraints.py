"""Serving-table constraints checked as one distributed pass before a load.

NOT NULL, PRIMARY KEY (not null + unique), UNIQUE, CHECK range, VARCHAR(n)
length and NUMERIC(p,s) fit all come from the target contract's column
declarations and reuse the rule machinery of ``validate`` (row-local
expressions plus one aggregate per key set).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import RuleSpec, TableContract
from ..functions import rules as R
from .validate import ERRORS, validate


def _check(schema, spec: RuleSpec):
    c = spec.columns[0]
    kind = spec.param("kind")
    col = F.col(c)
    if kind == "not_null":
        return R.flag(col.isNull(), "not_null", c)
    if kind == "check":
        v = R.as_double(c, schema[c].dataType)
        return R.flag(v.isNotNull() & ~((v >= spec.param("lo")) & (v <= spec.param("hi"))), "check", c)
    if kind == "max_length":
        return R.flag(F.length(col.cast("string")) > spec.param("n"), "max_length", c)
    if kind == "numeric":
        p, s = spec.param("p"), spec.param("s")
        fits = col.try_cast(f"decimal({p},{s})").isNotNull()
        return R.flag(col.isNotNull() & ~fits, "numeric", c)
    raise ValueError(kind)


R.ROW_RULES["_constraint"] = _check


def constraint_rules(contract: TableContract, keys: list[str] | None = None) -> list[RuleSpec]:
    """Rules of the declared constraints and of the load key: ``keys`` together
    are unique, and so are the declared primary key's columns together."""
    out: list[RuleSpec] = []
    for c in contract.columns:
        def add(kind, **kw):
            out.append(RuleSpec("_constraint", (c.name,), tuple(sorted({"kind": kind, **kw}.items()))))
        if c.not_null or c.primary_key:
            add("not_null")
        if c.range is not None:
            add("check", lo=c.range[0], hi=c.range[1])
        db = (c.db_type or "").upper()
        if db == "VARCHAR" and c.max_length:
            add("max_length", n=int(c.max_length))
        if db in ("NUMERIC", "DECIMAL") and c.precision:
            add("numeric", p=int(c.precision), s=int(c.scale or 0))
    out += [RuleSpec("unique", key) for key in unique_sets(contract, keys)]
    return out


def unique_sets(contract: TableContract, keys: list[str] | None = None) -> list[tuple[str, ...]]:
    """Column sets that are unique in the table: each UNIQUE column, the primary
    key's columns together, and ``keys`` together."""
    primary = tuple(c.name for c in contract.columns if c.primary_key)
    alone = [(c.name,) for c in contract.columns if c.unique or (c.name,) == primary]
    return [key for key in dict.fromkeys([*alone, primary, tuple(keys or ())]) if key]


def constraint_check(df: DataFrame, contract: TableContract, keys: list[str] | None = None, *,
                     only_keys: bool = False) -> DataFrame:
    """``df`` + ``_errors`` listing every constraint each row breaks.

    Unique / primary-key breaches are reported as ``unique(cols)`` on every
    row of a repeated key; NULL keys are reported by ``not_null``.
    ``only_keys`` checks nothing but the uniqueness of ``keys``.
    """
    rules = [RuleSpec("unique", tuple(keys))] if only_keys else constraint_rules(contract, keys)
    return validate(df, None, rules=rules, whole_row_duplicate=False, check_datatypes=False)


def apply_defaults(df: DataFrame, contract: TableContract) -> DataFrame:
    """DEFAULT v for declared columns the input does not supply at all.
    A column that is present keeps its NULLs (a default is not a coalesce)."""
    new = {c.name: F.lit(c.default).cast(c.spark_type) for c in contract.columns
           if c.has_default and c.name not in df.columns}
    return df.withColumns(new) if new else df


def violations_summary(checked: DataFrame) -> DataFrame:
    return (checked.select(F.explode(ERRORS).alias("v"))
            .groupBy(F.col("v.rule").alias("rule"), F.col("v.column").alias("column"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
