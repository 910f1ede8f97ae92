"""Row-local record rules as ``Column`` builders.

Each builder returns a nullable ``struct<rule:string, column:string>``: NULL
means the row passes, a struct names the violated rule and its column(s).
They are plain Catalyst expressions, so any number of them evaluates inside
one whole-stage-codegen projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import date_pattern, type_ok

VIOLATION_TYPE = T.StructType([
    T.StructField("rule", T.StringType(), False),
    T.StructField("column", T.StringType(), False),
])


def violation(rule: str, columns) -> Column:
    cols = [columns] if isinstance(columns, str) else list(columns)
    return F.struct(F.lit(rule).alias("rule"), F.lit(",".join(cols)).alias("column"))


def flag(condition: Column, rule: str, columns) -> Column:
    """Violation when ``condition`` is true; NULL (pass) when false or NULL."""
    return F.when(condition, violation(rule, columns))


def not_null(column: str) -> Column:
    return flag(F.col(column).isNull(), "not_null", column)


def as_double(column: str, dtype: T.DataType) -> Column:
    c = F.col(column)
    if isinstance(dtype, T.StringType):
        return c.try_cast("double")
    if isinstance(dtype, (T.NumericType,)):
        return c.cast("double")
    return F.lit(None).cast("double")


def in_range(column: str, lo: float, hi: float, dtype: T.DataType) -> Column:
    """Inclusive range; NULL passes and so does text that is not a number
    (the datatype rule reports it). NaN and +-Infinity fail."""
    v = as_double(column, dtype)
    return flag(v.isNotNull() & ~((v >= F.lit(lo)) & (v <= F.lit(hi))), "range", column)


def matches_date_format(column: str, fmt: str) -> Column:
    """Strict date pattern check (``yyyy``/``MM``/``dd``); NULL passes."""
    c = F.col(column)
    parsed = F.try_to_date(c.try_cast("string"), date_pattern(fmt))
    return flag(c.isNotNull() & parsed.isNull(), "format", column)


def datatype(column: str, type_name: str, dtype: T.DataType) -> Column:
    """Value conforms to a contract type; NULL is left to ``not_null``."""
    c = F.col(column)
    return flag(c.isNotNull() & ~type_ok(c, type_name, dtype), "datatype", column)


def malformed(corrupt_column: str) -> Column:
    """CSV rows that did not fit the declared column count."""
    return flag(F.col(corrupt_column).isNotNull(), "malformed", "row")


@dataclass(frozen=True, eq=False)
class KeyRule:
    """A rule about the rows of a key that repeats: ``aggregate`` of the rows' ``value``, and when
    its result breaks the rule for all of them. Keys with a NULL pass."""

    value: Column
    aggregate: Callable[[Column], Column]
    broken: Callable[[Column], Column]


#: Rule name -> builder(schema, RuleSpec) -> KeyRule; the spec's columns are the key.
KEY_RULES: dict[str, Callable] = {}


def register_key_rule(name: str, builder: Callable) -> None:
    """Register a rule over a key set (``column`` in a contract's ``validation`` list).

    ``builder(schema: StructType, spec: RuleSpec) -> KeyRule``; it is answered in the passes
    that ``unique`` and ``duplicate`` share.  A key with one row never breaks it.
    """
    from .. import contract

    KEY_RULES[name] = builder
    contract._EXTRA_RULES.add(name)


# Extension surface: rule name -> builder(schema, RuleSpec) -> Column.
ROW_RULES: dict[str, Callable] = {}


def register_rule(name: str, builder: Callable) -> None:
    """Register a row-local rule usable from a contract's ``validation`` list.

    ``builder(schema: StructType, spec: RuleSpec) -> Column`` returns a
    violation struct (see :func:`flag`) or NULL.
    """
    from .. import contract

    ROW_RULES[name] = builder
    contract._EXTRA_RULES.add(name)
