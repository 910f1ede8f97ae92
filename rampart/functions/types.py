"""Type vocabularies of the table contract and ANSI-safe cast / check builders.

Two vocabularies exist: the *cast* vocabulary used when a table is aligned to a
contract, and the narrower *check* vocabulary of the ``datatype`` rule.  Every
conversion uses ``try_cast`` / ``try_to_date`` so that ANSI mode stays on and an
unconvertible value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ContractError

# Config type name -> Spark type of the aligned column.
CAST_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.LongType(),
    "integer": T.LongType(),
    "decimal": T.DoubleType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampNTZType(),
}

# Type names the ``datatype`` rule can check.
CHECK_TYPES = ("string", "int", "decimal", "date", "datetime")

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def spark_type(type_name: str, column: str = "?") -> T.DataType:
    """Spark type for a contract type name; unknown names raise."""
    key = (type_name or "").lower()
    if key not in CAST_TYPES:
        raise ContractError(f"Unsupported type: {type_name} in column {column}")
    return CAST_TYPES[key]


def date_pattern(fmt: str) -> str:
    """Contract date format (``YYYY-MM-DD``) -> Spark datetime pattern."""
    return fmt.replace("YYYY", "yyyy").replace("DD", "dd")


def cast_to(column: Column | str, type_name: str, fmt: str | None = None,
            name: str = "?", source_type: T.DataType | None = None) -> Column:
    """Convert ``column`` to the contract type; bad values become NULL.

    ``fmt`` is honoured only for ``date`` (as in the contract).
    """
    c = F.col(column) if isinstance(column, str) else column
    target = spark_type(type_name, name)
    if type_name.lower() == "date" and fmt:
        if source_type is not None and isinstance(source_type, _TEMPORAL):
            return c.try_cast(target)
        return F.try_to_date(c.try_cast("string"), date_pattern(fmt))
    if source_type is not None and source_type == target:
        return c
    if isinstance(target, T.TimestampNTZType) and isinstance(source_type, T.TimestampType):
        return c.cast(target)
    return c.try_cast(target)


def type_ok(column: Column | str, type_name: str, source_type: T.DataType) -> Column:
    """Boolean: non-NULL value conforms to ``type_name`` (NULL is not checked here)."""
    c = F.col(column) if isinstance(column, str) else column
    key = (type_name or "").lower()
    if key not in CHECK_TYPES:
        raise ContractError(f"Unsupported type: {type_name}")
    if isinstance(source_type, T.StringType):
        if key == "string":
            return F.lit(True)
        target = {"int": "bigint", "decimal": "double", "date": "date",
                  "datetime": "timestamp_ntz"}[key]
        return c.try_cast(target).isNotNull()
    # Typed input: decide from the physical type, values only where needed.
    if key == "string":
        return F.lit(False)
    if key == "int":
        if isinstance(source_type, _INTEGRAL):
            return F.lit(True)
        if isinstance(source_type, _NUMERIC):
            d = c.cast("double")
            return ~F.isnan(d) & (d == F.floor(d)) & d.between(-9.223372036854776e18,
                                                                 9.223372036854776e18)
        return F.lit(False)
    if key == "decimal":
        return F.lit(isinstance(source_type, _NUMERIC))
    if key in ("date", "datetime"):
        return F.lit(isinstance(source_type, _TEMPORAL))
    return F.lit(False)
