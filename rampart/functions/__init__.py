from .rules import (VIOLATION_TYPE, datatype, flag, in_range, malformed,
                    matches_date_format, not_null, register_rule, violation)
from .text import address_parts, split_address, split_name, squash_spaces
from .types import CAST_TYPES, CHECK_TYPES, cast_to, date_pattern, spark_type, type_ok

__all__ = [
    "VIOLATION_TYPE", "datatype", "flag", "in_range", "malformed", "matches_date_format",
    "not_null", "register_rule", "violation", "address_parts", "split_address",
    "split_name", "squash_spaces", "CAST_TYPES", "CHECK_TYPES", "cast_to", "date_pattern",
    "spark_type", "type_ok",
]
