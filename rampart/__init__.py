"""rampart: contract-driven data-quality gates and layered loads on Spark."""

from .contract import ColumnSpec, LoadSpec, RuleSpec, TableContract, load_contract
from .errors import ContractError, LoadError, StageError, ValidationError
from .operators.routing import (count_audit, error_summary, observe_counts, render_audit,
                                route_errors, route_valid, split)
from .operators.validate import check_rules, validate

__all__ = [
    "ColumnSpec", "LoadSpec", "RuleSpec", "TableContract", "load_contract", "ContractError",
    "LoadError", "StageError", "ValidationError", "count_audit", "error_summary",
    "observe_counts", "render_audit", "route_errors", "route_valid", "split", "check_rules",
    "validate",
]
