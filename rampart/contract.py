"""Table contracts: one YAML mapping per (layer, table), parsed on the driver.

The accepted YAML shape is the one already used by layered-load configs::

    table_name / schema_name / {rcv,l0,l1,audit,quarantine}_layer / *_format
    columns:        [{name, type, format?, db_type?, max_length?, precision?,
                      scale?, not_null?, primary_key?, unique?, range?, default?}]
    validation:     {validate_file: bool, validate_schema: bool}   # landing layer
                    or [{rule, column?, min?, max?, primary_key?, format?}]
    transformation: {name: [rule, ...], ...}                        # config order
    load_database:  {load_strategy, primary_key, batch_size?, num_partitions?}

Everything is checked eagerly so a bad contract fails before any Spark job.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from .errors import ContractError
from .functions.types import CAST_TYPES, CHECK_TYPES, spark_type

_NO_DEFAULT = object()

# Names understood by the contract.
FILE_CHECKS = ("validate_file", "validate_schema")
BUILTIN_RULES = ("not_null", "unique", "duplicate", "range", "format", "datatype")
BUILTIN_TRANSFORMS = ("add_column", "split_name", "split_address", "rename", "filter_columns")
LOAD_STRATEGIES = ("append_only", "truncate_and_insert", "upsert")
SUPPORTED_FORMATS = ("csv", "parquet")

# Registries filled by ``register_rule`` / ``register_transform``.
_EXTRA_RULES: set[str] = set()
_EXTRA_TRANSFORMS: set[str] = set()


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    format: str | None = None
    db_type: str | None = None
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    not_null: bool = False
    primary_key: bool = False
    unique: bool = False
    range: tuple[float, float] | None = None
    default: Any = _NO_DEFAULT
    exact_decimal: bool = False

    @property
    def has_default(self) -> bool:
        return self.default is not _NO_DEFAULT

    @property
    def spark_type(self) -> T.DataType:
        """Declared type; ``decimal`` is a double unless the contract opts in
        to exact decimals and the column declares a precision."""
        if self.exact_decimal and self.type == "decimal" and self.precision:
            return T.DecimalType(int(self.precision), int(self.scale or 0))
        return spark_type(self.type, self.name)


@dataclass(frozen=True)
class RuleSpec:
    """One record rule after list expansion.

    ``columns`` is the single checked column for row-local rules and the key
    set for ``unique`` / ``duplicate`` (empty key set = whole row).
    """

    rule: str
    columns: tuple[str, ...]
    params: tuple[tuple[str, Any], ...] = ()

    def param(self, key: str, default: Any = None) -> Any:
        return dict(self.params).get(key, default)

    @property
    def label(self) -> str:
        return f"{self.rule}({','.join(self.columns)})"


@dataclass(frozen=True)
class LoadSpec:
    strategy: str
    primary_key: tuple[str, ...]
    batch_size: int = 10000
    num_partitions: int | None = None


@dataclass(frozen=True)
class TableContract:
    table_name: str
    schema_name: str = "default"
    columns: tuple[ColumnSpec, ...] = ()
    rules: tuple[RuleSpec, ...] = ()
    file_checks: tuple[str, ...] = ()
    transforms: tuple[tuple[str, tuple[dict, ...]], ...] = ()
    load: LoadSpec | None = None
    layers: tuple[tuple[str, str], ...] = ()
    formats: tuple[tuple[str, str], ...] = ()
    raw: dict = field(default_factory=dict, compare=False, hash=False, repr=False)

    # -- schema ---------------------------------------------------------
    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, True) for c in self.columns])

    def string_schema(self) -> T.StructType:
        """All-text schema used to scan landing CSV without inference."""
        return T.StructType([T.StructField(c.name, T.StringType(), True) for c in self.columns])

    def layer(self, kind: str) -> str:
        return dict(self.layers).get(kind, kind)

    def format(self, kind: str) -> str:
        fmt = dict(self.formats).get(kind)
        if fmt is None:
            raise ContractError(f"No format declared for layer {kind}")
        return fmt

    # -- constructors ---------------------------------------------------
    @classmethod
    def from_dict(cls, d: dict) -> "TableContract":
        if not isinstance(d, dict) or "table_name" not in d:
            raise ContractError("contract needs a table_name")
        exact = bool(d.get("exact_decimal", False))
        cols = tuple(_column(c, exact) for c in d.get("columns", []) or [])
        names = [c.name for c in cols]
        if len(set(names)) != len(names):
            raise ContractError(f"duplicate column names in {d['table_name']}: {names}")
        rules: list[RuleSpec] = []
        checks: list[str] = []
        validation = d.get("validation") or []
        if isinstance(validation, dict):
            for name, enabled in validation.items():
                if name not in FILE_CHECKS:
                    raise ContractError(f"Unknown file check: {name}")
                if enabled:
                    checks.append(name)
        else:
            for v in validation:
                rules.extend(_expand_rule(v))
        transforms = []
        for name, rule_list in (d.get("transformation") or {}).items():
            if name not in BUILTIN_TRANSFORMS and name not in _EXTRA_TRANSFORMS:
                raise ContractError(f"Unknown transformation: {name}")
            rule_list = tuple(rule_list or ())
            if name == "filter_columns" and len(rule_list) != 1:
                raise ContractError("filter_columns takes exactly one output list")
            transforms.append((name, rule_list))
        load = None
        ld = d.get("load_database")
        if ld:
            strategy = ld.get("load_strategy")
            if strategy not in LOAD_STRATEGIES:
                raise ContractError(f"Unknown load strategy: {strategy}")
            pk = ld.get("primary_key")
            pk = tuple(pk) if isinstance(pk, (list, tuple)) else ((pk,) if pk else ())
            load = LoadSpec(strategy, pk, int(ld.get("batch_size", 10000)),
                            ld.get("num_partitions"))
        layers = tuple((k[:-6], v) for k, v in d.items() if k.endswith("_layer"))
        formats = []
        for k, v in d.items():
            if k.endswith("_format"):
                if v not in SUPPORTED_FORMATS:
                    raise ContractError(f"Unsupported file format: {v}")
                formats.append((k[:-7], v))
        return cls(d["table_name"], d.get("schema_name", "default"), cols, tuple(rules),
                   tuple(checks), tuple(transforms), load, layers, tuple(formats), dict(d))

    @classmethod
    def from_yaml(cls, path: str) -> "TableContract":
        """A contract file, local or on any Hadoop file system."""
        import yaml

        return cls.from_dict(yaml.safe_load(_contract_text(path)))


def _contract_text(path: str) -> str:
    if "://" not in path:
        with open(path, encoding="utf-8") as fh:
            return fh.read()
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    if spark is None:
        raise ContractError(f"A Spark session is needed to read {path}")
    rows = spark.read.text(path, wholetext=True).collect()  # one small file
    return rows[0][0] if rows else ""


def load_contract(config_root: str, layer: str, table: str) -> TableContract:
    """Contract lookup by (layer, table): ``{config_root}/{layer}/{table}.yaml``
    in a local folder or on a Hadoop file system (a root with a scheme)."""
    path = f"{config_root.rstrip('/')}/{layer}/{table}.yaml"
    if "://" in path:
        from pyspark.sql import SparkSession

        from .session import exists

        spark = SparkSession.getActiveSession()
        found = spark is not None and exists(spark, path)
    else:
        found = os.path.exists(path)
    if not found:
        raise ContractError(f"No contract for layer={layer} table={table} at {path}")
    return TableContract.from_yaml(path)


def _column(c: dict, exact_decimal: bool = False) -> ColumnSpec:
    if "name" not in c or "type" not in c:
        raise ContractError(f"column needs name and type: {c}")
    if str(c["type"]).lower() not in CAST_TYPES:
        raise ContractError(f"Unsupported type: {c['type']} in column {c['name']}")
    rng = c.get("range")
    if rng is not None:
        if len(rng) != 2:
            raise ContractError(f"range needs [min, max] in column {c['name']}")
        rng = (float(rng[0]), float(rng[1]))
    return ColumnSpec(
        name=c["name"], type=str(c["type"]).lower(), format=c.get("format"),
        db_type=c.get("db_type"), max_length=c.get("max_length"),
        precision=c.get("precision"), scale=c.get("scale"),
        not_null=bool(c.get("not_null", False)), primary_key=bool(c.get("primary_key", False)),
        unique=bool(c.get("unique", False)), range=rng,
        default=c["default"] if "default" in c else _NO_DEFAULT,
        exact_decimal=exact_decimal,
    )


def _as_list(v) -> list:
    if v is None:
        return []
    return list(v) if isinstance(v, (list, tuple)) else [v]


def _expand_rule(v: dict) -> list[RuleSpec]:
    """Expand one configured rule; a column list means one check per column
    for row-local rules and a composite key for ``unique``."""
    rule = v.get("rule")
    params = {k: val for k, val in v.items() if k not in ("rule", "column", "primary_key")}
    if rule in ("not_null", "range", "format", "datatype"):
        cols = _as_list(v.get("column"))
        if not cols:
            raise ContractError(f"rule {rule} needs a column")
        if rule == "range":
            if "min" not in v or "max" not in v:
                raise ContractError("range needs min and max")
            params = {"min": float(v["min"]), "max": float(v["max"])}
        if rule == "format" and not v.get("format"):
            raise ContractError("format needs a pattern")
        if rule == "datatype":
            t = str(v.get("type", "")).lower()
            if t not in CHECK_TYPES:
                raise ContractError(f"Unsupported type: {v.get('type')}")
        return [RuleSpec(rule, (c,), tuple(sorted(params.items()))) for c in cols]
    if rule == "unique":
        cols = _as_list(v.get("column"))
        if not cols:
            raise ContractError("unique needs a column")
        return [RuleSpec(rule, tuple(cols))]
    if rule == "duplicate":
        if "primary_key" not in v or v.get("primary_key") is None:
            return []  # skipped without a key, as configured contracts expect
        return [RuleSpec(rule, tuple(_as_list(v["primary_key"])))]
    if rule in _EXTRA_RULES:
        return [RuleSpec(rule, tuple(_as_list(v.get("column"))), tuple(sorted(params.items())))]
    raise ContractError(f"Unknown rule: {rule}")
