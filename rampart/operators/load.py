"""Load strategies onto a serving table (:mod:`store`): plain joins and unions, one new folder a load.

* ``append_only``: the incoming rows are added; a key already in the table is an
  error, or its row is skipped with ``on_conflict="ignore"`` (left-anti on the key) so reruns are safe.
* ``truncate_and_insert``: the table is the incoming rows.
* ``upsert``: the segments (key ranges) with incoming keys are rewritten: their rows without an
  incoming key, and the incoming rows. All other segments stay.

Incoming rows are checked first: the contract's constraints, that the load key, composite ones
included, is unique among them, and that no UNIQUE column or primary key has a value that a row
stays in the table with (one probe of the table's key columns, see :mod:`keysets`). The
checked rows are written once to the shared folder, so the input is evaluated once. Rows that break a
constraint refuse the load, or go to ``rejects`` with their reasons while the others load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import TableContract
from ..errors import LoadError
from ..functions import rules as R
from ..session import scratch_scope, staged
from . import keysets, store
from .constraints import apply_defaults, constraint_check, unique_sets, violations_summary
from .reshape import align
from .routing import render_audit
from .validate import ERRORS


# ---------------------------------------------------------------- storage
def table_exists(spark: SparkSession, root: str) -> bool:
    return store.current(spark, root) is not None


def create_target(spark: SparkSession, contract: TableContract, root: str) -> bool:
    """Create the empty table with the contract's columns and types if absent."""
    if table_exists(spark, root):
        return False
    first = store.Version(1)
    name, folder = store.write(spark, spark.createDataFrame([], contract.struct_type()), root, first)
    first.folders[name] = folder
    store.publish(spark, root, first)
    return True


def read_target(spark: SparkSession, root: str, contract: TableContract | None = None) -> DataFrame:
    version = store.current(spark, root)
    if version is None:
        table = contract.table_name if contract is not None else root
        raise LoadError(f"There is no table ({table})")
    return store.read(spark, root, version, contract)


# ---------------------------------------------------------- pure merges
def _keys(contract: TableContract, keys) -> list[str]:
    if keys:
        return [keys] if isinstance(keys, str) else list(keys)
    if contract.load and contract.load.primary_key:
        return list(contract.load.primary_key)
    pk = [c.name for c in contract.columns if c.primary_key]
    if not pk:
        raise LoadError(f"No primary key for {contract.table_name}")
    return pk


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1").drop("count")


def conflicts(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key already exists in the target."""
    return incoming.join(target.select(*keys), keys, "left_semi")


def merge_append(target: DataFrame, incoming: DataFrame, keys: list[str],
                 on_conflict: str = "error") -> DataFrame:
    """Rows to append: all incoming (``error``: caller checks conflicts first)
    or only incoming rows with a new key (``ignore``)."""
    if on_conflict == "ignore":
        return incoming.join(target.select(*keys), keys, "left_anti")
    return incoming


def merge_upsert(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Resulting table: untouched target rows + every incoming row."""
    kept = target.join(incoming.select(*keys), keys, "left_anti")
    return kept.unionByName(incoming.select(*target.columns))


# --------------------------------------------------------------- checks
def prepare(incoming: DataFrame, contract: TableContract, keys: list[str], check: bool = True,
            rejects: str | None = None, stored: DataFrame | None = None,
            sets: list[tuple[str, ...]] = (), replacing: bool = False) -> DataFrame:
    """The rows to load: defaults for absent columns, alignment to the contract,
    constraints (``check``), uniqueness of the load key among them (always), and of
    ``sets`` against ``stored`` — with ``replacing``, against the stored rows whose load key none of the
    loading rows has.

    They are written once with their errors.  Rows with errors raise, or are
    written to the folder ``rejects`` and left out.  A row that is refused does not
    replace a stored one, which may refuse another; so the stored rows are asked until no
    further row is refused."""
    df = align(apply_defaults(incoming, contract), contract)
    if not check and not keys:
        return staged(df, "incoming")
    checked = staged(constraint_check(df, contract, keys, only_keys=not check), "incoming")
    good = F.size(ERRORS) == 0
    if rejects is None:
        _refuse(checked.where(~good), contract, keys)
    while sets:
        loading = checked.where(good).select(*contract.column_names)
        needed = dict.fromkeys([*(k for s in sets for k in s), *(keys if replacing else ())])
        others = stored.select(*needed)
        if replacing:
            others = others.join(loading.select(*keys), keys, "left_anti")
        taken = keysets.probe(loading, others, sets)
        if not taken:
            break
        if rejects is None:
            raise LoadError(f"duplicate key value violates unique constraint on {[list(s) for s in taken]} of {contract.table_name}")
        checked = staged(_flag_taken(checked, taken), "incoming")
    if rejects is not None:
        render_audit(checked.where(~good)).write.mode("overwrite").parquet(rejects)
        checked = checked.where(good)
    return checked.select(*contract.column_names)


def _refuse(bad: DataFrame, contract: TableContract, keys: list[str]) -> None:
    summary = sorted((r["rule"], r["column"], r["n_rows"]) for r in violations_summary(bad).collect())
    if any(r == "unique" and c == ",".join(keys) for r, c, _ in summary):
        raise LoadError(f"incoming rows repeat a key of {keys}, duplicate key value violates unique constraint: {summary}")
    if summary:
        raise LoadError(f"Constraint violation in {contract.table_name}: {summary}")


def _flag_taken(checked: DataFrame, taken: dict[tuple[str, ...], DataFrame]) -> DataFrame:
    """``unique(columns)`` added to the errors of rows whose values are taken."""
    for columns, values in taken.items():
        renamed = values.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)], F.lit(True).alias("_taken"))
        same = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(columns)]
        error = F.array(R.violation("unique", columns))
        errors = F.when(F.col("_taken"), F.array_union(ERRORS, error)).otherwise(F.col(ERRORS))
        checked = checked.join(renamed, same, "left").withColumn(ERRORS, errors).drop("_taken", *[f"_k{i}" for i in range(len(columns))])
    return checked


# --------------------------------------------------------------- loads
def _existing(spark: SparkSession, contract: TableContract, root: str) -> store.Version:
    found = store.current(spark, root)
    if found is None:
        raise LoadError(f"There is no table ({contract.table_name})")
    return found


def _following(version: store.Version, rows: DataFrame, keys: list[str], empty: bool) -> store.Version:
    """The next version without its new folder; a table without rows gets the bounds of these."""
    out = store.Version(version.number + 1, version.keys, version.bounds, dict(version.folders))
    if empty or not out.keys:
        out.keys, out.bounds = list(keys), store.choose_bounds(rows, keys)
    return out


def _has_rows(version: store.Version) -> bool:
    return any(f.segments for f in version.folders.values())


def append(spark: SparkSession, incoming: DataFrame, contract: TableContract, root: str, *,
           keys=None, on_conflict: str = "error", check: bool = True, rejects: str | None = None) -> None:
    version = _existing(spark, contract, root)
    keys = _keys(contract, keys)
    with scratch_scope():
        target = store.read(spark, root, version, contract)
        sets = unique_sets(contract, keys) if check else [tuple(keys)]
        if on_conflict == "ignore":
            aligned = align(apply_defaults(incoming, contract), contract)
            incoming = staged(merge_append(target, aligned, keys, on_conflict), "new-keys")
            sets = [s for s in sets if not set(keys) <= set(s)]
        rows = prepare(incoming, contract, keys, check, rejects, target, sets if _has_rows(version) else [])
        following = _following(version, rows, keys, not _has_rows(version))
        name, folder = store.write(spark, rows, root, following, _partitions(contract))
    following.folders[name] = folder
    store.publish(spark, root, following)


def replace(spark: SparkSession, incoming: DataFrame, contract: TableContract, root: str, *,
            keys=None, check: bool = True, rejects: str | None = None) -> None:
    version = _existing(spark, contract, root)
    declared = keys or (contract.load and contract.load.primary_key) or any(c.primary_key for c in contract.columns)
    keys = _keys(contract, keys) if declared else []
    with scratch_scope():
        rows = prepare(incoming, contract, keys, check, rejects)
        following = _following(version, rows, keys, True)
        name, folder = store.write(spark, rows, root, following, _partitions(contract))
    following.folders = {name: folder}
    store.publish(spark, root, following)


def upsert(spark: SparkSession, incoming: DataFrame, contract: TableContract, root: str, *,
           keys=None, check: bool = True, rejects: str | None = None) -> None:
    version = _existing(spark, contract, root)
    keys = _keys(contract, keys)
    with scratch_scope():
        target = store.read(spark, root, version, contract)
        # a stored row with the same values in a set that holds the load key is replaced
        sets = [s for s in unique_sets(contract, keys) if not set(keys) <= set(s)] if check and _has_rows(version) else []
        rows = prepare(incoming, contract, keys, check, rejects, target, sets, replacing=True)
        following = _following(version, rows, keys, not _has_rows(version))
        touched = _touched(rows, keys, following)
        new = rows
        if any(touched & set(f.segments) for f in version.folders.values()):
            new = merge_upsert(store.read(spark, root, version, contract, touched), rows, keys)
        name, folder = store.write(spark, new, root, following, _partitions(contract))
    following.folders = store.without_segments(following.folders, touched) | {name: folder}
    store.publish(spark, root, following)


def _touched(rows: DataFrame, keys: list[str], version: store.Version) -> set[int]:
    """The segments that may hold a row with one of the load keys: a row for each to the driver."""
    if set(version.keys) - set(keys):
        return set(range(version.n_segments))  # the load key does not say where a row lies
    found = rows.select(store.segment_of(version.keys, version.bounds, rows.schema).alias("s")).distinct()
    return {r["s"] for r in found.collect()}


def recluster(spark: SparkSession, contract: TableContract, root: str, keys=None) -> None:
    """Rewrite the table as one folder with new bounds, for one that has outgrown its first load or was
    appended to many times."""
    version = _existing(spark, contract, root)
    keys = _keys(contract, keys)
    with scratch_scope():
        rows = staged(store.read(spark, root, version, contract), "recluster")
        following = _following(version, rows, keys, True)
        name, folder = store.write(spark, rows, root, following, _partitions(contract))
    following.folders = {name: folder}
    store.publish(spark, root, following)


def _partitions(contract: TableContract) -> int | None:
    return contract.load.num_partitions if contract.load else None


STRATEGIES = {"append_only": append, "truncate_and_insert": replace, "upsert": upsert}


def load(spark: SparkSession, incoming: DataFrame, contract: TableContract, root: str,
         strategy: str | None = None, **kw) -> None:
    """Dispatch on the contract's ``load_strategy`` (or ``strategy``)."""
    name = strategy or (contract.load.strategy if contract.load else None)
    if name not in STRATEGIES:
        raise LoadError(f"Unknown load strategy: {name}")
    STRATEGIES[name](spark, incoming, contract, root, **kw)
