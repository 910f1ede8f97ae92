"""Record validation: every row is tested against every rule at once.

``validate`` returns the input plus one ``_errors`` column, an array of
``struct<rule, column>`` in a fixed order: malformed CSV row, whole-row
duplicate, ``datatype`` per declared column, then the configured rules in
config order.  No rule short-circuits another.

Row-local rules are plain expressions evaluated in one projection.  Rules
over a key set (``unique``, ``duplicate``, registered ones) are answered by one aggregate per
distinct key set, ``count(*)`` and the first row in keep-first order, which
Spark combines map-side before the shuffle, so a hot key (even a third of
the table) costs one partial-aggregate row per task instead of one giant
window group.  A key value of more than ``keysets.LONG`` bytes is grouped and joined by
a digest of 128 bits, so long texts are not moved; real values are compared only among rows
whose digest repeats, and decide, should different ones share a digest.
Where keep-first order needs more than a number, keys are counted first and only
rows of repeated ones are put in order.  Only keys that repeat survive the
aggregate; that table is written once and joined back to the rows (left join, null-safe on
the key), so the planner knows its size: few repeated keys are broadcast and the rows never
move, many are joined by shuffle, where AQE splits a key that is hot on the
row side.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import RuleSpec, TableContract
from ..errors import ContractError
from ..functions import rules as R
from ..session import staged
from . import keysets

ERRORS = "_errors"
INDEX = "_source_index"
FILE = "_source_file"
CORRUPT = "_corrupt_record"
ROW_ID = "_row_id"
HELPERS = (INDEX, FILE, CORRUPT, ROW_ID, ERRORS)

_CHECK_ALIASES = {"integer": "int", "double": "decimal", "timestamp": "datetime"}


def data_columns(df: DataFrame) -> list[str]:
    """Columns that carry data (helper and lineage-index columns excluded)."""
    return [c for c in df.columns if c not in HELPERS]


def with_row_id(df: DataFrame) -> DataFrame:
    """Attach a unique ``_row_id`` when the input has no source index.

    The input is written once with its ids to the shared folder: ids are
    handed out anew whenever a plan is evaluated, and after a shuffle not in
    the same way, so every reader must see the ids of one evaluation.
    """
    if INDEX in df.columns or ROW_ID in df.columns:
        return df
    return staged(df.withColumn(ROW_ID, F.monotonically_increasing_id()), "row-ids")


def _identity(df: DataFrame) -> str:
    """The unique row-position column (``_source_index`` is dense across all
    input files, so it alone identifies a row)."""
    return INDEX if INDEX in df.columns else ROW_ID


def _expand(contract: TableContract | None, rules) -> list[RuleSpec]:
    if rules is not None:
        return list(rules)
    return list(contract.rules) if contract is not None else []


def validate(df: DataFrame, contract: TableContract | None = None, *,
             rules: list[RuleSpec] | None = None,
             order_by: list[str] | None = None,
             whole_row_duplicate: bool = True,
             check_datatypes: bool = True,
             stage_keys: bool = True,
             counts: "RuleCounts | None" = None) -> DataFrame:
    """Check ``df`` against a contract; returns ``df`` + ``_errors``.

    ``counts`` receives the numbers of rows and violations when the result is
    written, with no scan of its own.

    ``order_by`` sets keep-first order for ``duplicate`` (default: source
    order, ``_source_index``); the unique row id always breaks ties so
    exactly one row of each key is kept.

    An input without ``_source_index`` is written once with row ids when a
    ``duplicate`` rule needs to tell its rows apart.  Each table of repeated
    keys is written once (``stage_keys``), which tells the planner its size;
    otherwise it stays part of the plan and AQE chooses the join.
    """
    spec_rules = _expand(contract, rules)
    keep_first = whole_row_duplicate or any(r.rule == "duplicate" for r in spec_rules)
    added_id = keep_first and INDEX not in df.columns and ROW_ID not in df.columns
    base = with_row_id(df) if keep_first else df
    schema = {f.name: f.dataType for f in base.schema.fields}
    cols = data_columns(base)
    ident = _identity(base) if keep_first else None
    unknown = [c for c in (order_by or []) if c not in schema]
    if unknown:
        raise ContractError(f"Columns not found: {unknown} in order_by")
    # Keep-first rank: a plain long (hash-aggregate friendly) unless the
    # caller orders by other columns, then a struct ending in the unique id.
    rank = None
    if keep_first:
        rank = (F.struct(*[F.col(c) for c in list(order_by)], F.col(ident)) if order_by
                else F.col(ident))

    # ---- plan the rule list in its fixed order ------------------------
    plan: list[tuple[str, object]] = []  # ("row", Column) | ("group", (kind or KeyRule, keys, name))
    if CORRUPT in base.columns:
        plan.append(("row", R.malformed(CORRUPT)))
    if whole_row_duplicate:
        plan.append(("group", ("duplicate", tuple(cols), "duplicate")))
    if check_datatypes and contract is not None:
        for c in contract.columns:
            if c.name in schema:
                t = _CHECK_ALIASES.get(c.type, c.type)
                plan.append(("row", R.datatype(c.name, t, schema[c.name])))
    for r in spec_rules:
        for col in (r.columns if r.rule in ("unique", "duplicate") or r.rule in R.KEY_RULES else r.columns[:1]):
            if col not in schema:
                raise ContractError(f"Columns not found: [{col!r}] for rule {r.label}")
        if r.rule == "not_null":
            plan.append(("row", R.not_null(r.columns[0])))
        elif r.rule == "range":
            c = r.columns[0]
            plan.append(("row", R.in_range(c, r.param("min"), r.param("max"), schema[c])))
        elif r.rule == "format":
            plan.append(("row", R.matches_date_format(r.columns[0], r.param("format"))))
        elif r.rule == "datatype":
            c = r.columns[0]
            plan.append(("row", R.datatype(c, r.param("type"), schema[c])))
        elif r.rule in ("unique", "duplicate"):
            plan.append(("group", (r.rule, tuple(r.columns) or tuple(cols), r.rule)))
        elif r.rule in R.KEY_RULES:
            plan.append(("group", (R.KEY_RULES[r.rule](base.schema, r), tuple(r.columns), r.rule)))
        elif r.rule in R.ROW_RULES:
            plan.append(("row", R.ROW_RULES[r.rule](base.schema, r)))
        else:
            raise ContractError(f"Unknown rule: {r.rule}")

    # ---- one aggregate per distinct key set, joined back --------------
    key_sets: dict[tuple[str, ...], _KeySet] = {}
    for kind, payload in plan:
        if kind == "group":
            rule, keys, _ = payload
            slot = key_sets.setdefault(keys, _KeySet(len(key_sets), keys, schema))
            slot.rules.append(rule)
    # Narrow key sets first.  A wider key set that contains a narrower one
    # only needs the rows whose narrower key repeats: rows that share the wide
    # key share every narrower key (NULL-safe), so no repeated wide key is
    # missed.  Whole-row duplicates are thus searched only inside repeated
    # primary keys instead of shuffling every full row.
    # Key sets that wait for no other are searched at the same time.
    order = sorted(key_sets.values(), key=lambda s: len(s.keys))
    parents = {s: next((p for p in order[:i] if set(p.keys) < set(s.keys)), None) for i, s in enumerate(order)}

    def find(slot: _KeySet) -> None:
        parent, source = parents[slot], base
        if parent is not None:
            source, slot.exact = parent.join(base, parent.stats, "left_semi"), True  # few rows: compared as they are
        slot.find(source, rank, stage_keys)

    alone = [s for s in order if parents[s] is None]
    with ThreadPoolExecutor(max(1, len(alone))) as pool:
        list(pool.map(inheritable_thread_target(base.sparkSession)(find), alone))
    out = base
    for slot in order:
        if parents[slot] is not None:
            find(slot)
        out = slot.join(out, slot.stats, "left")

    exprs: list[Column] = []
    for kind, payload in plan:
        if kind == "row":
            exprs.append(payload)
            continue
        rule, keys, name = payload
        slot = key_sets[keys]
        n, first = F.col(f"{slot.prefix}n"), F.col(f"{slot.prefix}first")
        all_present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        if rule == "unique":
            exprs.append(R.flag(n.isNotNull() & all_present, "unique", keys))
        elif rule == "duplicate":
            exprs.append(R.flag(first.isNotNull() & ~rank.eqNullSafe(first), "duplicate", keys))
        else:
            exprs.append(R.flag(n.isNotNull() & all_present & rule.broken(F.col(slot.result(rule))), name, keys))

    keep = [F.col(c) for c in base.columns if not (added_id and c == ROW_ID)]
    if not exprs:
        errors = F.array().cast(T.ArrayType(R.VIOLATION_TYPE))
    elif counts is None:
        errors = F.filter(F.array(*exprs), lambda x: x.isNotNull())
    else:
        out = counts.attach(out.select(*keep, F.array(*exprs).alias(ERRORS)), len(exprs))
        errors = F.filter(ERRORS, lambda x: x.isNotNull())
    return out.select(*keep, errors.alias(ERRORS))


class RuleCounts:
    """Rows in, valid and with errors, and violations by rule, counted while the checked rows are written."""

    def __init__(self):
        self._seen = Observation()
        self._n = 0

    def attach(self, flags: DataFrame, n: int) -> DataFrame:
        """``flags``: rows whose ERRORS have a place for each of ``n`` rules, NULL where it holds."""
        self._n = n
        broken = [F.get(F.col(ERRORS), F.lit(i)) for i in range(n)]
        any_broken = F.exists(ERRORS, lambda x: x.isNotNull())
        label = [F.max(F.concat(b["rule"], F.lit("("), b["column"], F.lit(")"))).alias(f"label{i}") for i, b in enumerate(broken)]
        return flags.observe(self._seen, F.count(F.lit(1)).alias("n_in"), F.count_if(any_broken).alias("n_error"),
                             *[F.count(b).alias(f"n{i}") for i, b in enumerate(broken)], *label)

    @property
    def totals(self) -> dict[str, int]:
        if not self._n:
            return {}
        got = self._seen.get
        return {"n_in": got["n_in"], "n_valid": got["n_in"] - got["n_error"], "n_error": got["n_error"]}

    @property
    def by_rule(self) -> dict[str, int]:
        """``rule(columns)`` -> violations, of the rules that were broken."""
        out: dict[str, int] = {}
        if self._n:
            got = self._seen.get
            for i in range(self._n):
                if got[f"n{i}"]:
                    out[got[f"label{i}"]] = out.get(got[f"label{i}"], 0) + got[f"n{i}"]
        return out


class _KeySet:
    """Columns that are a key together, the rules about it and, once found, its repeated keys."""

    def __init__(self, number: int, keys: tuple[str, ...], types: dict[str, T.DataType]):
        self.keys, self.types, self.prefix = keys, types, f"_g{number}_"
        self.rules: list = []  # "unique", "duplicate" or a KeyRule
        self.texts = [k for k in keys if keysets.is_text(types[k])]
        self.stats: DataFrame | None = None
        self.exact = not self.texts

    def result(self, rule: R.KeyRule) -> str:
        return f"{self.prefix}a{self.rules.index(rule)}"

    def values(self) -> list[Column]:
        """What stands for the key: its columns if ``exact``, else :func:`keysets.compact`."""
        found = [F.col(k) for k in self.keys] if self.exact else keysets.compact(self.keys, self.types)
        return [v.alias(f"{self.prefix}k{i}") for i, v in enumerate(found)]

    def join(self, df: DataFrame, keyed: DataFrame, how: str) -> DataFrame:
        """``df`` with what a table of keys has for each row's key, NULLs being equal."""
        names = [c for c in keyed.columns if c.startswith(f"{self.prefix}k")]
        own = [f"{n}_" for n in names]
        rows = df.select("*", *[v.alias(o) for v, o in zip(self.values(), own)])
        same = [F.col(o).eqNullSafe(F.col(n)) if self.exact else F.col(o) == F.col(n) for o, n in zip(own, names)]
        return rows.join(keyed, reduce(lambda a, b: a & b, same), how).drop(*own, *names)

    def find(self, source: DataFrame, rank: Column | None, stage: bool) -> None:
        """Repeated keys with their count, the registered rules' aggregates and,
        for ``duplicate``, their first row's rank."""
        if not stage:
            self.exact = True
        repeated = self._repeated(source, rank, stage)
        if self.exact:
            self.stats = staged(repeated, "key-stats") if stage else repeated
            return
        long = F.col(f"{self.prefix}k0") == ""
        seen = Observation()
        self.stats = staged(repeated.observe(seen, F.count_if(long).alias("n")), "key-stats")
        if seen.get["n"] and self._collide(source, self.stats.where(long)):
            self.exact = True
            self.stats = staged(self._repeated(source, rank, stage), "key-stats")

    def _repeated(self, source: DataFrame, rank: Column | None, stage: bool) -> DataFrame:
        made = [F.count(F.lit(1)).alias(f"{self.prefix}n")]
        first = rank if "duplicate" in self.rules else None
        if first is None:
            made.append(F.lit(None).cast("boolean").alias(f"{self.prefix}first"))
        else:
            made.append(F.min(first).cast(_type_of(source, first)).alias(f"{self.prefix}first"))
        made += [r.aggregate(r.value).alias(self.result(r)) for r in self.rules if isinstance(r, R.KeyRule)]
        if stage and first is not None and isinstance(_type_of(source, first), T.StructType):
            counts = source.groupBy(*self.values()).count().where("count > 1").drop("count")
            source = self.join(source, staged(counts, "repeated"), "left_semi")
        return source.groupBy(*self.values()).agg(*made).where(F.col(f"{self.prefix}n") > 1)

    def _collide(self, source: DataFrame, long: DataFrame) -> bool:
        """Whether different long keys have the same digest."""
        again = self.join(source, long.select(*[c for c in long.columns if c.startswith(f"{self.prefix}k")]), "left_semi")
        real = F.struct(*[(keysets.as_text(k, self.types[k]) if k in self.texts else F.col(k)).alias(f"t{i}") for i, k in enumerate(self.keys)])
        return not again.groupBy(*self.values()).agg(F.min(real).alias("lo"), F.max(real).alias("hi")).where("lo <> hi").isEmpty()


def _type_of(df: DataFrame, col: Column) -> T.DataType:
    return df.select(col.alias("_r")).schema["_r"].dataType


def check_rules(df: DataFrame, rules: list[RuleSpec], order_by: list[str] | None = None) -> DataFrame:
    """Only the given rules: no implicit whole-row duplicate, no datatype pass."""
    return validate(df, None, rules=rules, order_by=order_by,
                    whole_row_duplicate=False, check_datatypes=False)
