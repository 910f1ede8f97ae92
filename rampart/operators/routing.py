"""Valid / audit routing, audit rendering and record-count audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .validate import CORRUPT, ERRORS, FILE, INDEX, ROW_ID

AUDIT_COLUMNS = ("error_type", "error_rule", "error_column", "error_message")


def route_valid(checked: DataFrame) -> DataFrame:
    """Rows with no violation, helper columns dropped."""
    return (checked.filter(F.size(ERRORS) == 0)
            .drop(ERRORS, CORRUPT, ROW_ID, INDEX, FILE))


def route_errors(checked: DataFrame) -> DataFrame:
    """Rows with at least one violation (still carrying ``_errors``)."""
    return checked.filter(F.size(ERRORS) > 0)


def render_audit(errors: DataFrame) -> DataFrame:
    """Audit rows: source columns, ``_source_index`` and four error columns.

    Violations are rendered in their fixed rule order, repeats kept, joined
    with ``"; "``: ``error_message`` = ``rule(columns)``, ``error_rule`` =
    rule names, ``error_column`` = the column (or ``a,b`` key) of each.
    """
    e = F.col(ERRORS)
    rendered = {
        "error_type": F.lit("validation"),
        "error_rule": F.array_join(F.transform(e, lambda x: x["rule"]), "; "),
        "error_column": F.array_join(F.transform(e, lambda x: x["column"]), "; "),
        "error_message": F.array_join(
            F.transform(e, lambda x: F.concat(x["rule"], F.lit("("), x["column"], F.lit(")"))),
            "; "),
    }
    src = [c for c in errors.columns if c not in (ERRORS, ROW_ID, INDEX, FILE)]
    tail = [c for c in (FILE, INDEX) if c in errors.columns]
    return errors.select(*src, *tail, *[v.alias(k) for k, v in rendered.items()])


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, audit)`` from one checked DataFrame."""
    return route_valid(checked), render_audit(route_errors(checked))


def error_message(checked: DataFrame) -> DataFrame:
    """Every row with its rendered violations (NULL when it passes)."""
    e = F.col(ERRORS)
    msg = F.array_join(
        F.transform(e, lambda x: F.concat(x["rule"], F.lit("("), x["column"], F.lit(")"))), "; ")
    return checked.withColumn("error_message", F.when(F.size(e) > 0, msg)).drop(ERRORS)


def error_summary(checked: DataFrame) -> DataFrame:
    """Violations per (rule, column): one row each, with affected-row count.

    ``explode`` + ``groupBy`` aggregates map-side, so the shuffle carries one
    row per (task, rule, column) whatever the error volume.
    """
    return (checked.select(F.explode(ERRORS).alias("v"))
            .groupBy(F.col("v.rule").alias("error_rule"), F.col("v.column").alias("error_column"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def count_audit(checked: DataFrame) -> DataFrame:
    """One row: rows in, valid rows, error rows, violations (in = valid + error)."""
    n = F.size(ERRORS)
    return checked.agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count_if(n == 0).alias("n_valid"),
        F.count_if(n > 0).alias("n_error"),
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_violations"),
    )


def observe_counts(checked: DataFrame, name: str = "record_counts") -> tuple[DataFrame, Observation]:
    """Attach record counts to the plan; they fill in when the write runs,
    with no extra job (``observation.get`` after the action)."""
    obs = Observation(name)
    n = F.size(ERRORS)
    observed = checked.observe(
        obs,
        F.count(F.lit(1)).alias("n_in"),
        F.count_if(n == 0).alias("n_valid"),
        F.count_if(n > 0).alias("n_error"),
    )
    return observed, obs
