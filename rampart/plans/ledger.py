"""Run ledger: one row per (table, run, stage) event, kept as append-only
Parquet, with the latest state per (table, run) computed by aggregation."""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = ("table_name string, run_id string, stage string, status string, "
                 "started_at timestamp_ntz, ended_at timestamp_ntz, source string, "
                 "error string, n_in bigint, n_valid bigint, n_error bigint, "
                 "n_rejected_files bigint, n_rejected_rows bigint, errors_by_rule array<struct<rule:string,n_rows:bigint>>, seq bigint")

# Run states.
STATUSES = ("RUNNING", "FAILED", "SUCCESS")


def record(spark: SparkSession, ledger_path: str, table: str, run_id: str, stage: str,
           status: str, started_at: _dt.datetime, ended_at: _dt.datetime | None = None,
           source: str | None = None, error: str | None = None, counts: dict | None = None) -> None:
    if status not in STATUSES:
        raise ValueError(f"Unknown status: {status}")
    c = counts or {}
    row = [(table, run_id, stage, status, started_at, ended_at, source, error,
            c.get("n_in"), c.get("n_valid"), c.get("n_error"), c.get("n_rejected_files"),
            c.get("n_rejected_rows"), sorted(c["errors_by_rule"].items()) if c.get("errors_by_rule") is not None else None, time.time_ns())]
    spark.createDataFrame(row, LEDGER_SCHEMA).write.mode("append").parquet(ledger_path)


def latest(ledger: DataFrame, keys=("table_name", "run_id"), time_col: str = "ended_at",
           start_col: str = "started_at", tie: str = "seq") -> DataFrame:
    """Latest event per key: ``max(struct(time, tie, row))`` grouped by key.

    An event's time is its end or, while it is open, its start; events of one
    time follow ``tie``.  An aggregate (map-side combined) rather than a
    ranking window, so one run with very many events never lands whole in one
    task.
    """
    keys = list(keys)
    rest = [c for c in ledger.columns if c not in keys]
    order = [F.coalesce(*[F.col(c) for c in (time_col, start_col) if c in ledger.columns])]
    if tie in ledger.columns:
        order.append(F.col(tie))
    best = F.max(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)],
                          F.struct(*rest).alias("_row"))).alias("_best")
    return (ledger.groupBy(*keys).agg(best, F.count(F.lit(1)).alias("n_events"))
            .select(*keys, "_best._row.*", "n_events"))
