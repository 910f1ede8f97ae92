"""Layer-to-layer jobs: rcv -> l0 -> l1 -> serving table, one (table, date) each.

Each stage is a composition of the operators: gates -> scan -> lineage ->
alignment -> sink; scan -> validate -> split -> reshape -> two sinks; scan ->
constraints -> load strategy.  ``run_stage`` re-raises any failure as
``FAILED_AT_[stage]: reason``.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import TableContract, load_contract
from ..errors import StageError, ValidationError
from ..operators import load as L
from ..operators.reshape import align, apply_transforms, reshape
from ..operators.routing import split
from ..operators.validate import RuleCounts, validate
from ..session import hadoop_fs, plain_path, scratch_scope, staged
from ..sources.files import layer_path, read_table, write_table
from ..sources.gates import copy_all_to_quarantine, judge_files

CONFIG_ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "config")

# Fixed value: so much of a rejected file's reason is put into the error.
REASON_CHARS = 2_000


@dataclass
class StageResult:
    stage: str
    table: str
    output: str | None = None
    n_in: int | None = None
    n_valid: int | None = None
    n_error: int | None = None
    n_rejected_files: int | None = None
    n_rejected_rows: int | None = None
    errors_by_rule: dict[str, int] | None = None


def rcv_to_l0(spark: SparkSession, rcv: TableContract, l0: TableContract, base: str,
              process_date, run_ts: _dt.datetime, *, on_reject: str = "raise",
              raw_l0: bool = False) -> StageResult:
    """Gate the landing file(s), then lineage + alignment to the L0 contract.

    Rejected files are copied to the quarantine path, mirroring their place
    below the landing path; with ``on_reject="raise"`` (one file per table
    and date) the stage then fails with the gate's message, with ``"skip"``
    the accepted files still load and the result counts the rejected ones.
    By default L0 values are converted to the declared types (an
    unconvertible value becomes NULL and is later reported by ``not_null``);
    ``raw_l0=True`` keeps the landing text so the audit shows the bad value
    under ``datatype``.
    """
    src = layer_path(base, rcv, "rcv", process_date)
    verdicts = judge_files(spark, [src], rcv).cache()
    try:
        # one short row per landing file; a reason holds the file's first line
        rows = verdicts.select("file_path", "status", "quarantine").collect()
        rejected = [r for r in rows if r["status"] != "accepted"]
        accepted = [r["file_path"] for r in rows if r["status"] == "accepted"]
        if rejected and (on_reject == "raise" or not accepted):
            first = verdicts.where(F.col("file_path") == rejected[0]["file_path"])
            why = first.select(F.substring("reason", 1, REASON_CHARS)).first()[0]
    finally:
        verdicts.unpersist()
    qdir = layer_path(base, rcv, "quarantine", process_date,
                      dict(rcv.formats).get("quarantine", rcv.format("rcv")))
    fs, p = hadoop_fs(spark, src)
    below = plain_path(str(fs.makeQualified(p))) + "/" if rejected and fs.exists(p) and fs.getFileStatus(p).isDirectory() else None
    copy_all_to_quarantine(spark, [(r["file_path"], qdir if below is None else f"{qdir}/{r['file_path'][len(below):]}") for r in rejected if r["quarantine"]])
    if rejected and (on_reject == "raise" or not accepted):
        raise ValidationError(why)
    # Only the file path is needed here (lineage); positions are taken at L0.
    df = read_table(spark, accepted, rcv.format("rcv"), contract=rcv,
                    multiline=bool(rcv.raw.get("multiline", False)), source_file=True)
    target = l0
    if raw_l0:
        target = TableContract.from_dict({**l0.raw, "columns": [
            {"name": c.name, "type": "string"} if c.name in rcv.column_names else
            {"name": c.name, "type": c.type, **({"format": c.format} if c.format else {})}
            for c in l0.columns]})
    out = align(apply_transforms(df, rcv, run_ts=run_ts, source_file=src), target)
    dst = layer_path(base, l0, "l0", process_date, rcv.format("l0"))
    write_table(out, dst, rcv.format("l0"))
    return StageResult("rcv_to_l0", rcv.table_name, dst, n_rejected_files=len(rejected))


def l0_to_l1(spark: SparkSession, l0: TableContract, l1: TableContract, base: str,
             process_date, *, order_by: list[str] | None = None) -> StageResult:
    """Validate L0 against every rule, write valid rows reshaped to L1 and the
    audit rows (always, so a clean rerun replaces an older audit).

    The L0 rows are parsed once, into a Parquet copy in the shared folder (the index
    needs it), of which the key rules read only their key columns; the checked table is
    written once, too, which both sinks read.
    Counts of rows and of violations by rule come with that write.  Both copies are
    deleted when the stage ends.
    """
    src = layer_path(base, l0, "l0", process_date, l0.format("l0"))
    with scratch_scope():
        df = read_table(spark, src, l0.format("l0"), contract=l0, index=True,
                        flag_malformed=l0.format("l0") == "csv",
                        multiline=bool(l0.raw.get("multiline", False)))
        found = RuleCounts()
        checked = validate(df, l0, order_by=order_by, counts=found)
        valid, audit = split(staged(checked, f"checked-{l0.table_name}"))
        dst = layer_path(base, l1, "l1", process_date, l0.format("l1"))
        write_table(reshape(valid, l0, l1), dst, l0.format("l1"))
        write_table(audit, layer_path(base, l0, "audit", process_date, l0.format("audit")),
                    l0.format("audit"))
    return StageResult("l0_to_l1", l0.table_name, dst, **found.totals, errors_by_rule=found.by_rule)


def l1_to_target(spark: SparkSession, l1: TableContract, base: str, process_date,
                 target_root: str) -> StageResult:
    """Create the serving table if absent, then apply the contract's strategy.

    Rows that break a constraint of the serving table go to the audit path of
    the L1 layer with their reasons; the others load."""
    src = layer_path(base, l1, "l1", process_date, l1.format("l1"))
    df = read_table(spark, src, l1.format("l1"))
    rejects = layer_path(base, l1, "audit", process_date, "parquet") + ".load"
    L.create_target(spark, l1, target_root)
    L.load(spark, df, l1, target_root, rejects=rejects)
    refused = spark.read.parquet(rejects).count()
    return StageResult("l1_to_database", l1.table_name, target_root, n_rejected_rows=refused)


def run_stage(stage: str, fn, *args, **kw):
    """Run one stage; any failure becomes ``FAILED_AT_[stage]: reason``."""
    try:
        return fn(*args, **kw)
    except Exception as exc:  # re-raised with the stage name, cause chained
        raise StageError(stage, exc) from exc


def run_table(spark: SparkSession, table: str, base: str, process_date, target_root: str, *,
              run_ts: _dt.datetime, config_root: str = CONFIG_ROOT,
              on_reject: str = "raise", ledger_path: str | None = None,
              run_id: str | None = None) -> list[StageResult]:
    """Full chain rcv -> l0 -> l1 -> serving table for one table and date.

    With ``ledger_path`` each stage appends RUNNING, then SUCCESS (with its
    record counts) or FAILED (with the stage error) to the run ledger.
    """
    from . import ledger

    rcv = load_contract(config_root, "rcv", table)
    l0 = load_contract(config_root, "l0", table)
    l1 = load_contract(config_root, "l1", table)
    run_id = run_id or f"{table}-{run_ts:%Y%m%dT%H%M%S}"
    stages = [
        ("rcv_to_l0", rcv_to_l0, (spark, rcv, l0, base, process_date, run_ts), {"on_reject": on_reject}),
        ("l0_to_l1", l0_to_l1, (spark, l0, l1, base, process_date), {}),
        ("l1_to_database", l1_to_target, (spark, l1, base, process_date, target_root), {}),
    ]
    out = []
    for name, fn, args, kw in stages:
        started = _dt.datetime.now()
        if ledger_path:
            ledger.record(spark, ledger_path, table, run_id, name, "RUNNING", started, source=base)
        try:
            res = run_stage(name, fn, *args, **kw)
        except StageError as exc:
            if ledger_path:
                ledger.record(spark, ledger_path, table, run_id, name, "FAILED", started,
                              _dt.datetime.now(), source=base, error=str(exc))
            raise
        if ledger_path:
            ledger.record(spark, ledger_path, table, run_id, name, "SUCCESS", started,
                          _dt.datetime.now(), source=base,
                          counts={k: getattr(res, k) for k in
                                  ("n_in", "n_valid", "n_error", "n_rejected_files", "n_rejected_rows", "errors_by_rule")})
        out.append(res)
    return out
