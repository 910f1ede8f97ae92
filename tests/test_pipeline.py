"""End to end: landing files -> l0 -> l1 + audit -> serving table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rampart.errors import StageError
from rampart.operators import load as L
from rampart.operators.routing import error_summary
from rampart.operators.validate import validate
from rampart.plans import catalog, generate, ledger
from rampart.plans.pipeline import l0_to_l1, rcv_to_l0, run_stage, run_table
from rampart.sources.files import layer_path, read_table, write_table

SF = "/root/testdata/sf0.001"
DATE = dt.date(2026, 1, 1)
TS = dt.datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def lake(spark):
    import tempfile

    base = tempfile.mkdtemp(prefix="rampart-lake-")
    rcv, l0, l1 = catalog._c("rcv", "customers"), catalog._c("l0", "customers"), catalog._c("l1", "customers")
    g = generate.gen_customers(spark.read.parquet(f"{SF}/customer.parquet"),
                               spark.read.parquet(f"{SF}/nation.parquet")).drop("_key")
    write_table(g.coalesce(1), layer_path(base, rcv, "rcv", DATE, "csv"), "csv")
    results = run_table(spark, "customers", base, DATE, f"{base}/serving", run_ts=TS)
    return base, rcv, l0, l1, results


def test_counts_balance(lake):
    _, _, _, _, results = lake
    r = results[1]
    assert r.n_in == r.n_valid + r.n_error and r.n_error > 0 and r.n_valid > 0


def test_counts_by_rule_are_the_summary(spark, lake):
    """Counted with the write, and kept in the ledger."""
    base, _, l0, _, results = lake
    checked = validate(read_table(spark, layer_path(base, l0, "l0", DATE, "csv"), "csv", contract=l0, index=True, flag_malformed=True), l0)
    want = {f"{r['error_rule']}({r['error_column']})": r["n_rows"] for r in error_summary(checked).collect()}
    assert results[1].errors_by_rule == want and len(want) == 3
    path = f"{base}/ledger"
    ledger.record(spark, path, "customers", "r", "l0_to_l1", "SUCCESS", TS, TS, counts={"n_in": 1, "errors_by_rule": results[1].errors_by_rule})
    assert ledger.latest(spark.read.parquet(path)).first()["errors_by_rule"] == sorted(want.items())


def test_audit_rows_have_violations(spark, lake):
    base, _, l0, _, results = lake
    audit = read_table(spark, layer_path(base, l0, "audit", DATE, "parquet"), "parquet")
    assert audit.count() == results[1].n_error
    assert audit.where(F.col("error_message").isNull() | (F.col("error_message") == "")).count() == 0
    assert audit.columns[-5:] == ["_source_index", "error_type", "error_rule", "error_column", "error_message"]


def test_serving_key_unique_and_matches_l1(spark, lake):
    base, _, _, l1, results = lake
    t = L.read_target(spark, f"{base}/serving", l1)
    assert t.count() == results[1].n_valid
    assert t.groupBy("customer_id").count().where("count > 1").count() == 0


def test_rerun_is_identical(spark, lake):
    base, _, _, l1, _ = lake
    before = sorted(map(tuple, L.read_target(spark, f"{base}/serving", l1).collect()))
    run_table(spark, "customers", base, DATE, f"{base}/serving", run_ts=TS)
    after = sorted(map(tuple, L.read_target(spark, f"{base}/serving", l1).collect()))
    assert before == after


def test_shuffle_partitions_do_not_change_result(spark, lake):
    base, _, l0, l1, _ = lake
    out = []
    for n in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        r = l0_to_l1(spark, l0, l1, base, DATE)
        out.append((r.n_valid, r.n_error, sorted(map(tuple, read_table(
            spark, layer_path(base, l0, "audit", DATE, "parquet"), "parquet")
            .select("_source_index", "error_message").collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]


def test_missing_file_fails_with_stage(spark, lake):
    base, rcv, l0, _, _ = lake
    with pytest.raises(StageError, match=r"FAILED_AT_\[rcv_to_l0\]: File not found - "):
        run_stage("rcv_to_l0", rcv_to_l0, spark, rcv, l0, base, dt.date(2030, 1, 1), TS)


def test_bad_header_is_quarantined(spark, tmp_dir):
    rcv, l0 = catalog._c("rcv", "customers"), catalog._c("l0", "customers")
    src = layer_path(tmp_dir, rcv, "rcv", DATE, "csv")
    import os

    os.makedirs(os.path.dirname(src), exist_ok=True)
    with open(src, "w") as fh:
        fh.write("name,id\nx,1\n")
    with pytest.raises(StageError, match="Schema mismatch"):
        run_stage("rcv_to_l0", rcv_to_l0, spark, rcv, l0, tmp_dir, DATE, TS)
    q = layer_path(tmp_dir, rcv, "quarantine", DATE, "csv")
    assert open(q).read() == "name,id\nx,1\n"


def test_ledger_tracks_stages(spark, lake, tmp_dir):
    from rampart.plans import ledger

    base = lake[0]
    path = f"{tmp_dir}/ledger"
    run_table(spark, "customers", base, DATE, f"{base}/serving", run_ts=TS, ledger_path=path, run_id="r1")
    with pytest.raises(StageError):
        run_table(spark, "customers", base, dt.date(2031, 1, 1), f"{base}/serving", run_ts=TS,
                  ledger_path=path, run_id="r2")
    events = spark.read.parquet(path)
    assert events.where("run_id = 'r1' AND status = 'SUCCESS'").count() == 3
    latest = {r["run_id"]: r for r in ledger.latest(events).collect()}
    assert latest["r1"]["stage"] == "l1_to_database" and latest["r1"]["status"] == "SUCCESS"
    assert latest["r2"]["status"] == "FAILED" and "File not found" in latest["r2"]["error"]
    l0l1 = events.where("run_id = 'r1' AND stage = 'l0_to_l1' AND status = 'SUCCESS'").first()
    assert l0l1["n_in"] == l0l1["n_valid"] + l0l1["n_error"]


def test_raw_l0_reports_datatype(spark, tmp_dir):
    import os

    rcv, l0, l1 = catalog._c("rcv", "customers"), catalog._c("l0", "customers"), catalog._c("l1", "customers")
    src = layer_path(tmp_dir, rcv, "rcv", DATE, "csv")
    os.makedirs(os.path.dirname(src), exist_ok=True)
    with open(src, "w") as fh:
        fh.write("id,name,birthday,address,kpi\nC1,Ngo Huy,13-05-1990,\"1 A, Hanoi\",50\n"
                 "C2,Le An,1990-05-13,\"2 B, Hue\",abc\n")
    for raw, expected in ((False, {"not_null(birthday)", "not_null(kpi)"}),
                          (True, {"datatype(birthday)", "datatype(kpi)"})):
        rcv_to_l0(spark, rcv, l0, tmp_dir, DATE, TS, raw_l0=raw)
        l0_to_l1(spark, l0, l1, tmp_dir, DATE)
        audit = read_table(spark, layer_path(tmp_dir, l0, "audit", DATE, "parquet"), "parquet")
        assert {r["error_message"] for r in audit.collect()} == expected
