"""Contract lookup, extension registries and the run ledger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rampart import RuleSpec, TableContract, load_contract, validate
from rampart.errors import ContractError
from rampart.functions.rules import flag, register_rule
from rampart.operators.reshape import apply_transforms, register_transform
from rampart.operators.routing import error_message
from rampart.plans import ledger
from rampart.plans.pipeline import CONFIG_ROOT


def test_contract_lookup():
    c = load_contract(CONFIG_ROOT, "l1", "orders")
    assert c.load.strategy == "append_only" and c.load.primary_key == ("order_id",)
    assert c.column("price").precision == 15
    with pytest.raises(ContractError, match="No contract"):
        load_contract(CONFIG_ROOT, "l9", "orders")


def test_register_rule(spark):
    register_rule("positive", lambda schema, spec: flag(F.col(spec.columns[0]) <= 0, "positive", spec.columns[0]))
    c = TableContract.from_dict({"table_name": "t", "columns": [{"name": "q", "type": "int"}],
                                 "validation": [{"rule": "positive", "column": "q"}]})
    df = spark.createDataFrame([(0, 5), (1, -1)], "_source_index long, q long")
    out = {r["_source_index"]: r["error_message"] for r in error_message(
        validate(df, c, whole_row_duplicate=False)).collect()}
    assert out == {0: None, 1: "positive(q)"}


def test_register_transform(spark):
    register_transform("upper_names", lambda df, rules: df.withColumns(
        {r["column"]: F.upper(r["column"]) for r in rules}))
    c = TableContract.from_dict({"table_name": "t", "transformation": {
        "upper_names": [{"column": "name"}]}})
    df = spark.createDataFrame([("ann",)], "name string")
    assert apply_transforms(df, c).first()["name"] == "ANN"


def test_ledger_latest(spark, tmp_dir):
    path = f"{tmp_dir}/ledger"
    t0 = dt.datetime(2026, 1, 1, 1)
    ledger.record(spark, path, "customers", "r1", "rcv_to_l0", "RUNNING", t0)
    ledger.record(spark, path, "customers", "r1", "rcv_to_l0", "SUCCESS", t0, t0 + dt.timedelta(minutes=1))
    ledger.record(spark, path, "customers", "r1", "l0_to_l1", "FAILED", t0, t0 + dt.timedelta(minutes=3),
                  error="FAILED_AT_[l0_to_l1]: boom")
    ledger.record(spark, path, "orders", "r1", "rcv_to_l0", "SUCCESS", t0, t0 + dt.timedelta(minutes=2),
                  counts={"n_in": 10, "n_valid": 9, "n_error": 1})
    with pytest.raises(ValueError):
        ledger.record(spark, path, "orders", "r1", "x", "DONE", t0)
    rows = {r["table_name"]: r for r in ledger.latest(spark.read.parquet(path)).collect()}
    assert rows["customers"]["status"] == "FAILED" and rows["customers"]["stage"] == "l0_to_l1"
    assert rows["customers"]["n_events"] == 3
    assert rows["orders"]["status"] == "SUCCESS" and rows["orders"]["n_valid"] == 9
