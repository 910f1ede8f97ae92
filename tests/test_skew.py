"""Hot keys and NULL keys: results equal a brute-force pandas check on both
the broadcast path and the shuffle path (AQE skew-join splitting on)."""

import pandas as pd
import pytest

from rampart import RuleSpec, validate
from rampart.operators.routing import error_message

N = 30000


def _data(spark):
    # key: a third of all rows share 'HOT', a sixth are NULL, the rest repeat in pairs
    def key(i):
        if i % 3 == 0:
            return "HOT"
        if i % 6 == 1:
            return None
        return f"k{i // 4}"
    rows = [(i, key(i), f"v{i % 5}") for i in range(N)]
    return spark.createDataFrame(rows, "_source_index long, k string, v string").repartition(8)


def _expected(rows: pd.DataFrame) -> dict:
    df = rows.sort_values("_source_index")
    unique_bad = df["k"].map(df["k"].value_counts()).fillna(0) > 1
    dup_bad = df.duplicated(subset=["k"], keep="first")  # NULL equals NULL
    whole_bad = df.duplicated(subset=["k", "v"], keep="first")
    out = {}
    for idx, w, u, d in zip(df["_source_index"], whole_bad, unique_bad, dup_bad):
        msgs = (["duplicate(k,v)"] if w else []) + (["unique(k)"] if u else []) + (["duplicate(k)"] if d else [])
        out[idx] = "; ".join(msgs) or None
    return out


@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
def test_hot_and_null_keys(spark, path):
    if path == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        df = _data(spark)
        rules = [RuleSpec("unique", ("k",)), RuleSpec("duplicate", ("k",))]
        checked = validate(df, None, rules=rules, check_datatypes=False)
        got = {r["_source_index"]: r["error_message"] for r in error_message(checked).collect()}
        plan = checked._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                  "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                  "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(k)
    assert got == _expected(df.toPandas())
    if path == "shuffle":
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    else:
        assert "SortMergeJoin" not in plan


def test_key_table_goes_through_shared_folder(spark):
    df = _data(spark)
    rules = [RuleSpec("duplicate", ("k",))]
    checked = validate(df, None, rules=rules, whole_row_duplicate=False, check_datatypes=False)
    assert "key-stats-" in checked._jdf.queryExecution().executedPlan().toString()
    got = {r["_source_index"]: r["error_message"] for r in error_message(checked).collect()}
    pdf = df.toPandas().sort_values("_source_index")
    dup = pdf.duplicated(subset=["k"], keep="first")
    assert got == {i: ("duplicate(k)" if d else None) for i, d in zip(pdf["_source_index"], dup)}
