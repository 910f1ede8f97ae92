"""Inputs that once gave wrong results: many splits, shuffled inputs, composite keys, odd names."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rampart import RuleSpec, TableContract, check_rules
from rampart.contract import load_contract
from rampart.errors import LoadError
from rampart.operators import load as L
from rampart.operators import store
from rampart.plans import ledger
from rampart.plans.pipeline import l0_to_l1, l1_to_target, rcv_to_l0
from rampart.session import shared_dir
from rampart.sources.files import dense_index, prefix_offsets, read_table, write_table

SEATS = TableContract.from_dict({"table_name": "seats", "columns": [
    {"name": "row_no", "type": "int", "primary_key": True}, {"name": "seat", "type": "string", "primary_key": True},
    {"name": "guest", "type": "string", "not_null": True}],
    "load_database": {"load_strategy": "upsert", "primary_key": ["row_no", "seat"]}})


def seats(spark, data):
    return spark.createDataFrame(data, "row_no long, seat string, guest string")


def test_offsets_of_many_units(spark):
    n = 400_000
    units = spark.range(n).select(F.format_string("f%03d", (F.col("id") % 997).cast("int")).alias("_source_file"),
                                  F.col("id").alias("_blk"), ((F.col("id") * 37) % 11 + 1).alias("_cnt"), (F.col("id") * 3).alias("_mid0"))
    got = prefix_offsets(units.repartition(7), ["_source_file", "_blk"], "_cnt", n_hint=600_000)
    pdf = got.select("_source_file", "_blk", "_cnt", "_off").toPandas().sort_values(["_source_file", "_blk"])
    assert len(pdf) == n
    assert ((pdf["_cnt"].cumsum() - pdf["_cnt"]).to_numpy() == pdf["_off"].to_numpy()).all()


def test_dense_index_of_many_splits(spark):
    marked = spark.range(300_000).select("id", (F.col("id") % 100_000).cast("string").alias("_source_file"),
                                         F.lit(0).alias("_blk"), (F.col("id") / 100_000).cast("long").alias("_mid"))
    for hint in (None, 600_000):
        assert dense_index(marked, ["id"], n_hint=hint).agg(F.countDistinct("_source_index"), F.max("_source_index")).first()[:] == (300_000, 299_999)


def test_keep_first_without_an_index(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        df = spark.range(200_000).select((F.col("id") % 20_000).alias("k"), F.col("id").alias("v")).repartition("v")
        out = check_rules(df, [RuleSpec("duplicate", ("k",))])
        kept = out.where(F.size("_errors") == 0)
        assert kept.count() == kept.select("k").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.mark.parametrize("check", [True, False])
@pytest.mark.parametrize("strategy", ["append_only", "upsert"])
def test_composite_key_repeats_are_refused(spark, tmp_dir, strategy, check):
    root = f"{tmp_dir}/t"
    L.create_target(spark, SEATS, root)
    with pytest.raises(LoadError, match="repeat a key"):
        L.load(spark, seats(spark, [(1, "A", "x"), (1, "A", "y"), (1, "B", "z")]), SEATS, root, strategy, check=check)
    L.load(spark, seats(spark, [(1, "A", "x"), (1, "B", "z"), (2, "A", "q")]), SEATS, root, strategy, check=check)
    assert L.read_target(spark, root, SEATS).count() == 3


def test_ignore_keeps_the_constraints(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    L.create_target(spark, SEATS, root)
    L.append(spark, seats(spark, [(1, "A", "x")]), SEATS, root)
    with pytest.raises(LoadError, match="not_null"):
        L.append(spark, seats(spark, [(2, "A", None)]), SEATS, root, on_conflict="ignore")
    with pytest.raises(LoadError, match="repeat a key"):
        L.append(spark, seats(spark, [(5, "A", "x"), (5, "A", "y")]), SEATS, root, on_conflict="ignore")
    L.append(spark, seats(spark, [(1, "A", "later"), (2, "A", "new")]), SEATS, root, on_conflict="ignore")
    assert sorted(map(tuple, L.read_target(spark, root, SEATS).collect())) == [(1, "A", "x"), (2, "A", "new")]


def test_breakers_become_rows(spark, tmp_dir):
    root, rejects = f"{tmp_dir}/t", f"{tmp_dir}/rejects"
    L.create_target(spark, SEATS, root)
    L.upsert(spark, seats(spark, [(1, "A", "x"), (2, "A", None), (3, "A", "p"), (3, "A", "q")]), SEATS, root, rejects=rejects)
    assert [tuple(r) for r in L.read_target(spark, root, SEATS).collect()] == [(1, "A", "x")]
    got = spark.read.parquet(rejects)
    assert sorted(r["error_message"] for r in got.collect()) == ["not_null(guest)", "unique(row_no,seat)", "unique(row_no,seat)"]


def test_failed_loads_leave_the_old_version(spark, tmp_dir):
    root = f"{tmp_dir}/a table"
    L.create_target(spark, SEATS, root)
    L.append(spark, seats(spark, [(1, "A", "x")]), SEATS, root)
    stale = store.current(spark, root)
    store.write(spark, seats(spark, [(9, "Z", "lost")]), root, stale)  # a load that ended before it was published
    with open(f"{root}/._current.json.1", "w") as fh:
        fh.write('{"number": 9')
    assert L.read_target(spark, root, SEATS).count() == 1
    L.upsert(spark, seats(spark, [(1, "A", "y"), (2, "A", "z")]), SEATS, root)
    assert sorted(map(tuple, L.read_target(spark, root, SEATS).collect())) == [(1, "A", "y"), (2, "A", "z")]
    stale.number += 1
    with pytest.raises(LoadError, match="came first"):
        store.publish(spark, root, stale)
    assert len(store.delete_unused(spark, root)) == 2  # the lost load and the replaced row
    assert sorted(map(tuple, L.read_target(spark, root, SEATS).collect())) == [(1, "A", "y"), (2, "A", "z")]


def _contracts():
    base = {"schema_name": "shop", "rcv_layer": "rcv", "l0_layer": "l0", "l1_layer": "l1", "audit_layer": "audit",
            "quarantine_layer": "quarantine", "rcv_format": "csv", "l0_format": "csv", "l1_format": "parquet", "audit_format": "parquet"}
    cols = [{"name": "code", "type": "string"}, {"name": "title", "type": "string"}]
    rcv = {**base, "table_name": "books", "columns": cols, "validation": {"validate_file": True, "validate_schema": True}}
    l0 = {**base, "table_name": "books", "columns": cols, "validation": [{"rule": "not_null", "column": "title"}]}
    l1 = {**base, "table_name": "books", "columns": [{"name": "code", "type": "string", "primary_key": True}, {"name": "title", "type": "string"}],
          "load_database": {"load_strategy": "append_only", "primary_key": "code"}}
    return [TableContract.from_dict(x) for x in (rcv, l0, l1)]


def _scratch_files(spark):
    top = shared_dir(spark).removeprefix("file:") + "/rampart"
    return {d for d in os.listdir(top)} if os.path.isdir(top) else set()


def test_names_with_blanks_nested_folders_and_clean_scratch(spark, tmp_dir):
    rcv, l0, l1 = _contracts()
    base = f"{tmp_dir}/the lake"
    land = f"{base}/rcv/shop/books/2026/01/01/books.csv"
    for name, body in (("a b/part.csv", 'code,title\nk1,"say ""hi"""\nk2,100%\n'), ("c+d/part.csv", "code,title\nk3,x\n"),
                       ("bad 1/part.csv", "code\nk9\n"), ("bad 2/part.csv", "title,code\nt,k8\n")):
        os.makedirs(os.path.dirname(f"{land}/{name}"), exist_ok=True)
        with open(f"{land}/{name}", "w") as fh:
            fh.write(body)
    before = _scratch_files(spark)
    res = rcv_to_l0(spark, rcv, l0, base, dt.date(2026, 1, 1), dt.datetime(2026, 1, 1), on_reject="skip")
    assert res.n_rejected_files == 2
    quarantine = f"{base}/quarantine/shop/books/2026/01/01/books.csv"
    assert sorted(os.path.relpath(os.path.join(d, f), quarantine) for d, _, fs in os.walk(quarantine) for f in fs if f.endswith(".csv")) \
        == ["bad 1/part.csv", "bad 2/part.csv"]
    l0_to_l1(spark, l0, l1, base, dt.date(2026, 1, 1))
    l1_to_target(spark, l1, base, dt.date(2026, 1, 1), f"{base}/serving")
    got = {r["code"]: r["title"] for r in L.read_target(spark, f"{base}/serving", l1).collect()}
    assert got == {"k1": 'say "hi"', "k2": "100%", "k3": "x"}
    assert _scratch_files(spark) == before


def test_quotes_survive_a_csv_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("1", 'a "b", c'), ("2", '"')], "id string, name string")
    write_table(df, f"{tmp_dir}/q", "csv")
    c = TableContract.from_dict({"table_name": "q", "columns": [{"name": "id", "type": "string"}, {"name": "name", "type": "string"}]})
    assert sorted(map(tuple, read_table(spark, f"{tmp_dir}/q", "csv", contract=c).collect())) == [("1", 'a "b", c'), ("2", '"')]


def test_ledger_shows_the_open_stage(spark, tmp_dir):
    t = dt.datetime(2026, 1, 1)
    for k, (stage, status, end) in enumerate([("one", "RUNNING", None), ("one", "SUCCESS", t + dt.timedelta(seconds=5)), ("two", "RUNNING", None)]):
        ledger.record(spark, f"{tmp_dir}/l", "books", "r", stage, status, t + dt.timedelta(seconds=5 * (k > 1)), end)
    got = ledger.latest(spark.read.parquet(f"{tmp_dir}/l")).first()
    assert (got["stage"], got["status"], got["n_events"]) == ("two", "RUNNING", 3)


def test_contract_on_a_hadoop_file_system(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/c/l0")
    with open(f"{tmp_dir}/c/l0/books.yaml", "w") as fh:
        fh.write("table_name: books\ncolumns:\n  - {name: code, type: string}\n")
    assert load_contract(f"file://{tmp_dir}/c", "l0", "books").column_names == ["code"]
    with pytest.raises(Exception, match="No contract"):
        load_contract(f"file://{tmp_dir}/c", "l0", "films")
