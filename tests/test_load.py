"""Load strategies on plain Parquet, constraints and defaults."""

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from rampart import TableContract
from rampart.errors import LoadError
from rampart.operators import keysets
from rampart.operators import load as L
from rampart.operators import store
from rampart.operators.constraints import apply_defaults, constraint_check
from rampart.operators.routing import error_message

C = TableContract.from_dict({
    "table_name": "customers", "columns": [
        {"name": "customer_id", "type": "int", "db_type": "INTEGER", "primary_key": True},
        {"name": "name", "type": "string", "db_type": "VARCHAR", "max_length": 100, "not_null": True}],
    "load_database": {"load_strategy": "upsert", "primary_key": "customer_id"}})


def rows(spark, root):
    return sorted(map(tuple, L.read_target(spark, root, C).collect()))


def df(spark, data):
    return spark.createDataFrame(data, "customer_id long, name string")


def test_create_and_missing(spark, tmp_dir):
    with pytest.raises(LoadError, match=r"There is no table \(customers\)"):
        L.upsert(spark, df(spark, [(1, "John")]), C, f"{tmp_dir}/t")
    assert L.create_target(spark, C, f"{tmp_dir}/t") is True
    assert L.create_target(spark, C, f"{tmp_dir}/t") is False
    out = L.read_target(spark, f"{tmp_dir}/t", C)
    assert out.count() == 0 and out.columns == ["customer_id", "name"]


def test_append(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    L.create_target(spark, C, root)
    L.append(spark, df(spark, [(1, "John"), (2, "Mary")]), C, root)
    with pytest.raises(LoadError, match="duplicate key"):
        L.append(spark, df(spark, [(2, "Other")]), C, root)
    with pytest.raises(LoadError, match=r"unique', 'customer_id', 2"):
        L.append(spark, df(spark, [(3, "A"), (3, "B")]), C, root)
    L.append(spark, df(spark, [(2, "Other"), (3, "Ann")]), C, root, on_conflict="ignore")
    assert rows(spark, root) == [(1, "John"), (2, "Mary"), (3, "Ann")]


def test_replace(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    L.create_target(spark, C, root)
    L.append(spark, df(spark, [(1, "John"), (2, "Mary")]), C, root)
    L.replace(spark, df(spark, [(5, "Eve")]), C, root)
    assert rows(spark, root) == [(5, "Eve")]


def test_upsert(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    L.create_target(spark, C, root)
    L.append(spark, df(spark, [(1, "John"), (2, "Mary")]), C, root)
    L.upsert(spark, df(spark, [(2, "Mary B"), (3, "Ann")]), C, root)
    assert rows(spark, root) == [(1, "John"), (2, "Mary B"), (3, "Ann")]
    with pytest.raises(LoadError, match="unique"):
        L.upsert(spark, df(spark, [(4, "A"), (4, "B")]), C, root)
    with pytest.raises(LoadError, match="repeat a key"):
        L.upsert(spark, df(spark, [(4, "A"), (4, "B")]), C, root, check=False)
    assert rows(spark, root) == [(1, "John"), (2, "Mary B"), (3, "Ann")]


def test_failed_load_leaves_previous_version(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    L.create_target(spark, C, root)
    L.append(spark, df(spark, [(1, "John")]), C, root)
    with pytest.raises(LoadError, match="Constraint violation"):
        L.upsert(spark, df(spark, [(2, None)]), C, root)
    assert rows(spark, root) == [(1, "John")]


def test_dispatch(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    L.create_target(spark, C, root)
    L.load(spark, df(spark, [(1, "John")]), C, root)
    L.load(spark, df(spark, [(1, "Jon")]), C, root)
    assert rows(spark, root) == [(1, "Jon")]
    L.load(spark, df(spark, [(9, "Z")]), C, root, strategy="truncate_and_insert")
    assert rows(spark, root) == [(9, "Z")]
    with pytest.raises(LoadError, match="Unknown load strategy"):
        L.load(spark, df(spark, [(1, "x")]), C, root, strategy="merge")


def test_constraint_check(spark):
    c = TableContract.from_dict({"table_name": "t", "columns": [
        {"name": "k", "type": "int", "primary_key": True},
        {"name": "s", "type": "string", "db_type": "VARCHAR", "max_length": 3},
        {"name": "v", "type": "double", "db_type": "NUMERIC", "precision": 5, "scale": 2,
         "range": [0, 500]}]})
    d = spark.createDataFrame([(0, 1, "abc", 1.5), (1, 1, "abcd", 999.0), (2, None, None, 1234.5)],
                              "_source_index long, k long, s string, v double")
    out = {r["_source_index"]: r["error_message"] for r in error_message(constraint_check(d, c)).collect()}
    assert out[0] == "unique(k)"
    assert out[1] == "max_length(s); check(v); unique(k)"
    assert out[2] == "not_null(k); check(v); numeric(v)"


def test_defaults_only_for_absent_columns(spark):
    c = TableContract.from_dict({"table_name": "t", "columns": [
        {"name": "k", "type": "int"}, {"name": "a", "type": "string", "default": "x"},
        {"name": "b", "type": "string", "default": "y"}]})
    d = spark.createDataFrame([(1, None)], "k long, a string")
    r = apply_defaults(d, c).first()
    assert r["a"] is None and r["b"] == "y"


def _files(root):
    """Data files of the current version."""
    version = json.load(open(f"{root}/_current.json"))
    return {f for name, d in version["folders"].items() for n in d["segments"] for f in glob.glob(f"{root}/{name}/_segment={n}/*.parquet")}


@pytest.fixture
def segmented(spark, tmp_dir, monkeypatch):
    """A table of 2000 rows in 20 segments of a file each, composite and unsorted."""
    monkeypatch.setattr(store, "SEGMENT_BYTES", 1)
    monkeypatch.setattr(store, "MAX_SEGMENTS", 20)
    root = f"{tmp_dir}/t"
    L.create_target(spark, C, root)
    L.append(spark, df(spark, [((i * 7) % 2000, f"a{i * 7 % 2000}") for i in range(2000)]).repartition(5), C, root)
    assert len(_files(root)) == 20
    return root


def test_a_narrow_upsert_rewrites_few_files(spark, segmented):
    before = _files(segmented)
    L.upsert(spark, df(spark, [(i, f"new{i}") for i in range(640, 660)] + [(5000, "last")]), C, segmented)
    after = _files(segmented)
    assert len(before - after) <= 2 + 1  # the range, and the last segment for the new key
    got = dict(L.read_target(spark, segmented, C).collect())
    assert len(got) == 2001 and got[650] == "new650" and got[5000] == "last" and got[5] == "a5" and got[700] == "a700"
    before = after
    L.upsert(spark, df(spark, [(3, "b")]), C, segmented)
    assert len(before - _files(segmented)) == 1
    L.append(spark, df(spark, [(-5, "low"), (9000, "high")]), C, segmented)
    assert L.read_target(spark, segmented, C).count() == 2003
    L.recluster(spark, C, segmented)
    assert len(_files(segmented)) == 20 and L.read_target(spark, segmented, C).count() == 2003
    L.replace(spark, df(spark, [(1, "only")]), C, segmented)
    assert rows(spark, segmented) == [(1, "only")]


@pytest.mark.parametrize("kinds, keys", [
    ("k string, n long", [("b",), ("a",), ("a0",), ("z",), ("",), ("é",), ("aa",)]),
    ("k double, n long", [(1.5,), (-2.0,), (1e300,), (0.0,), (3.0,), (-1e-9,), (2.5,)]),
    ("k date, n long", [(dt.date(2020, 1, d),) for d in (5, 1, 9, 30, 12, 7, 2)])])
def test_segments_of_other_key_types(spark, monkeypatch, kinds, keys):
    monkeypatch.setattr(store, "SEGMENT_BYTES", 1)
    monkeypatch.setattr(store, "MAX_SEGMENTS", 5)
    data = spark.createDataFrame([(*k, i) for i, k in enumerate(keys * 40)], kinds)
    bounds = store.choose_bounds(data, ["k", "n"])
    assert len(bounds) == 4
    got = data.select(F.concat_ws(",", "k", "n").alias("text"), store.segment_of(["k", "n"], bounds, data.schema).alias("s")).orderBy("k", "n").collect()
    segments = [r["s"] for r in got]
    assert segments == sorted(segments) and set(segments) == set(range(5))
    firsts = [next(r["text"] for r in got if r["s"] == s) for s in range(1, 5)]
    assert firsts == [",".join(b) for b in bounds]


UNIQUE = TableContract.from_dict({
    "table_name": "people", "columns": [
        {"name": "id", "type": "int", "primary_key": True},
        {"name": "mail", "type": "string", "unique": True},
        {"name": "badge", "type": "int", "unique": True},
        {"name": "name", "type": "string", "not_null": True}],
    "load_database": {"load_strategy": "upsert", "primary_key": "id"}})


def people(spark, data):
    return spark.createDataFrame(data, "id long, mail string, badge long, name string")


@pytest.fixture
def staff(spark, tmp_dir):
    root = f"{tmp_dir}/people"
    L.create_target(spark, UNIQUE, root)
    L.append(spark, people(spark, [(1, "a", 10, "x"), (2, "b", 20, "x"), (3, "c", None, "x"), (4, None, 40, "x"), (5, None, 50, "x")]), UNIQUE, root)
    return root


def stored(spark, root):
    return sorted(map(tuple, L.read_target(spark, root, UNIQUE).select("id", "mail", "badge").collect()))


START = [(1, "a", 10), (2, "b", 20), (3, "c", None), (4, None, 40), (5, None, 50)]


@pytest.mark.parametrize("strategy", ["append_only", "upsert"])
def test_taken_unique_values_raise(spark, staff, strategy):
    for row, columns in (((6, "a", None, "x"), "mail"), ((6, "new", 40, "x"), "badge")):
        with pytest.raises(LoadError, match=rf"duplicate key value violates unique constraint on \[\['{columns}'\]\]"):
            L.load(spark, people(spark, [row, (7, "h", 70, "x")]), UNIQUE, staff, strategy)
    assert stored(spark, staff) == START
    L.load(spark, people(spark, [(6, None, None, "x"), (7, "h", 70, "x")]), UNIQUE, staff, strategy)  # NULLs are no value
    assert stored(spark, staff) == START + [(6, None, None), (7, "h", 70)]


def test_taken_unique_values_become_rejects(spark, staff, tmp_dir):
    rejects = f"{tmp_dir}/rejects"
    L.append(spark, people(spark, [(6, "a", 20, "x"), (7, "g", 70, "x"), (2, "q", 80, "x"), (8, "h", 50, None)]), UNIQUE, staff, rejects=rejects)
    assert stored(spark, staff) == START + [(7, "g", 70)]
    assert sorted((r["id"], r["error_message"]) for r in spark.read.parquet(rejects).collect()) == [
        (2, "unique(id)"), (6, "unique(mail); unique(badge)"), (8, "not_null(name)")]


def test_replaced_rows_free_their_values(spark, staff, tmp_dir):
    L.upsert(spark, people(spark, [(1, "b", 20, "x"), (2, "a", 10, "x")]), UNIQUE, staff)  # swapped
    L.upsert(spark, people(spark, [(3, "z", 30, "x"), (6, "c", None, "x")]), UNIQUE, staff)
    assert stored(spark, staff) == [(1, "b", 20), (2, "a", 10), (3, "z", 30), (4, None, 40), (5, None, 50), (6, "c", None)]
    rejects = f"{tmp_dir}/rejects"
    # 2 is refused and keeps 'a', which refuses 1, which keeps 'b', which refuses 5; 4 loads
    L.upsert(spark, people(spark, [(2, "q", 99, None), (1, "a", 11, "x"), (5, "b", 51, "x"), (4, "d", 41, "x")]), UNIQUE, staff, rejects=rejects)
    assert stored(spark, staff) == [(1, "b", 20), (2, "a", 10), (3, "z", 30), (4, "d", 41), (5, None, 50), (6, "c", None)]
    assert sorted((r["id"], r["error_message"]) for r in spark.read.parquet(rejects).collect()) == [(1, "unique(mail)"), (2, "not_null(name)"), (5, "unique(mail)")]


def test_primary_key_of_the_table_under_another_load_key(spark, staff):
    """Loaded by mail, ids must stay unique in the table."""
    with pytest.raises(LoadError, match=r"on \[\['id'\]\]"):
        L.upsert(spark, people(spark, [(2, "a", 10, "x")]), UNIQUE, staff, keys="mail")
    L.upsert(spark, people(spark, [(9, "a", 90, "x")]), UNIQUE, staff, keys="mail")
    assert stored(spark, staff) == sorted([(9, "a", 90)] + START[1:])
    with pytest.raises(LoadError, match=r"on \[\['id'\]\]"):
        L.append(spark, people(spark, [(3, "new", None, "x")]), UNIQUE, staff, keys="mail")


def test_ignored_rows_ask_for_nothing(spark, staff):
    L.append(spark, people(spark, [(1, "b", 20, "x"), (1, "b", 20, "x"), (8, "h", 80, "x")]), UNIQUE, staff, on_conflict="ignore")
    assert stored(spark, staff) == START + [(8, "h", 80)]
    with pytest.raises(LoadError, match="mail"):
        L.append(spark, people(spark, [(1, "y", 1, "x"), (9, "b", 90, "x")]), UNIQUE, staff, on_conflict="ignore")


def test_colliding_digests_refuse_nothing(spark, staff, monkeypatch):
    monkeypatch.setattr(keysets, "digest", lambda columns: [F.lit(1).cast("long").alias("_h1"), F.lit(2).cast("long").alias("_h2")])
    L.append(spark, people(spark, [(6, "f", 60, "x"), (7, "g", 70, "x")]), UNIQUE, staff)
    with pytest.raises(LoadError, match=r"on \[\['mail'\]\]"):
        L.append(spark, people(spark, [(8, "f", 80, "x")]), UNIQUE, staff)
    assert stored(spark, staff) == START + [(6, "f", 60), (7, "g", 70)]


def test_bloom_filter_leaves_hits_and_few_others(spark):
    keys = [("k",)]
    stored_keys = keysets.exploded(spark.range(200_000).select(F.col("id").alias("k")), keys)
    incoming = keysets.exploded(spark.range(5_000).select((F.col("id") * 37 + 100).alias("k")), keys)  # spread over the range
    hits = {r[0] for r in stored_keys.join(incoming, ["_set", "_h1", "_h2"], "left_semi").select("_h1").collect()}
    left = {r[0] for r in keysets.bloom(stored_keys, incoming, 5_000).select("_h1").collect()}
    assert len(hits) == 5_000 and hits <= left
    assert len(left) - len(hits) < 0.03 * 195_000


def test_probe_by_shuffle_gives_the_same(spark, staff):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = keysets.probe(people(spark, [(6, "a", 20, "x"), (7, "q", 50, "x")]), L.read_target(spark, staff, UNIQUE), [("mail",), ("badge",), ("id",)])
        assert {k: sorted(r[0] for r in v.collect()) for k, v in got.items()} == {("mail",): ["a"], ("badge",): [20, 50]}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_target_outlives_a_change_of_its_contract(spark, tmp_dir):
    def contract(*columns):
        return TableContract.from_dict({"table_name": "t", "columns": [{"name": "k", "type": "int", "primary_key": True}, *columns]})

    old = contract({"name": "v", "type": "int"}, {"name": "gone", "type": "string"})
    new = contract({"name": "v", "type": "double"}, {"name": "w", "type": "string"})
    root = f"{tmp_dir}/t"
    L.create_target(spark, old, root)
    L.append(spark, spark.createDataFrame([(1, 7, "x"), (2, None, "y")], "k long, v long, gone string"), old, root)
    L.append(spark, spark.createDataFrame([(3, 1.5, "z")], "k long, v double, w string"), new, root)
    assert sorted(map(tuple, L.read_target(spark, root, new).collect())) == [(1, 7.0, None), (2, None, None), (3, 1.5, "z")]
    L.upsert(spark, spark.createDataFrame([(1, 2.5, "u")], "k long, v double, w string"), new, root)
    assert sorted(map(tuple, L.read_target(spark, root, new).collect())) == [(1, 2.5, "u"), (2, None, None), (3, 1.5, "z")]
