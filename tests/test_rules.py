"""Record rules: what passes, what fails, and how it is reported."""

import pytest
from pyspark.sql import functions as F

from rampart import RuleSpec, TableContract, check_rules, validate
from rampart.errors import ContractError
from rampart.functions.rules import KeyRule, register_key_rule
from rampart.operators import keysets
from rampart.operators import validate as validate_module
from rampart.operators.routing import error_message, split


def passes(df, rules, order="_row_id"):
    checked = check_rules(df, rules)
    rows = checked.orderBy("i").select("i", F.size("_errors").alias("n")).collect()
    return [r["n"] == 0 for r in rows]


def mk(spark, rows, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, " + schema).coalesce(1)


def test_not_null(spark):
    df = mk(spark, [(None,), ("x",), ("",), (None,)], "code string")
    assert passes(df, [RuleSpec("not_null", ("code",))]) == [False, True, True, False]


def test_unique(spark):
    df = mk(spark, [("red",), (None,), ("blue",), ("red",), (None,), ("red",)], "colour string")
    assert passes(df, [RuleSpec("unique", ("colour",))]) == [False, True, True, False, True, False]


def test_unique_composite(spark):
    df = mk(spark, [(3, "east"), (4, "east"), (3, "west"), (4, "east"), (3, "north")], "gate int, wing string")
    assert passes(df, [RuleSpec("unique", ("gate", "wing"))]) == [True, False, True, False, True]


def test_unique_composite_with_null(spark):
    df = mk(spark, [(None, "east"), (None, "east"), (5, None), (5, None), (5, "east"), (5, "east")], "gate int, wing string")
    assert passes(df, [RuleSpec("unique", ("gate", "wing"))]) == [True, True, True, True, False, False]


def test_duplicate_row_keeps_first(spark):
    df = mk(spark, [("oak", 9), ("elm", 2), ("oak", 9), ("oak", 8), ("oak", 9)], "tree string, age int")
    checked = validate(df.withColumnRenamed("i", "_source_index"), None, rules=[],
                       check_datatypes=False)
    got = [r["n"] for r in checked.orderBy("_source_index").select(F.size("_errors").alias("n")).collect()]
    assert got == [0, 0, 1, 0, 1]


def test_duplicate_pk(spark):
    df = mk(spark, [("oak", 9), ("oak", 8), ("elm", 2), ("elm", 2)], "tree string, age int")
    assert passes(df, [RuleSpec("duplicate", ("tree",))]) == [True, False, True, False]


def test_duplicate_null_keys_equal(spark):
    df = mk(spark, [("fir", 1), (None, 2), ("fir", 3), (None, 4), (None, 5)], "tree string, age int")
    assert passes(df, [RuleSpec("duplicate", ("tree",))]) == [True, True, False, False, False]


def test_duplicate_empty_pk_is_whole_row(spark):
    c = TableContract.from_dict({"table_name": "t", "columns": [{"name": "a", "type": "string"}],
                                 "validation": [{"rule": "duplicate", "primary_key": []}]})
    df = mk(spark, [("1",), ("1",)], "a string").withColumnRenamed("i", "_source_index")
    checked = validate(df, c, whole_row_duplicate=False, check_datatypes=False)
    got = [r["n"] for r in checked.orderBy("_source_index").select(F.size("_errors").alias("n")).collect()]
    assert got == [0, 1]


def test_range(spark):
    df = mk(spark, [(-40.0,), (-40.5,), (None,), (55.0,), (55.25,)], "celsius double")
    rule = RuleSpec("range", ("celsius",), (("max", 55.0), ("min", -40.0)))
    assert passes(df, [rule]) == [True, False, True, True, False]


def test_range_text(spark):
    df = mk(spark, [("warm",), ("12.5",), ("-Infinity",), ("99",), ("NaN",)], "celsius string")
    rule = RuleSpec("range", ("celsius",), (("max", 55.0), ("min", -40.0)))
    assert passes(df, [rule]) == [True, True, False, False, False]


def test_format(spark):
    df = mk(spark, [("24.12.1999",), (None,), ("1999-12-24",), ("4.12.1999",)], "d string")
    rule = RuleSpec("format", ("d",), (("format", "dd.MM.yyyy"),))
    assert passes(df, [rule]) == [True, True, False, False]


@pytest.mark.parametrize("t,values,expected", [
    ("int", ["-8", None, "8.25", "7e2", "  16  ", "xvi"], [True, True, False, False, True, False]),
    ("decimal", ["-8.5", "1e-3", "half", None], [True, True, False, True]),
    ("date", ["2004-02-29", "2005-02-29", "soon", None, "29-02-2004"], [True, False, False, True, False]),
    ("datetime", ["1999-12-31 23:59:59", None, "midnight"], [True, True, False]),
    ("string", ["", "7", None], [True, True, True]),
])
def test_datatype_text(spark, t, values, expected):
    df = mk(spark, [(v,) for v in values], "v string")
    rule = RuleSpec("datatype", ("v",), (("type", t),))
    assert passes(df, [rule]) == expected


def test_datatype_typed_int(spark):
    df = mk(spark, [(0.25,), (-6.0,), (None,), (1e3,)], "v double")
    rule = RuleSpec("datatype", ("v",), (("type", "int"),))
    assert passes(df, [rule]) == [False, True, True, True]


def test_routing_and_audit(spark):
    c = TableContract.from_dict({"table_name": "t", "columns": [{"name": "id", "type": "string"},
                                                               {"name": "name", "type": "string"}],
                                 "validation": [{"rule": "not_null", "column": ["id", "name"]}]})
    df = spark.createDataFrame([(0, "1", "A"), (1, None, None)], "_source_index long, id string, name string")
    valid, audit = split(validate(df, c))
    assert valid.count() == 1 and valid.columns == ["id", "name"]
    a = audit.collect()
    assert len(a) == 1 and a[0]["_source_index"] == 1
    assert a[0]["error_message"] == "not_null(id); not_null(name)"
    assert a[0]["error_rule"] == "not_null; not_null"
    assert a[0]["error_column"] == "id; name"
    assert a[0]["error_type"] == "validation"
    assert audit.columns[-5:] == ["_source_index", "error_type", "error_rule", "error_column", "error_message"]


def test_all_rules_order(spark):
    c = TableContract.from_dict({
        "table_name": "t",
        "columns": [{"name": "id", "type": "string"}, {"name": "q", "type": "int"}],
        "validation": [{"rule": "not_null", "column": ["id", "q"]},
                       {"rule": "range", "column": "q", "min": 0, "max": 10},
                       {"rule": "duplicate", "primary_key": "id"}]})
    df = spark.createDataFrame([(0, "1", "5"), (1, "1", "x"), (2, "1", "5"), (3, None, "20")],
                               "_source_index long, id string, q string")
    out = {r["_source_index"]: r["error_message"] for r in error_message(validate(df, c)).collect()}
    assert out[0] is None
    assert out[1] == "datatype(q); duplicate(id)"
    assert out[2] == "duplicate(id,q); duplicate(id)"
    assert out[3] == "not_null(id); range(q)"


def test_unknown_rule_raises():
    with pytest.raises(ContractError):
        TableContract.from_dict({"table_name": "t", "validation": [{"rule": "bogus", "column": "a"}]})


def test_unsupported_type_raises():
    with pytest.raises(ContractError, match="Unsupported type"):
        TableContract.from_dict({"table_name": "t", "columns": [{"name": "a", "type": "binary"}]})


def test_missing_column_raises(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ContractError):
        check_rules(df, [RuleSpec("not_null", ("zzz",))])


def test_unknown_order_by_raises(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ContractError, match="order_by"):
        check_rules(df, [RuleSpec("duplicate", ("a",))], order_by=["nope"])


def test_order_by_keeps_first_in_given_order(spark):
    df = spark.createDataFrame([(0, "k", 3), (1, "k", 1), (2, "k", 2)], "_source_index long, a string, t int")
    out = check_rules(df, [RuleSpec("duplicate", ("a",))], order_by=["t"])
    kept = [r["_source_index"] for r in out.where(F.size("_errors") == 0).collect()]
    assert kept == [1]


LONG_A, LONG_B = "a" * 40, "b" * 40


@pytest.mark.parametrize("collide", [False, True])
def test_long_keys_by_digest(spark, monkeypatch, collide):
    """Long texts, short ones, NULLs, and both in one key; different texts may share a digest."""
    if collide:
        monkeypatch.setattr(keysets, "digest", lambda columns: [F.lit(7).cast("long").alias("_h1"), F.lit(9).cast("long").alias("_h2")])
    data = [(0, LONG_A, 1), (1, LONG_B, 1), (2, LONG_A, 2), (3, "x", 1), (4, "x", 1), (5, None, 1), (6, None, 1), (7, "", 1), (8, LONG_A, 1),
            (9, "c" * 33, None), (10, "c" * 33, None), (11, "d" * 32, 5), (12, "d" * 32, 5), (13, "-", 1), (14, "1:x", 1)]
    df = spark.createDataFrame(data, "_source_index long, t string, n long").repartition(3)
    rules = [RuleSpec("unique", ("t",)), RuleSpec("unique", ("t", "n")), RuleSpec("duplicate", ("n", "t"))]
    got = {r["_source_index"]: r["error_message"] for r in error_message(check_rules(df, rules)).collect()}
    want = {}
    for i, t, n in data:
        messages = []
        if t is not None and sum(u == t for _, u, _ in data) > 1:
            messages.append("unique(t)")
        if t is not None and n is not None and sum((u, m) == (t, n) for _, u, m in data) > 1:
            messages.append("unique(t,n)")
        if any((u, m) == (t, n) and j < i for j, u, m in data):
            messages.append("duplicate(n,t)")
        want[i] = "; ".join(messages) or None
    assert got == want


def test_whole_rows_with_texts_bytes_and_arrays(spark):
    data = [(0, "a" * 50, b"\x00\x01", [1, 2], 0.0), (1, "a" * 50, b"\x00\x01", [1, 2], -0.0), (2, "a" * 50, b"\x00", [1, 2], 0.0), (3, "a" * 50, b"\x00\x01", [1], 0.0),
            (4, None, None, None, None), (5, None, None, None, None), (6, None, None, [], None)]
    df = spark.createDataFrame(data, "_source_index long, t string, b binary, l array<int>, d double")
    got = {r["_source_index"] for r in validate(df, None, rules=[], check_datatypes=False).where(F.size("_errors") > 0).collect()}
    assert got == {1, 5}


def test_unique_rule_moves_no_texts(spark):
    docs = spark.createDataFrame([(i, "word " * 100 + str(i % 50)) for i in range(100)], "_source_index long, text string")
    keys = validate_module._KeySet(0, ("text",), {"text": docs.schema["text"].dataType})
    plan = keys._repeated(docs, None, True)._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange hashpartitioning"):]
    shuffled = exchange[:exchange.index(")")]
    assert "text#" not in shuffled and "SortAggregate" not in plan
    out = check_rules(docs, [RuleSpec("unique", ("text",))])
    assert out.where(F.size("_errors") == 1).count() == 100


def test_registered_key_rule(spark):
    """At most n rows a key; and the rows of a key agree on a value."""
    register_key_rule("at_most", lambda schema, spec: KeyRule(F.lit(1), F.count, lambda n: n > spec.param("n")))
    register_key_rule("one_value", lambda schema, spec: KeyRule(F.col(spec.param("of")), F.count_distinct, lambda n: n > 1))
    c = TableContract.from_dict({"table_name": "t", "columns": [{"name": "k", "type": "string"}, {"name": "v", "type": "int"}], "validation": [
        {"rule": "at_most", "column": "k", "n": 2}, {"rule": "one_value", "column": "k", "of": "v"}, {"rule": "unique", "column": "k"}]})
    df = spark.createDataFrame([(0, "a", 1), (1, "a", 1), (2, "b", 1), (3, "b", 2), (4, "b", 1), (5, "c", 9), (6, None, 1), (7, None, 2), (8, None, 3)],
                               "_source_index long, k string, v long")
    got = {r["_source_index"]: r["error_message"] for r in error_message(validate(df, c, whole_row_duplicate=False)).collect()}
    b = "at_most(k); one_value(k); unique(k)"
    assert got == {0: "unique(k)", 1: "unique(k)", 2: b, 3: b, 4: b, 5: None, 6: None, 7: None, 8: None}
    with pytest.raises(ContractError, match="Columns not found"):
        validate(df.drop("k"), None, rules=[RuleSpec("at_most", ("k",), (("n", 2),))], whole_row_duplicate=False)
