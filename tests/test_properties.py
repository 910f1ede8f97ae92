"""Property test: validate() equals a pandas brute force on random tables."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rampart import TableContract, validate
from rampart.operators.routing import count_audit, error_message

CONTRACT = TableContract.from_dict({
    "table_name": "t",
    "columns": [{"name": "k", "type": "string"}, {"name": "g", "type": "string"},
                {"name": "q", "type": "int"}],
    "validation": [{"rule": "not_null", "column": ["k", "q"]},
                   {"rule": "range", "column": "q", "min": 0, "max": 5},
                   {"rule": "duplicate", "primary_key": "k"},
                   {"rule": "unique", "column": ["g", "q"]}]})

rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                          st.sampled_from(["x", "y", None]),
                          st.sampled_from(["0", "3", "7", "-1", "2.5", "zz", None])),
                min_size=1, max_size=25)


def _eq(a, b):
    return a == b or (a is None and b is None)


def _num(v):
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


def _is_int_text(v):
    f = _num(v)
    return f is not None and f.is_integer() and "." not in v and "e" not in v.lower()


def brute(records: list[tuple]) -> dict:
    """Reference semantics, row by row over the table in source order."""
    rows = sorted(records)
    out = {}
    for i, (idx, k, g, q) in enumerate(rows):
        before = rows[:i]
        m = []
        if any(_eq(bk, k) and _eq(bg, g) and _eq(bq, q) for _, bk, bg, bq in before):
            m.append("duplicate(k,g,q)")
        if q is not None and not _is_int_text(q):
            m.append("datatype(q)")
        if k is None:
            m.append("not_null(k)")
        if q is None:
            m.append("not_null(q)")
        v = _num(q)
        if v is not None and not (0 <= v <= 5):
            m.append("range(q)")
        if any(_eq(bk, k) for _, bk, _, _ in before):
            m.append("duplicate(k)")
        if g is not None and q is not None and sum(1 for r in rows if r[2] == g and r[3] == q) > 1:
            m.append("unique(g,q)")
        out[idx] = "; ".join(m) or None
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows)
def test_validate_equals_brute_force(spark, data):
    records = [(i * 7 + 3, *r) for i, r in enumerate(data)]
    df = spark.createDataFrame(records, "_source_index long, k string, g string, q string").repartition(3)
    checked = validate(df, CONTRACT)
    got = {r["_source_index"]: r["error_message"] for r in error_message(checked).collect()}
    expected = brute(records)
    assert got == expected
    counts = count_audit(checked).first()
    assert counts["n_in"] == counts["n_valid"] + counts["n_error"] == len(data)
    assert not any(isinstance(v, float) and math.isnan(v) for v in got.values())
