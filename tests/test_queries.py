"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from rampart.plans import catalog  # noqa: E402
from oracle_check import TABLES, canon  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(catalog.QUERIES) <= set(E.queries())
    assert set(catalog.QUERIES) - set(E.oracle_sql()) == {"jdbc_roundtrip"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    if name not in E.oracle_sql():
        assert len(got) > 0
        return
    want = con.execute(E.oracle_sql()[name]).df()
    assert canon(got) == canon(want)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "first_name", "last_name", "birthday", "address",
                          "address_province", "kpi", "process_date"]
