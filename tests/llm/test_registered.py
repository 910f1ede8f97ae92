"""Every registered query over the given sf0.001 tables; those with SQL against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from rampart.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [*queries.QUERIES, "pipeline"])
def test_query(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    documents = duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").df().iloc[0, 0]
    if name in ("op1_bpe", "op3_lm_scoring", "op4_suffix_dedup", "op5_language_id", "op7_toxicity", "op8_substring_dedup", "op9_simhash", "op11_merkle_manifest", "op13_sentencepiece"):
        assert len(got) == got["doc_id"].nunique() == documents
    assert len(got) > 0
    if name not in entry.oracle_sql():
        return
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda frame: sorted(map(tuple, frame[columns].astype(str).to_numpy()))
    assert rows(got) == rows(want)
