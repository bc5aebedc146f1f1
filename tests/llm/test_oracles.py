"""Queries with a DuckDB twin against that twin, and every other query for one row a document."""

import duckdb
import pandas as pd
import pytest

from quirework.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations embeddings".split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ours = QUERIES[name](spark, SF).toPandas()
    theirs = con.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    text = lambda x: "~" if pd.isna(x) else str(int(x)) if isinstance(x, float) else str(x)
    rows = lambda frame: sorted(tuple(map(text, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op2_substring_dedup"}))
def test_one_row_a_document(spark, name):
    ids = [r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
