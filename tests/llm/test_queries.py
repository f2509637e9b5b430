"""Registered queries against their SQL on the small tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from parcelmill.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    # A column of integers with a null is of floats in one frame and of nullable integers in the other.
    plain = lambda v: "null" if pd.isna(v) else str(int(v)) if isinstance(v, (float, np.integer)) and v == int(v) else str(v)
    told = lambda x: sorted(tuple(map(plain, r)) for r in x[columns].itertuples(index=False, name=None))
    assert told(got) == told(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op2_decontaminate", "op11_prefix_trie"}))
def test_query_returns_a_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF).select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
