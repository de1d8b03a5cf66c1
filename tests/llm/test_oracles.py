"""Registered queries with SQL: Spark and DuckDB give the same rows."""

import duckdb
import pytest
from llm_cases import SF_SMALL

from cellfold.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(ORACLE_SQL[name])
    want_names = [d[0] for d in cur.description]
    want = sorted(map(str, cur.fetchall()))
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(want_names)
    assert sorted(str(tuple(r)) for r in df.select(*want_names).collect()) == want
