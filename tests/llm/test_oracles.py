"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest
from helpers import DOCS

from quayside.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SMALL)
    cur = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns) and DOCS
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in df.select(*columns).collect())
