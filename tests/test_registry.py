"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from quayside import registry
from quayside.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 9):.9f}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
    assert set(registry.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    cur = duck.execute(contract.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.columns == ["payload", "ts", "processing_timestamp", "partition_date"]
    assert df.count() > 0


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_types_match_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    cur = duck.execute(f"SELECT * FROM ({contract.oracle_sql()[name]}) LIMIT 0")
    theirs = {c[0]: str(c[1]) for c in cur.description}
    assert ours == theirs
