"""The corpus queries that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from groundtable.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("the driver's tables are not here")
    c = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = c.execute(queries.ORACLE_SQL[name])
    columns = [x[0] for x in found.description]
    df = queries.QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, found.fetchall()))
