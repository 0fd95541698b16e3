"""Every listing query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from groundtable.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    if not os.path.isdir(DATA):
        pytest.skip("the driver's tables are not here")
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else str(v)[:10] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query(spark, sql, name):
    df = catalog.QUERIES[name](spark, DATA)
    found = sql.execute(catalog.ORACLE_SQL[name])
    columns = sorted(x[0] for x in found.description)
    assert sorted(df.columns) == columns
    order = [[x[0] for x in found.description].index(c) for c in columns]
    key = lambda row: [(v is None, str(v)) for v in row]
    expected = sorted(([plain(row[i]) for i in order] for row in found.fetchall()), key=key)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=key)
    assert got == expected


def test_every_query_has_rows(spark):
    assert set(catalog.ORACLE_SQL) == set(catalog.QUERIES)
    assert "| quality |" in catalog.QUERIES["markdown_report"](spark, DATA).first().report


@pytest.mark.parametrize("name", ["extract_batch", "extract_repeated"])
def test_rows_are_not_gathered_on_the_driver(spark, name):
    """Files of millions of repetitive rows are small; joins of such rows are dealt out by key all the same."""
    plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
