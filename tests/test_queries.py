"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import os

import duckdb
import pytest

from rillflow.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    assert got
    if name in ORACLE_SQL:
        found = con.execute(ORACLE_SQL[name])
        columns = [d[0] for d in found.description]
        order = sorted(range(len(columns)), key=columns.__getitem__)
        assert sorted(columns) == sorted(df.columns)
        assert got == sorted(tuple(str(r[i]) for i in order) for r in found.fetchall())


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
