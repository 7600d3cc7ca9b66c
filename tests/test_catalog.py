"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, rows_of


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_registration():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    cursor = con.execute(sql)
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 6
