"""Every query with SQL against DuckDB, on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

from harborline.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are absent")


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, bool) or value is None:
        return value
    return float(value) if isinstance(value, int | float | decimal.Decimal) else value


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_is_that_of_sql(spark, db, name):
    found = catalog.QUERIES[name](spark, SF)
    expected = db.sql(catalog.ORACLE_SQL[name])
    assert sorted(found.columns) == sorted(expected.columns)
    order = sorted(found.columns)
    rows = [tuple(_plain(r[c]) for c in order) for r in found.collect()]
    at = [expected.columns.index(c) for c in order]
    other = [tuple(_plain(r[i]) for i in at) for r in expected.fetchall()]
    assert sorted(rows, key=repr) == sorted(other, key=repr)


def test_entry_runs(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
