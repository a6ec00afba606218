"""Every named query next to its SQL at the smallest scale, plus the driver contract."""

import pytest
from oracle_check import check, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 101 and sum(r["is_best"] for r in rows) == 1


def test_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = check(spark, con, QUERIES[name], SQL.get(name), SF)
    assert result.startswith(("ok", "rows-only")), result
