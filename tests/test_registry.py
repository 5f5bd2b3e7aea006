"""Every registered query beside its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import duck, rows_of

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry(spark):
    assert entry(spark).count() == 8


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, FOLDER)
    result = con.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())
