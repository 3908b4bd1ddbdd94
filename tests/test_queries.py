"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import differences, duck

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    made = duck(SF)
    made.execute("SET TimeZone='UTC'")
    return made


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    got = queries()[name](spark, SF).toArrow()
    assert differences(got, con.execute(SQL[name]).to_arrow_table()) == []


def test_entry(spark):
    assert entry(spark).count() == 15
