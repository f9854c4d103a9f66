"""Every registered query that has SQL gives the SQL's rows."""

import pytest

import __spark_entry__ as entry
from tests.oracle import DATA, connection, rows_of_spark, rows_of_sql

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    got, want = rows_of_spark(entry.queries()[name](spark, SF)), rows_of_sql(con, entry.oracle_sql()[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
