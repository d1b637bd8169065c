"""Every registered query against its SQL, and the driver contract."""

import pytest
from conftest import SF_DIR
from oracle_compare import compare, oracle_connection

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert compare(df, con, ORACLE[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
