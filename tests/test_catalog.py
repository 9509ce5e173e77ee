import pytest

from __spark_entry__ import entry, oracle_sql, queries
from rowloom.catalog import QUERIES
from rowloom.oracle import ORACLE
from tests.compare import connect, same_rows


@pytest.fixture(scope="module")
def con(tables):
    return connect(tables)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, tables, con, name):
    assert same_rows(queries()[name](spark, tables), con, oracle_sql()[name]) is None


def test_flagship(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "label", "split", "prompt"] and df.count() > 0
