import pytest

import __spark_entry__ as entry
from farsight.plans.queries import QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ID", "TEXT", "SCORE", "QUERY"]
    assert df.count() == 10


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, connection, name):
    df = entry.queries()[name](spark, FOLDER)
    assert difference(df, connection, entry.oracle_sql()[name]) is None
