import pytest

from logloom.plans.registry import FLAGSHIP, ORACLE, QUERIES
from tests.oracle import assert_same, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_gives_the_rows_of_its_sql(spark, sf, con, name):
    assert_same(QUERIES[name](spark, sf), con, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert FLAGSHIP in e.queries()
