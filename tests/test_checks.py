"""Every registered query against its SQL on DuckDB."""

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from conftest import SMALL

QUERIES = contract.queries()
CHECKS = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.fixture(scope="module")
def larger():
    return connect(LARGER)


#: Texts hold quotes from this size on.
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(n for n in CHECKS if n.startswith("output_")))
def test_queries_of_texts_equal_sql_on_the_larger_tables(spark, larger, name):
    assert differences(QUERIES[name](spark, LARGER), CHECKS[name], larger) is None


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), CHECKS[name], duck) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
