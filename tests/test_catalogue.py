"""Every registered query against its SQL on the smallest data set."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry

QUERIES = entry.queries()
CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    if name in CHECKS:
        assert difference(df, duck, CHECKS[name]) is None
    else:
        assert df.count() > 0
