"""Every registered query against its SQL."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from millrace.plans.catalog import QUERIES  # noqa: E402
from compare import connect, difference  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(QUERIES) <= set(entry.queries())
