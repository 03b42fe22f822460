"""Every query that has SQL against it on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", oracle_sql())
def test_query(spark, tables, name):
    assert compare(spark, tables, queries()[name], oracle_sql()[name], FOLDER) is None


def test_entry(spark):
    assert entry(spark).count() > 0
