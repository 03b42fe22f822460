"""Whole queries on the smallest tables against their DuckDB SQL."""

import pytest
from compare import compare, connect

from sftq.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(FOLDER), QUERIES[name], ORACLES[name], FOLDER) is None
